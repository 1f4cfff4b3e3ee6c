"""Grid cells: snapping coordinates to a regular grid and raster indices.

Snapping is ``ROUND(CAST(x AS DOUBLE) / step) * step`` with rounding half away from
zero, like SQL ``ROUND``. Internally cells are keyed by
the integer ``round(x / step)`` so joins and groupings hash integers instead of
doubles; the coordinate is rebuilt as ``index * step`` only at the output edge,
which is bit-identical to the SQL expression (apart from -0.0, which becomes 0.0).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class GridSpec:
    """A regular latitude/longitude grid; both edges are cells (-180 and 180 differ)."""

    step: float = 0.25
    lat_min: float = -90.0
    lat_max: float = 90.0
    lon_min: float = -180.0
    lon_max: float = 180.0

    @property
    def n_lat(self) -> int:
        return int(round((self.lat_max - self.lat_min) / self.step)) + 1

    @property
    def n_lon(self) -> int:
        return int(round((self.lon_max - self.lon_min) / self.step)) + 1

    @property
    def lon_axis(self) -> list[float]:
        return [self.lon_min + self.step * k for k in range(self.n_lon)]

    @property
    def n_cells(self) -> int:
        return self.n_lat * self.n_lon


GRID_025 = GridSpec()  # 721 x 1441 cells


def round_half_away(q: Column) -> Column:
    """``ROUND(q)`` (half away from zero) as a DOUBLE integer, in primitive arithmetic.

    Spark's ``round`` on a double goes through ``BigDecimal`` for every row. Here,
    with ``a = |q|`` and ``f = floor(a + 0.5)``: the float sum can only round *up*
    onto an integer, and ``a < f - 0.5`` (exact, as ``f - 0.5`` is representable)
    detects exactly that case, so ``0.49999999999999994`` rounds to 0 and 0.5 to 1.
    Only null-intolerant operators are used (no CASE), so the ``isnotnull`` that a
    join infers on a cell index stays a small arithmetic expression in the scan
    filter. NULL stays NULL; NaN or infinite coordinates are not valid (the INT cast
    of the index raises under ANSI mode) — clean them at ingest.
    """
    a = F.abs(q)
    f = F.floor(a + F.lit(0.5))
    return F.signum(q) * (f - (a < (f - F.lit(0.5))).cast("long"))


def snap_index(x, step: float = 0.25) -> Column:
    """Integer cell index ``round(x / step)`` (half away from zero)."""
    return round_half_away(_col(x).cast("double") / F.lit(float(step))).cast("int")


def snap(x, step: float = 0.25) -> Column:
    """Coordinate snapped to the grid: ``round(x / step) * step`` as DOUBLE."""
    return round_half_away(_col(x).cast("double") / F.lit(float(step))).cast("double") * F.lit(float(step))


def cell_coordinate(idx, step: float = 0.25) -> Column:
    """Back from an integer index to the snapped coordinate (DOUBLE)."""
    return _col(idx).cast("double") * F.lit(float(step))


def clip(x, lo, hi) -> Column:
    """Bound ``x`` to ``[lo, hi]``; NULL stays NULL (``greatest`` and ``least`` alone skip it)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(_col(x).isNotNull(), F.greatest(lo_c, F.least(hi_c, _col(x))))


def cell_index(coord, origin: float, step: float, n: int) -> Column:
    """Raster index of a coordinate: ``rint((coord - origin) / step)`` clipped to
    ``[0, n - 1]``. ``rint`` rounds half to even, as the dashboard raster does; the
    inputs are already multiples of ``step`` so no tie arises in practice."""
    raw = F.rint((_col(coord).cast("double") - F.lit(float(origin))) / F.lit(float(step)))
    return clip(raw.cast("int"), 0, n - 1)


def lat_raster_index(lat, grid: GridSpec = GRID_025) -> Column:
    return cell_index(lat, grid.lat_min, grid.step, grid.n_lat)


def lon_raster_index(lon, grid: GridSpec = GRID_025) -> Column:
    return cell_index(lon, grid.lon_min, grid.step, grid.n_lon)
