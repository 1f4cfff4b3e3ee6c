"""Staging: regrid raw observations onto the 0.25 degree cell grid (one row per month
and cell, measures averaged).

Plan shape: the raw scan is pruned to the month range (partition filter on
``year, month``), projected to the integer cell key, partially aggregated on the map
side (a 0.05 degree source has 25 raw points per cell, so the shuffle carries ~1/25
of the rows), then hash-partitioned on ``(year, month, lat_idx, lon_idx)`` — four
integers, no per-row DATE or DOUBLE key. That is exactly the distribution the cell
join needs, so the join adds no exchange. ``year_month`` is a function of
``(year, month)`` and is built once per output row, after aggregation.

Keyed frames (``year, month, lat_idx, lon_idx, <measures>``) are what the marts
consume; :func:`public_cells` turns one into the published staging schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.calendar import month_date
from tidemart.functions.cells import cell_coordinate, snap_index

CELL_KEYS = ["year", "month", "lat_idx", "lon_idx"]


def filter_months(df: DataFrame, start=None, end=None, col: str | None = None) -> DataFrame:
    """Inclusive month-range filter, written over ``year, month`` (or ``col``) so it
    is pushed through aggregations down to the scan and prunes lake partitions."""
    if start is None and end is None:
        return df
    key = F.col(col) if col else month_date(F.col("year").cast("int"), F.col("month").cast("int"))
    conds = []
    if start is not None:
        conds.append(key >= F.lit(str(start)).cast("date"))
    if end is not None:
        conds.append(key <= F.lit(str(end)).cast("date"))
    cond = conds[0] if len(conds) == 1 else conds[0] & conds[1]
    return df.where(cond)


def month_floor(day) -> str | None:
    """First day of the month of an ISO date (a load range covers whole months)."""
    return None if day is None else f"{str(day)[:7]}-01"


def _keyed(raw: DataFrame, step: float) -> DataFrame:
    return raw.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        snap_index("latitude", step).alias("lat_idx"),
        snap_index("longitude", step).alias("lon_idx"),
        *[c for c in raw.columns if c not in ("year", "month", "latitude", "longitude")],
    )


def regrid_sst(raw_sst: DataFrame, step: float = 0.25, start=None, end=None) -> DataFrame:
    """A1: average SST and sea-ice fraction per (month, cell). Returns a keyed frame."""
    raw = filter_months(raw_sst.select("year", "month", "latitude", "longitude",
                                       "sst_celsius", "sea_ice_fraction"), start, end)
    return (_keyed(raw, step)
            .groupBy(*CELL_KEYS)
            .agg(F.avg("sst_celsius").alias("sst_celsius"),
                 F.avg("sea_ice_fraction").alias("sea_ice_fraction")))


def stage_sla(raw_sla: DataFrame, step: float = 0.25, start=None, end=None) -> DataFrame:
    """A2: average SLA per (month, cell) — a no-op regrid for data already on the grid,
    but it also merges duplicate appends of a month. Returns a keyed frame."""
    raw = filter_months(raw_sla.select("year", "month", "latitude", "longitude",
                                       "sea_level_anomaly_m"), start, end)
    return (_keyed(raw, step)
            .groupBy(*CELL_KEYS)
            .agg(F.avg("sea_level_anomaly_m").alias("sea_level_anomaly_m")))


def point_lookup(keyed: DataFrame, latitude: float, longitude: float, step: float = 0.25) -> DataFrame:
    """the rows of the cell that a point falls in, compared by integer cell key, so no
    DOUBLE equality is involved; the predicate is pushed below the regrid."""
    lat, lon = (snap_index(F.lit(float(x)), step) for x in (latitude, longitude))
    return keyed.where((F.col("lat_idx") == lat) & (F.col("lon_idx") == lon))


def public_cells(keyed: DataFrame, step: float = 0.25) -> DataFrame:
    """Keyed frame -> published staging schema
    ``year_month, year, month, latitude, longitude, <measures>``."""
    measures = [c for c in keyed.columns if c not in CELL_KEYS]
    return keyed.select(
        month_date("year", "month").alias("year_month"),
        F.col("year").cast("long").alias("year"),
        F.col("month").cast("long").alias("month"),
        cell_coordinate("lat_idx", step).alias("latitude"),
        cell_coordinate("lon_idx", step).alias("longitude"),
        *measures,
    )


def keyed_cells(staged: DataFrame, step: float = 0.25) -> DataFrame:
    """Published staging frame (e.g. read back from the staging table) -> keyed frame."""
    measures = [c for c in staged.columns
                if c not in ("year_month", "year", "month", "latitude", "longitude")]
    return staged.select(
        F.year("year_month").alias("year"),
        F.month("year_month").alias("month"),
        snap_index("latitude", step).alias("lat_idx"),
        snap_index("longitude", step).alias("lon_idx"),
        *measures,
    )
