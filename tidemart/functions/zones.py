"""Latitude zones and decade buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the published dashboard/mart definitions):
# zone names in display order, north to south
ZONE_NAMES = ["Arctic", "N. Temperate", "Tropical", "S. Temperate", "Antarctic"]
# lower edge (inclusive) of each zone except the last, in degrees latitude
ZONE_LOWER_EDGES = [66.5, 23.5, -23.5, -66.5]
# decade buckets: (first year, last year, label); every other year -> DEFAULT_DECADE_ELSE
DEFAULT_DECADES = [(1993, 2002, "1993-2002"), (2003, 2012, "2003-2012")]
DEFAULT_DECADE_ELSE = "2013-2023"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latitude_zone(lat) -> Column:
    """Five-way zone: each zone owns its lower edge (``>=``); NULL falls to the last
    zone (the ELSE branch) and NaN, which compares as largest, to the first."""
    c = _col(lat)
    expr = F.when(c >= F.lit(ZONE_LOWER_EDGES[0]), F.lit(ZONE_NAMES[0]))
    for edge, name in zip(ZONE_LOWER_EDGES[1:], ZONE_NAMES[1:-1]):
        expr = expr.when(c >= F.lit(edge), F.lit(name))
    return expr.otherwise(F.lit(ZONE_NAMES[-1]))


def decade(year, edges=None, else_label: str = DEFAULT_DECADE_ELSE) -> Column:
    """Bucket a year by inclusive ``(first, last, label)`` ranges; anything else,
    including years before the first range, gets ``else_label``."""
    edges = DEFAULT_DECADES if edges is None else edges
    c = _col(year)
    expr = None
    for lo, hi, label in edges:
        cond = c.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


def symmetric_limit(a, b) -> Column:
    """``max(|a|, |b|)`` — the half-width of a diverging colour scale."""
    return F.greatest(F.abs(_col(a)), F.abs(_col(b)))
