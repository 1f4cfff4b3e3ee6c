"""NaN/NULL cleaning at ingest.

Gridded sources mark land and missing cells with NaN. Spark aggregates do not skip
NaN (``avg`` of a NaN is NaN), so every measure is turned into NULL at ingest and
rows whose primary measure is missing are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(x) -> Column:
    c = _col(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def drop_missing(df: DataFrame, primary: str | list[str], measures: list[str] | None = None) -> DataFrame:
    """NaN -> NULL on ``measures`` (default: the primary columns), then drop rows whose
    primary measure(s) are NULL. Other measures may stay NULL."""
    primary = [primary] if isinstance(primary, str) else list(primary)
    measures = list(dict.fromkeys(primary + list(measures or [])))
    cleaned = df.withColumns({m: nan_to_null(m).cast(df.schema[m].dataType) for m in measures})
    return cleaned.dropna(subset=primary)
