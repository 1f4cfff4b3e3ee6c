"""Data-quality checks. Each returns one row ``(check, passed, violations)`` computed by
a distributed aggregate, so results can be unioned, stored or asserted on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.zones import ZONE_NAMES


def _row(df: DataFrame, name: str, violations) -> DataFrame:
    return df.select(F.lit(name).alias("check"),
                     (violations == 0).alias("passed"),
                     violations.cast("long").alias("violations"))


def check_unique(df: DataFrame, keys: list[str], name: str | None = None) -> DataFrame:
    """Q1: ``COUNT(*) = COUNT(DISTINCT keys)``; violations = rows beyond the distinct
    non-NULL keys (a NULL key counts as a violation, as COUNT(DISTINCT) skips it)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    all_set = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    stats = per_key.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_rows"),
                        F.count_if(all_set).alias("_distinct"))
    return _row(stats, name or f"unique({','.join(keys)})", F.col("_rows") - F.col("_distinct"))


def check_not_null(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Q2: no NULL in ``col``."""
    stats = df.agg(F.count_if(F.col(col).isNull()).alias("_v"))
    return _row(stats, name or f"not_null({col})", F.col("_v"))


def check_accepted_values(df: DataFrame, col: str, values=None, name: str | None = None) -> DataFrame:
    """Q3: every value of ``col`` is in ``values`` (default: the five zone names);
    NULL is not accepted."""
    values = list(ZONE_NAMES if values is None else values)
    stats = df.agg(F.count_if(~F.coalesce(F.col(col).isin(values), F.lit(False))).alias("_v"))
    return _row(stats, name or f"accepted_values({col})", F.col("_v"))


def check_positive(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Q4: ``col > 0`` on every row (NULL is a violation)."""
    stats = df.agg(F.count_if(~F.coalesce(F.col(col) > 0, F.lit(False))).alias("_v"))
    return _row(stats, name or f"positive({col})", F.col("_v"))


def check_not_empty(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """Q5: at least one row."""
    stats = df.agg(F.count(F.lit(1)).alias("_n"))
    return _row(stats, name, F.when(F.col("_n") > 0, 0).otherwise(1))


def partials_checks(partials: DataFrame) -> DataFrame:
    """The six published mart invariants from the zone partials that both marts are made of,
    in one grouped pass (per month, then over all months)."""
    known = F.coalesce(F.col("latitude_zone").isin(list(ZONE_NAMES)), F.lit(False))
    day = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    months = partials.groupBy(day.alias("_day")).agg(
        F.sum("grid_points").alias("_points"), F.count(F.lit(1)).alias("_zones"),
        F.size(F.collect_set("latitude_zone")).alias("_names"),  # at most the zone names
        F.count_if(~known).alias("_strange"),
        F.size(F.collect_set(F.struct("year", "month"))).alias("_rows"))
    stats = months.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~F.coalesce(F.col("_points") > 0, F.lit(False))).alias("_nonpos"),
        F.count_if(F.col("_day").isNull()).alias("_nullkey"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_day").isNotNull().cast("int")), F.lit(0)).alias("_twice"),
        F.coalesce(F.sum("_strange"), F.lit(0)).alias("_strange"),
        F.coalesce(F.sum(F.col("_zones") - F.when(F.col("_day").isNotNull(), F.col("_names")).otherwise(0)), F.lit(0)).alias("_zonetwice"))
    named = [("monthly.not_empty", F.when(F.col("_n") > 0, 0).otherwise(1)),
             ("monthly.grid_points_positive", F.col("_nonpos")), ("monthly.year_month_not_null", F.col("_nullkey")),
             ("monthly.year_month_unique", F.col("_twice")), ("zones.accepted_zone_names", F.col("_strange")),
             ("zones.key_unique", F.col("_zonetwice"))]
    rows = stats.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("long").alias("violations"))
                                           for n, v in named])))
    return rows.select("check", (F.col("violations") == 0).alias("passed"), "violations")


def mart_checks(monthly: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The published mart invariants as one small table.

    The row-level checks (not empty, positive count, non-NULL key) share one
    aggregate over the mart; uniqueness needs one grouped pass per key set.
    """
    row_level = monthly.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~F.coalesce(F.col("grid_points") > 0, F.lit(False))).alias("_nonpos"),
        F.count_if(F.col("year_month").isNull()).alias("_nullkey"))
    rows = row_level.select(F.inline(F.array(
        F.struct(F.lit("monthly.not_empty").alias("check"),
                 F.when(F.col("_n") > 0, 0).otherwise(1).cast("long").alias("violations")),
        F.struct(F.lit("monthly.grid_points_positive").alias("check"),
                 F.col("_nonpos").cast("long").alias("violations")),
        F.struct(F.lit("monthly.year_month_not_null").alias("check"),
                 F.col("_nullkey").cast("long").alias("violations")))))
    rows = rows.select("check", (F.col("violations") == 0).alias("passed"), "violations")
    checks = [rows, check_unique(monthly, ["year_month"], "monthly.year_month_unique")]
    if zones is not None:
        checks += [
            check_accepted_values(zones, "latitude_zone", name="zones.accepted_zone_names"),
            check_unique(zones, ["year_month", "latitude_zone"], "zones.key_unique"),
        ]
    return reduce(DataFrame.unionByName, checks)
