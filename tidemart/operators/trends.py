"""Least-squares trends over monthly series.

A series is one row per month (and per series key, e.g. zone). Global statistics
(series start, fitted slope/intercept) are attached with scalar subqueries: the
one-row aggregate is computed once, distributed, and read by every task as a
constant — no cross join and no single-partition window. Per-key statistics are
joined back on the key with a (null-safe) equi-join (AQE broadcasts it after
measuring its size, which is at most one row per key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _join_stats(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Attach per-series statistics: scalar subquery when global, equi-join when keyed.

    The keyed join is null-safe (``<=>``), so a group whose key is NULL keeps its
    statistics, as ``GROUP BY`` treats NULL as one group.
    """
    if by:
        if not any(df.schema[k].nullable or stats.schema[k].nullable for k in by):
            return df.join(stats, on=by, how="inner")  # keeps the existing partitioning
        renamed = stats.select(*[F.col(k).alias(f"_key_{k}") for k in by],
                               *[c for c in stats.columns if c not in by])
        cond = [df[k].eqNullSafe(renamed[f"_key_{k}"]) for k in by]
        return df.join(renamed, on=cond, how="inner").drop(*[f"_key_{k}" for k in by])
    cols = [c for c in stats.columns]
    s = stats.select(F.struct(*cols).alias("_s")).scalar()
    # one subquery expression, then plain field reads (not one subquery per field)
    return (df.withColumn("_stats", s)
              .select(*df.columns, *[F.col("_stats").getField(c).alias(c) for c in cols]))


def days_since_start(df: DataFrame, date_col: str = "year_month", by: list[str] | None = None,
                     out: str = "x_days") -> DataFrame:
    """Days since the first date of the series (``(x - x.min()).days``)."""
    by = list(by or [])
    start = df.groupBy(*by).agg(F.min(date_col).alias("_start"))
    return (_join_stats(df, start, by)
            .withColumn(out, F.datediff(F.col(date_col), F.col("_start")).cast("double"))
            .drop("_start"))


def month_ordinal(df: DataFrame, date_col: str = "year_month", by: list[str] | None = None,
                  out: str = "x_ordinal") -> DataFrame:
    """0..n-1 position of each month in its series.

    The input must be a monthly series (one row per month and key, as the marts
    produce), so each window partition holds at most 12 rows per year of the
    series — bounded by the calendar, not by data volume.
    """
    w = Window.partitionBy(*(by or [])).orderBy(F.col(date_col))
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("double"))


def linear_trend(df: DataFrame, y: str, x: str, by: list[str] | None = None,
                 prefix: str = "") -> DataFrame:
    """A10: degree-1 least squares of ``y`` on ``x`` per series: ``slope``, ``intercept``
    (NULL pairs skipped; NULL when fewer than two points)."""
    by = list(by or [])
    return df.groupBy(*by).agg(
        F.regr_slope(F.col(y), F.col(x)).alias(f"{prefix}slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias(f"{prefix}intercept"),
        F.count(F.col(y)).alias(f"{prefix}n_points"))


def with_fitted(df: DataFrame, y, x: str, out, by: list[str] | None = None) -> DataFrame:
    """Add ``out = slope * x + intercept`` of each series fit of ``y`` on ``x``.

    ``y``/``out`` may be lists: all fits come from one aggregate (one subquery or one
    keyed join), so the input series is evaluated once for every fitted column.
    """
    by = list(by or [])
    ys = [y] if isinstance(y, str) else list(y)
    outs = [out] if isinstance(out, str) else list(out)
    aggs = []
    for i, yc in enumerate(ys):
        aggs += [F.regr_slope(F.col(yc), F.col(x)).alias(f"_a{i}"),
                 F.regr_intercept(F.col(yc), F.col(x)).alias(f"_b{i}")]
    fit = df.groupBy(*by).agg(*aggs)
    joined = _join_stats(df, fit, by)
    return (joined
            .withColumns({o: F.col(f"_a{i}") * F.col(x) + F.col(f"_b{i}") for i, o in enumerate(outs)})
            .drop(*[f"_a{i}" for i in range(len(ys))], *[f"_b{i}" for i in range(len(ys))]))

