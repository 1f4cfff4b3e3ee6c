"""Small series helpers: newest month, distinct values / sorted axes, first point per zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_month(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """The newest (year, month) — ``MAX(year)`` and the largest month of that year —
    in one distributed pass (``max`` of a struct orders by year, then month)."""
    return df.agg(F.max(_ym(year, month)).alias("_ym")).select(
        F.col("_ym.y").alias("latest_year"), F.col("_ym.m").alias("latest_month"))


def latest_month_value(df: DataFrame, year: str = "year", month: str = "month") -> Column:
    """A8 + B2 as a scalar subquery Column: ``struct<y: int, m: int>`` of the newest month."""
    return df.agg(F.max(_ym(year, month)).alias("_ym")).select("_ym").scalar()


def _ym(year: str, month: str) -> Column:
    return F.struct(F.col(year).cast("int").alias("y"), F.col(month).cast("int").alias("m"))


def slice_latest_month(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """F4 on the newest month, without a round trip through the driver.

    The predicate ``struct(year, month) = (scalar subquery)`` references partition
    columns only, so on a lake it is a runtime partition filter: the subquery reads
    partition values (no data columns) and only the newest month's files are opened.
    """
    return df.where(_ym(year, month) == latest_month_value(df, year, month))


def slice_month(df: DataFrame, year: int, month: int, ycol: str = "year",
                mcol: str = "month") -> DataFrame:
    """``year = y AND month = m`` (prunes lake partitions)."""
    return df.where((F.col(ycol) == F.lit(year)) & (F.col(mcol) == F.lit(month)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """``SELECT DISTINCT col``."""
    return df.select(col).distinct()


def sorted_axis(df: DataFrame, col: str) -> DataFrame:
    """O3: sorted unique coordinate values (distributed distinct, then range sort)."""
    return df.select(col).distinct().orderBy(col)


def first_point_per_zone(zone_stats: DataFrame, value: str = "avg_sst_celsius",
                         zone: str = "latitude_zone") -> DataFrame:
    """Each zone's first month and its value (``min_by``, no sort of the series)."""
    return zone_stats.groupBy(zone).agg(
        F.min("year_month").alias("first_month"),
        F.min_by(F.col(value), F.col("year_month")).alias(f"first_{value}"))
