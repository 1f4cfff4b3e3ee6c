"""Month keys, labels and month ranges.

A month is keyed by ``year_month`` = first day of the month (DATE). ``year`` and
``month`` are functions of it and are derived after aggregation, not grouped on.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    if isinstance(d, _dt.datetime):
        d = d.date()
    return F.lit(d)


def month_date(year, month) -> Column:
    """``DATE(year, month, 1)``; an invalid month raises under ANSI mode, like SQL."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def parse_date(c, fmt: str | None = None) -> Column:
    return F.to_date(_col(c), fmt) if fmt else F.to_date(_col(c))


def parse_timestamp(c, fmt: str | None = None) -> Column:
    return F.to_timestamp(_col(c), fmt) if fmt else F.to_timestamp(_col(c))


def year_of(c) -> Column:
    return F.year(_col(c))


def month_label(c) -> Column:
    """``YYYY-MM`` with a zero-padded month."""
    return F.date_format(_col(c), "yyyy-MM")


def month_label_to_year(label) -> Column:
    return F.substring(_col(label), 1, 4).cast("int")


def month_label_to_month(label) -> Column:
    return F.substring(_col(label), 6, 2).cast("int")


def month_sequence(start, end) -> Column:
    """Array of month starts from ``start`` to ``end`` inclusive (both truncated)."""
    return F.sequence(F.trunc(_date_lit(start), "MM"), F.trunc(_date_lit(end), "MM"),
                      F.expr("INTERVAL 1 MONTH"))


def month_spine(spark_or_bounds, start=None, end=None) -> DataFrame:
    """One row per month between ``start`` and ``end`` (inclusive, truncated to month).

    Either ``month_spine(spark, start, end)`` with literal dates, or
    ``month_spine(bounds_df)`` where ``bounds_df`` has columns ``start`` and ``end``
    (for example a one-row ``min``/``max`` aggregate of the data). The spine is at
    most 12 rows per year, so it is generated in a single row and exploded.
    """
    if isinstance(spark_or_bounds, SparkSession):
        bounds = spark_or_bounds.range(1).select(
            _date_lit(start).alias("start"), _date_lit(end).alias("end"))
    else:
        bounds = spark_or_bounds
    return (bounds
            .select(F.explode(month_sequence(F.col("start"), F.col("end"))).alias("year_month"))
            .select("year_month",
                    F.year("year_month").alias("year"),
                    F.month("year_month").alias("month")))
