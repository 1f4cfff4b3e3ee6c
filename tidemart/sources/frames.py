"""Typed frames: empty frames with a fixed schema, inline VALUES tables, and the
union of per-month frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def empty_typed(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Zero rows with exactly ``schema`` (guards a sink against type drift)."""
    return spark.createDataFrame([], schema)


def values_table(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """An inline ``VALUES`` table with column names and types.

    Meant for small literal lookups (a list of accepted names, test fixtures); the
    rows travel with the plan, so keep them small."""
    return spark.createDataFrame(list(rows), schema)


def concat_months(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name of per-month frames (schemas must agree)."""
    if not frames:
        raise ValueError("concat_months needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)
