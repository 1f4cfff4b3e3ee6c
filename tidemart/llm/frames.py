"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemart.sources.scratch import lifetime, scratch_path

#: Spark's own setting: shuffle files go when the query that wrote them ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's own setting: bytes of a batch for a Python worker, whatever its number of rows
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20  # 10,000 whole texts, Spark's own limit, may be any size; a worker and the JVM hold two batches each


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but as compressed columnar files; a lost
    executor costs a reread.  The shuffle files of the write, which nothing reads again, go
    with its end; the written files stay until the open lifetime ends (``finished``) or,
    without one, until the folder is cleaned, as checkpoints do.
    """
    return _written(df, scratch_path(df.sparkSession))


def finished(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written and read back, without all that was materialised to make it."""
    path = scratch_path(spark)
    with lifetime(spark):
        return _written(build(), path)


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with setting(spark, CLEANUP, "true"), setting(spark, BATCH, str(BATCH_BYTES)):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for what runs inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def collected(df: DataFrame) -> pa.Table:
    """A small result on the driver, whose tasks get batches of up to BATCH_BYTES."""
    with setting(df.sparkSession, BATCH, str(BATCH_BYTES)):
        return df.toArrow()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` behind as many underscores as keep them apart from the columns of ``df``, in any case."""
    taken, lead = {c.lower() for c in df.columns}, "_"
    while any(lead + x in taken for x in names):
        lead += "_"
    return [lead + x for x in names]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
