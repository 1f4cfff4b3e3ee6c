"""The raw Parquet lake: ``<base>/year=YYYY/month=M/part-*.parquet``.

* :func:`scan_lake` (S1) reads with a declared schema and prunes partitions to a
  month range (the range predicate is over the partition columns only, so it
  becomes a ``PartitionFilters`` entry of the scan — no file outside the range is
  listed or opened).
* :func:`write_lake_month` (S3) replaces exactly the months present in the frame
  (dynamic partition overwrite); other months stay.
* :func:`scan_newest_month` (A8, F4) finds the newest month by listing folders and opens
  that month's files only.
* :func:`scan_published`, :func:`write_published` (S1) read and write the published object layout
  ``<prefix>/YYYY/MM.parquet``, one object per month with year and month as columns.
* :func:`append_lake` appends, as a raw table load does (re-running appends again;
  staging averages hide whole-month duplicates).
* :func:`ingest_grid` turns gridded rows into cleaned observations (S12 + F1 + P4).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.cleaning import drop_missing
from tidemart.operators.staging import filter_months, month_floor
from tidemart.sources.frames import empty_typed
from tidemart.sources.scratch import delete_folder

PARTITION_COLS = ["year", "month"]


def scan_lake(spark: SparkSession, base: str, schema: T.StructType, start=None, end=None) -> DataFrame:
    """Read the lake (declared schema, no inference), optionally one month range.

    The range names days; both ends are taken back to the first of their month, so the
    months of ``start`` and of ``end`` are read whole."""
    df = spark.read.schema(schema).option("basePath", base).parquet(base)
    return filter_months(df, month_floor(start), month_floor(end))


def scan_paths(spark: SparkSession, paths: list[str], schema: T.StructType,
               base: str | None = None) -> DataFrame:
    """U1 as a read: several month folders/files in one scan (UNION ALL of months).
    With ``base`` the ``year``/``month`` partition columns are recovered from the paths."""
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.parquet(*paths)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _sized(df: DataFrame, range_partitions: int | None) -> DataFrame:
    """Rows by month, ordered by latitude and longitude inside each task.

    By default the rows are rebalanced on the month: adaptive execution puts small months
    together into few files and splits a month that outgrows the advisory partition size
    over several tasks. With ``range_partitions`` they are range partitioned on (year, month,
    latitude) instead, so each file covers a latitude band of a month."""
    if range_partitions:
        df = df.repartitionByRange(range_partitions, *PARTITION_COLS, "latitude")
    else:
        df = df.hint("rebalance", *PARTITION_COLS)
    return df.sortWithinPartitions(*PARTITION_COLS, "latitude", "longitude")


def write_lake_month(df: DataFrame, base: str, schema: T.StructType | None = None,
                     range_partitions: int | None = None) -> None:
    """S3: write the frame's months, replacing those months only, in files sized by
    :func:`_sized`; row-group statistics of the sorted files prune point and band lookups."""
    out = _conform(df, schema) if schema is not None else df
    (_sized(out, range_partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS)
        .parquet(base))


def append_lake(df: DataFrame, base: str, schema: T.StructType | None = None,
                range_partitions: int | None = None) -> None:
    """S2/S4 on the lake: append the frame's rows."""
    out = _conform(df, schema) if schema is not None else df
    (_sized(out, range_partitions)
        .write.mode("append").partitionBy(*PARTITION_COLS).parquet(base))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of the visible entries of a folder; none if it is not there."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)]
    return [x for x in found if not x[0].startswith(("_", "."))]


def _numbers(entries: list[tuple[str, bool]], key: str) -> list[int]:
    """Values of the folders ``key=<number>``, newest first; others (a NULL partition) are no month."""
    values = [name[len(key) + 1:] for name, folder in entries if folder and name.startswith(f"{key}=")]
    return sorted((int(v) for v in values if v.isdigit()), reverse=True)


def lake_months(spark: SparkSession, base: str) -> list[tuple[int, int]]:
    """All months with a folder in the lake, newest first: one listing per year, no file is opened."""
    return [(y, m) for y in _numbers(_listed(spark, base), "year")
            for m in _numbers(_listed(spark, f"{base}/year={y}"), "month")]


def newest_lake_month(spark: SparkSession, base: str) -> tuple[int, int] | None:
    """A8 on a lake: the newest month that has a data file, from two or three folder listings.

    Equal to ``MAX`` over the rows, as no write leaves a file without rows."""
    for y in _numbers(_listed(spark, base), "year"):
        for m in _numbers(_listed(spark, f"{base}/year={y}"), "month"):
            if any(not folder for _, folder in _listed(spark, f"{base}/year={y}/month={m}")):
                return y, m
    return None


def scan_newest_month(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """F4 on the newest month of a lake: the read names that month's folder, so no other file is
    listed or opened; an empty frame for a lake without data."""
    newest = newest_lake_month(spark, base)
    if newest is None:
        return empty_typed(spark, schema)
    folder = f"{base}/year={newest[0]}/month={newest[1]}"
    return spark.read.schema(schema).option("basePath", base).parquet(folder).select(*schema.names)


class MissingMonth(FileNotFoundError):
    """Months of a range that have no object in the published layout."""


def _months(start, end) -> list[tuple[int, int]]:
    first, last = (dt.date.fromisoformat(str(d)[:10]) for d in (start, end))
    return [divmod(n, 12) for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


def published_path(prefix: str, year: int, month: int) -> str:
    return f"{prefix.rstrip('/')}/{year}/{month:02d}.parquet"


def scan_published(spark: SparkSession, prefix: str, schema: T.StructType, start, end,
                   missing: str = "error") -> DataFrame:
    """S1 in the published layout: the objects of the months from ``start`` to ``end`` (both whole).

    Paths come from the month range; each year's folder is listed once. Months without an object
    raise :class:`MissingMonth`, which names them all, or are left out with ``missing="skip"``.
    A row whose year or month is not that of its object's path fails the read."""
    if missing not in ("error", "skip"):
        raise ValueError(f"scan_published: missing={missing!r}")
    wanted = [(y, m + 1) for y, m in _months(start, end)]
    there = {y: {name for name, _ in _listed(spark, f"{prefix.rstrip('/')}/{y}")} for y in {y for y, _ in wanted}}
    gone = [(y, m) for y, m in wanted if f"{m:02d}.parquet" not in there[y]]
    if gone and missing == "error":
        raise MissingMonth(f"{prefix}: no object for " + ", ".join(f"{y}-{m:02d}" for y, m in gone))
    paths = [published_path(prefix, y, m) for y, m in wanted if (y, m) not in gone]
    if not paths:
        return empty_typed(spark, schema)
    path = F.col("_metadata.file_path")
    own = [F.regexp_extract(path, r"/([0-9]+)/([0-9]+)\.parquet", i).cast("int") for i in (1, 2)]
    same = F.col("year").eqNullSafe(own[0]) & F.col("month").eqNullSafe(own[1])
    return (spark.read.schema(schema).parquet(*paths)
            .where(F.when(same, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("scan_published: another month's row in "), path)).cast("boolean")))
            .select(*schema.names))


def write_published(df: DataFrame, prefix: str, schema: T.StructType | None = None) -> list[tuple[int, int]]:
    """S3 in the published layout: one object per month of the frame, replacing those months only; the months.

    The layout asks for one object per month, so a month is written by one task. Objects are
    written beside the others and moved into place by renames, one per month."""
    spark = df.sparkSession
    out = _conform(df, schema) if schema is not None else df
    lost = F.raise_error(F.lit("write_published: year or month is NULL")).cast("int")
    out = out.withColumns({"_y": F.coalesce(F.col("year").cast("int"), lost), "_m": F.coalesce(F.col("month").cast("int"), lost)})
    staged = f"{prefix.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        (out.repartition("_y", "_m").sortWithinPartitions("_y", "_m", "latitude", "longitude")
            .write.partitionBy("_y", "_m").parquet(staged))
        fs, _ = _file_system(spark, staged)
        path, done = spark._jvm.org.apache.hadoop.fs.Path, []
        for y in _numbers(_visible(spark, staged), "_y"):
            for m in _numbers(_visible(spark, f"{staged}/_y={y}"), "_m"):
                folder = f"{staged}/_y={y}/_m={m}"
                (name,) = [n for n, is_folder in _listed(spark, folder) if not is_folder]
                target = path(published_path(prefix, y, m))
                fs.mkdirs(target.getParent())
                fs.delete(target, True)
                if not fs.rename(path(f"{folder}/{name}"), target):
                    raise OSError(f"write_published: {target} was not moved into place")
                done.append((y, m))
        return done
    finally:
        delete_folder(spark, staged)


def _visible(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    fs, target = _file_system(spark, path)
    return [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)] if fs.exists(target) else []


def valid_coordinates():
    """Condition: latitude and longitude are set and finite."""
    def finite(c):
        x = F.col(c).cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return finite("latitude") & finite("longitude")


def coordinate_check(rows: DataFrame) -> DataFrame:
    """Quality row ``check, passed, violations``: observations without finite coordinates."""
    n = F.count_if(~valid_coordinates())
    return rows.agg(n.alias("_v")).select(
        F.lit("valid_coordinates").alias("check"), (F.col("_v") == 0).alias("passed"),
        F.col("_v").cast("long").alias("violations"))


def ingest_grid(rows: DataFrame, measure: str, primary: str, *, measures: list[str] | None = None,
                kelvin: list[str] | None = None) -> DataFrame:
    """Cleaned observations from long grid rows (the output of ``grid_flatten``):
    kelvin measures converted to celsius, NaN -> NULL on every measure, rows with a
    missing primary measure dropped. Rows without finite coordinates have no cell and are
    dropped too; :func:`coordinate_check` counts them."""
    from tidemart.functions.units import kelvin_to_celsius
    out = rows.where(valid_coordinates())
    for k in kelvin or []:
        out = out.withColumn(k, kelvin_to_celsius(k))
    return drop_missing(out, primary, measures or [measure])
