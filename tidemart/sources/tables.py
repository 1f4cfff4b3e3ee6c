"""Catalog tables partitioned by month, with month-at-a-time replacement.

* :func:`create_tables` (S7) — ``CREATE TABLE IF NOT EXISTS … USING parquet
  PARTITIONED BY (year_month)``; clustering columns are recorded as a table
  property and applied as a sort inside each written partition (Spark does not
  accept ``PARTITIONED BY`` together with ``CLUSTER BY``).
* :func:`delete_insert` (S5) — replace every ``year_month`` present in the new
  result, keep all other months; an empty result changes nothing. Dynamic
  overwrite is an option of the table, so no session setting is switched around a write.
* :func:`create_cell_table`, :func:`write_cells`, :func:`read_cells` (S7, J1) — staged cells in
  buckets of the cell key, so that two such tables join without an exchange.
* :func:`publish_lake`, :func:`create_staged_view` (S6) — an external table over a lake with its
  months registered, and a catalog view on it that other sessions see.
* :func:`append_table` (S4), :func:`create_view` (S6 in one session), :func:`read_table` (S9),
  :func:`ctas_temp` (S11).

A table must not be overwritten from a plan that reads it; stage the new result
in another table (or checkpoint it) first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.calendar import month_date
from tidemart.operators.staging import CELL_KEYS, month_floor
from tidemart.schemas import TABLES
from tidemart.sources.lake import lake_months
from tidemart.sources.scratch import ends, written

_OVERWRITE_OPTION = "partitionOverwriteMode"


def _ddl_type(dt: T.DataType) -> str:
    return dt.simpleString().upper()


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_col: str,
                 cluster_cols: list[str] | None = None, location: str | None = None) -> None:
    db = name.split(".")[0] if "." in name else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    cols = ", ".join(f"{f.name} {_ddl_type(f.dataType)}" for f in schema.fields)
    props = ""
    if cluster_cols:
        props = f" TBLPROPERTIES ('tidemart.cluster_by' = '{','.join(cluster_cols)}')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"OPTIONS ('{_OVERWRITE_OPTION}' = 'dynamic') PARTITIONED BY ({partition_col})"
              + (f" LOCATION '{location}'" if location else "") + props)


def create_tables(spark: SparkSession, prefix: str = "") -> None:
    """The staging SST table and both marts."""
    for name, (schema, part, cluster) in TABLES.items():
        create_table(spark, prefix + name, schema, part, cluster)


def _cluster_cols(spark: SparkSession, table: str) -> list[str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    props = {r["key"]: r["value"] for r in rows}
    val = props.get("tidemart.cluster_by")
    return val.split(",") if val else []


def _aligned(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """Columns in table order with table types (``insertInto`` is positional)."""
    target = spark.table(table).schema
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    cluster = _cluster_cols(spark, table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts:
        # few files per month; adaptive execution splits a month that outgrows a partition
        out = out.hint("rebalance", *parts)
    if not cluster:
        return out
    # the writer needs rows ordered by the partition column; leading with it satisfies
    # that requirement, so no second sort reorders the clustered rows
    return out.sortWithinPartitions(*parts, *[c for c in cluster if c not in parts])


def delete_insert(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace the months (partitions) present in ``df``; keep the others.

    The table itself asks for dynamic overwrite (see :func:`create_table`); a table that
    does not is refused, as the write would delete its other months."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Storage Properties'").collect()
    if not any(f"{_OVERWRITE_OPTION}=dynamic" in r["data_type"] for r in described):
        raise ValueError(f"delete_insert: {table} was not made by create_table with dynamic overwrite")
    _aligned(spark, df, table).write.insertInto(table, overwrite=True)


def append_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append rows (strategy ``append``)."""
    _aligned(spark, df, table).write.insertInto(table, overwrite=False)


def bulk_load_append(spark: SparkSession, paths: list[str], schema: T.StructType, table: str,
                     partition_cols: list[str] | None = None, location: str | None = None) -> None:
    """Load month files (Parquet) into a table with append semantics, without the
    data passing through the driver; the table is created on first use.

    Folders of a partitioned lake (``.../year=Y/month=M``) get their partition values from
    the path. A NULL in a partition column of the schema fails the load."""
    reader = spark.read.schema(schema)
    bases = {p.split("/year=", 1)[0] for p in paths if "/year=" in p}
    if len(bases) > 1:
        raise ValueError(f"bulk_load_append: paths of several lakes: {sorted(bases)}")
    if bases:
        reader = reader.option("basePath", bases.pop())
    df = reader.parquet(*paths)
    for c in ("year", "month", "year_month"):
        if c in df.columns:
            lost = F.raise_error(F.lit(f"bulk_load_append: {c} is NULL")).cast(df.schema[c].dataType)
            df = df.withColumn(c, F.coalesce(F.col(c), lost))
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet")
        if partition_cols:
            writer = writer.partitionBy(*partition_cols)
        if location:
            writer = writer.option("path", location)
        writer.saveAsTable(table)
        return
    append_table(spark, df, table)


def read_published(spark: SparkSession, table: str, schema: T.StructType,
                   refresh: bool = True) -> DataFrame:
    """A layer table in its published column order (Spark stores partition columns last).

    Months are replaced in place by other jobs; ``refresh`` drops this session's cached
    file listing first (``REFRESH TABLE``), so a long-lived reader sees the new files."""
    if refresh:
        spark.catalog.refreshTable(table)
    return spark.table(table).select(*[f.name for f in schema.fields])


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a (temporary) view."""
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A table by name, or the result of a SQL text — kept lazy."""
    text = name_or_sql.strip()
    if " " in text:
        return spark.sql(text)
    return spark.table(text)


def ctas_temp(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """``CREATE TEMP TABLE name AS <sql>``: computed once, written to the shared scratch
    folder and read from there as often as it is used. View and files end with the open
    :func:`tidemart.sources.scratch.lifetime`, or with ``drop_written``."""
    made = create_view(written(spark.sql(sql)), name)
    ends("view", name)
    return made


def create_cell_table(spark: SparkSession, name: str, measures: list[str], buckets: int = 16,
                      location: str | None = None) -> None:
    """S7 for staged cells: partitioned by month, bucketed and sorted by the cell key.

    Tables with the same number of buckets are read as already partitioned on the key: their
    join needs no exchange. A month is written as ``buckets`` files, so the number should be a
    month's size over the wanted file size (0.25 degrees: about 1 M cells a month)."""
    columns = ", ".join([f"{k} INT" for k in CELL_KEYS] + [f"{m} DOUBLE" for m in measures])
    keys = ", ".join(CELL_KEYS)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, year_month DATE) USING parquet "
              f"OPTIONS ('{_OVERWRITE_OPTION}' = 'dynamic') PARTITIONED BY (year_month) "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS{place}")


def _buckets(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed")
    return int(rows[0]["data_type"])


def write_cells(spark: SparkSession, keyed: DataFrame, table: str) -> None:
    """Replace the months of a keyed frame in a cell table (S5); the other months stay.

    Rows are dealt like the buckets, so that a task writes one bucket: one file per month and bucket."""
    buckets, target = _buckets(spark, table), spark.table(table).schema
    out = keyed.withColumn("year_month", month_date("year", "month"))
    out = out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    (out.repartition(buckets, *CELL_KEYS).sortWithinPartitions("year_month", *CELL_KEYS)
        .write.insertInto(table, overwrite=True))


def read_cells(spark: SparkSession, table: str, start=None, end=None) -> DataFrame:
    """A cell table as a keyed frame, bucketed by the cell key; a month range prunes partitions."""
    df = spark.table(table)
    if start is not None:
        df = df.where(F.col("year_month") >= F.lit(month_floor(start)).cast("date"))
    if end is not None:
        df = df.where(F.col("year_month") <= F.lit(str(end)[:10]).cast("date"))
    return df.drop("year_month")


def publish_lake(spark: SparkSession, base: str, schema: T.StructType, table: str) -> int:
    """S6, below the view: an external table over a lake, every month of it registered; how many.

    Run after a write, it registers what is new (one listing per year of the lake)."""
    columns = ", ".join(f"{f.name} {_ddl_type(f.dataType)}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (year, month) LOCATION '{base}'")
    months = lake_months(spark, base)
    for at in range(0, len(months), 500):
        parts = " ".join(f"PARTITION (year = {y}, month = {m})" for y, m in months[at: at + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)
    return len(months)


def create_staged_view(spark: SparkSession, view: str, table: str, measure: str = "sea_level_anomaly_m",
                       step: float = 0.25) -> None:
    """The published staging view as a catalog view, which outlives the session that makes it
    as far as the catalog does. A registered month appears in it without another call."""
    def snapped(c):
        return f"ROUND(CAST({c} AS DOUBLE) / {step}D) * {step}D + 0D AS {c}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT MAKE_DATE(year, month, 1) AS year_month, CAST(year AS BIGINT) AS year, "
              f"CAST(month AS BIGINT) AS month, {snapped('latitude')}, {snapped('longitude')}, AVG({measure}) AS {measure} "
              f"FROM {table} GROUP BY 1, 2, 3, 4, 5")
