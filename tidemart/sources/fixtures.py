"""Observation views derived from the driver's test tables.

The test tables carry no coordinates, so gridded observations are derived row by
row (see FIXTURES.md section 2): ``lineitem`` plays the SST source on a 25 x 9
lattice with 0.05 degree jitter, ``orders`` plays the SLA source on the exact
lattice. The same expressions are used by the DuckDB oracle, so both engines see
identical inputs. Literals are written ``e0`` so both engines use DOUBLE.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Derivation of the observation views (shared with the oracle SQL)
RAW_SST_EXPRS = [
    ("year", "cast(year(l_shipdate) as int)"),
    ("month", "cast(month(l_shipdate) as int)"),
    ("latitude", "greatest(-90e0, least(90e0, -90e0 + 7.5e0*(l_partkey%25) + 0.05e0*(l_linenumber%5-2)))"),
    ("longitude", "greatest(-180e0, least(180e0, -180e0 + 45e0*(l_suppkey%9) + 0.05e0*(cast(l_quantity as int)%5-2)))"),
    ("sst_celsius", "l_quantity*0.5e0 - 2e0"),
    ("sea_ice_fraction", "case when l_linenumber = 7 then null else (l_partkey%9)/8e0 end"),
]

RAW_SLA_EXPRS = [
    ("year", "cast(year(o_orderdate) as int)"),
    ("month", "cast(month(o_orderdate) as int)"),
    ("latitude", "-90e0 + 7.5e0*(o_custkey%25)"),
    ("longitude", "-180e0 + 45e0*(o_orderkey%9)"),
    ("sea_level_anomaly_m", "(o_orderkey%401 - 200)/1000e0"),
]

# The SST source delivers kelvin; the fixture's kelvin column is the celsius value
# shifted back, so kelvin_to_celsius can be exercised on real rows.
RAW_SST_KELVIN_EXPR = ("analysed_sst", "l_quantity*0.5e0 + 271.15e0")


# Harder values: rounding ties (multiples of 0.125), latitudes on the zone edges, NaN and
# NULL measures, years in every decade bucket, repeated keys
EDGE_EXPRS = [
    ("year", "cast(1993 + l_orderkey%31 as int)"),
    ("month", "cast(1 + l_partkey%12 as int)"),
    ("latitude", "-90e0 + 0.125e0*(l_partkey%1441)"),
    ("longitude", "-180e0 + 0.125e0*(l_suppkey%2881)"),
    ("sst_celsius", "case when l_linenumber = 5 then cast('NaN' as double) "
                    "when l_linenumber = 6 then null else l_quantity*0.5e0 - 2e0 end"),
    ("sea_ice_fraction", "(l_partkey%9)/8e0"),
]


def select_sql(exprs) -> str:
    return ", ".join(f"{e} as {a}" for a, e in exprs)


# Declared schemas of the two driver tables the views read (no inference job per read).
DRIVER_SCHEMAS = {
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_sst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``year, month, latitude, longitude, sst_celsius, sea_ice_fraction`` per lineitem."""
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {a}" for a, e in RAW_SST_EXPRS])


def edge_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations per lineitem with the values that are easily got wrong."""
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {a}" for a, e in EDGE_EXPRS])


def raw_sst_kelvin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like :func:`raw_sst` but with the source's kelvin measure ``analysed_sst``."""
    exprs = [x for x in RAW_SST_EXPRS if x[0] != "sst_celsius"] + [RAW_SST_KELVIN_EXPR]
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {a}" for a, e in exprs])


def raw_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``year, month, latitude, longitude, sea_level_anomaly_m`` per order."""
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {a}" for a, e in RAW_SLA_EXPRS])
