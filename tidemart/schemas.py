"""Declared schemas of every layer (never inferred).

Column descriptions and primary-key flags travel in ``StructField.metadata``.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, desc: str = "", pk: bool = False) -> T.StructField:
    meta = {}
    if desc:
        meta["description"] = desc
    if pk:
        meta["primary_key"] = True
    return T.StructField(name, dtype, True, meta)


# --- raw layer (lake, partitioned by year, month) -----------------------------------

RAW_SLA = T.StructType([
    _f("year", T.IntegerType(), "calendar year", pk=True),
    _f("month", T.IntegerType(), "calendar month, 1 to 12", pk=True),
    _f("latitude", T.DoubleType(), "cell centre, degrees north"),
    _f("longitude", T.DoubleType(), "cell centre, degrees east"),
    _f("sea_level_anomaly_m", T.DoubleType(), "height above the mean sea surface, m"),
])

# The SST source ships float32 values on a 0.05 degree grid; they are widened to
# double before any arithmetic (see functions.cells.snap).
RAW_SST = T.StructType([
    _f("year", T.IntegerType(), "calendar year", pk=True),
    _f("month", T.IntegerType(), "calendar month, 1 to 12", pk=True),
    _f("latitude", T.FloatType(), "source point, degrees north"),
    _f("longitude", T.FloatType(), "source point, degrees east"),
    _f("sst_celsius", T.FloatType(), "water temperature, celsius"),
    _f("sea_ice_fraction", T.FloatType(), "share of the cell under ice, 0 to 1"),
])

# --- staging layer ------------------------------------------------------------------

STAGING_SLA = T.StructType([
    _f("year_month", T.DateType(), "month, as its first day"),
    _f("year", T.LongType()),
    _f("month", T.LongType()),
    _f("latitude", T.DoubleType(), "cell centre, degrees north"),
    _f("longitude", T.DoubleType(), "cell centre, degrees east"),
    _f("sea_level_anomaly_m", T.DoubleType(), "height above the mean sea surface, m"),
])

STAGING_SST = T.StructType([
    _f("year_month", T.DateType(), "month, as its first day"),
    _f("year", T.LongType()),
    _f("month", T.LongType()),
    _f("latitude", T.DoubleType(), "cell centre, degrees north"),
    _f("longitude", T.DoubleType(), "cell centre, degrees east"),
    _f("sst_celsius", T.DoubleType(), "mean water temperature of the cell, celsius"),
    _f("sea_ice_fraction", T.DoubleType(), "mean ice share of the cell"),
])

# --- mart layer ---------------------------------------------------------------------

MONTHLY_GLOBAL_TRENDS = T.StructType([
    _f("year_month", T.DateType(), "month, as its first day", pk=True),
    _f("year", T.LongType()),
    _f("month", T.LongType()),
    _f("avg_sla_m", T.DoubleType(), "mean anomaly over all joined cells, m"),
    _f("avg_sst_celsius", T.DoubleType(), "mean temperature over all joined cells, celsius"),
    _f("avg_sea_ice_fraction", T.DoubleType(), "mean ice share over all joined cells"),
    _f("grid_points", T.LongType(), "joined cells of the month"),
])

LATITUDE_ZONE_STATS = T.StructType([
    _f("year_month", T.DateType(), "month, as its first day", pk=True),
    _f("year", T.LongType()),
    _f("month", T.LongType()),
    _f("latitude_zone", T.StringType(), "band of latitudes", pk=True),
    _f("avg_sla_m", T.DoubleType(), "mean anomaly over the joined cells of the band, m"),
    _f("avg_sst_celsius", T.DoubleType(), "mean temperature over the joined cells of the band, celsius"),
    _f("avg_sea_ice_fraction", T.DoubleType(), "mean ice share over the joined cells of the band"),
    _f("grid_points", T.LongType(), "joined cells of the band in the month"),
])

# Table name -> (schema, partition column, clustering columns)
TABLES = {
    "staging.sea_surface_temperature": (STAGING_SST, "year_month", ["year", "month"]),
    "mart.monthly_global_trends": (MONTHLY_GLOBAL_TRENDS, "year_month", ["year", "month"]),
    "mart.latitude_zone_stats": (LATITUDE_ZONE_STATS, "year_month", ["latitude_zone"]),
}

