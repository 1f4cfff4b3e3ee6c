import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import (
    ZONE_NAMES, decade, drop_missing, kelvin_to_celsius, latitude_zone, metres_to_cm, month_date,
    month_label, month_label_to_month, month_label_to_year, month_spine, nan_to_null, snap,
    snap_index, symmetric_limit,
)
from tidemart.functions.cells import GRID_025, cell_coordinate, lat_raster_index, lon_raster_index


def _one(spark, expr, value, dtype=T.DoubleType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    return df.select(expr(F.col("x")).alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("x,expected", [
    (-90.0, -90.0), (180.0, 180.0), (0.13, 0.25),
    # ties round half away from zero, like SQL ROUND
    (0.125, 0.25), (-0.125, -0.25), (0.375, 0.5), (-0.375, -0.5), (0.625, 0.75),
    (-179.875, -180.0), (-0.1, 0.0),
])
def test_snap_cases(spark, x, expected):
    assert _one(spark, snap, x) == expected
    assert _one(spark, lambda c: cell_coordinate(snap_index(c)), x) == expected


def test_snap_is_double_not_decimal(spark):
    df = spark.range(1).select(snap(F.lit(-90.0)).alias("s"))
    assert isinstance(df.schema["s"].dataType, T.DoubleType)


def test_snap_matches_half_away_from_zero_randomised(spark):
    rng = np.random.default_rng(7)
    xs = np.concatenate([rng.uniform(-180, 180, 2000),
                         np.round(rng.uniform(-720, 720, 500)) * 0.25 + 0.125,  # exact ties
                         np.arange(-90, 90.0001, 0.05, dtype=np.float32).astype(float)])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r["s"] for r in df.select(snap("x").alias("s")).collect()]
    q = xs / 0.25
    want = np.sign(q) * np.floor(np.abs(q) + 0.5) * 0.25
    assert np.array_equal(np.array(got), want + 0.0)


def test_float32_is_widened_before_dividing(spark):
    df = spark.createDataFrame([(0.05,)], "x float")
    got = df.select(snap("x").alias("s")).collect()[0]["s"]
    assert got == 0.0


@pytest.mark.parametrize("lat,expected", [
    (90.0, "Arctic"), (66.5, "Arctic"), (66.4, "N. Temperate"), (23.5, "N. Temperate"),
    (0.0, "Tropical"), (-23.5, "Tropical"), (-23.6, "S. Temperate"), (-66.5, "S. Temperate"),
    (-66.6, "Antarctic"), (-90.0, "Antarctic"), (None, "Antarctic"), (float("nan"), "Arctic"),
])
def test_zone_boundaries(spark, lat, expected):
    assert _one(spark, latitude_zone, lat) == expected


def test_zone_names_are_the_five(spark):
    df = spark.createDataFrame([(float(x),) for x in range(-90, 91)], "lat double")
    zones = {r[0] for r in df.select(latitude_zone("lat")).distinct().collect()}
    assert zones == set(ZONE_NAMES)


@pytest.mark.parametrize("year,expected", [
    (1990, "2013-2023"), (1993, "1993-2002"), (2002, "1993-2002"), (2003, "2003-2012"),
    (2012, "2003-2012"), (2013, "2013-2023"), (2023, "2013-2023"),
])
def test_decade_default_edges(spark, year, expected):
    assert _one(spark, decade, year, T.IntegerType()) == expected


def test_decade_custom_edges(spark):
    edges = [(1995, 1996, "a"), (1997, 1998, "b")]
    got = [_one(spark, lambda c: decade(c, edges, "z"), y, T.IntegerType()) for y in (1995, 1998, 1999)]
    assert got == ["a", "b", "z"]


def test_month_date_label_roundtrip(spark):
    df = spark.createDataFrame([(1993, 1), (2023, 12)], "year int, month int")
    out = df.select(month_date("year", "month").alias("d")).select(
        "d", month_label("d").alias("l")).select(
        "d", "l", month_label_to_year("l").alias("y"), month_label_to_month("l").alias("m")).collect()
    assert [(r.d, r.l, r.y, r.m) for r in out] == [
        (dt.date(1993, 1, 1), "1993-01", 1993, 1), (dt.date(2023, 12, 1), "2023-12", 2023, 12)]


def test_invalid_month_raises(spark):
    df = spark.createDataFrame([(2020, 13)], "year int, month int")
    with pytest.raises(Exception):
        df.select(month_date("year", "month")).collect()


def test_month_spine_rollover(spark):
    rows = month_spine(spark, "1993-11-15", "1994-02-02").collect()
    assert [(r.year, r.month) for r in rows] == [(1993, 11), (1993, 12), (1994, 1), (1994, 2)]
    assert len(month_spine(spark, "1993-01-01", "2023-12-31").collect()) == 372


def test_units(spark):
    assert _one(spark, kelvin_to_celsius, 273.15) == 0.0
    assert _one(spark, metres_to_cm, 0.05) == pytest.approx(5.0)


def test_symmetric_limit(spark):
    df = spark.createDataFrame([(-0.3, 0.2)], "a double, b double")
    assert df.select(symmetric_limit("a", "b")).collect()[0][0] == 0.3


def test_nan_to_null_and_drop_missing(spark):
    df = spark.createDataFrame(
        [(1.0, float("nan")), (float("nan"), 1.0), (None, 2.0), (3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(nan_to_null("a")).collect()] == [1.0, None, None, 3.0]
    kept = drop_missing(df, "a", ["b"]).collect()
    assert [(r.a, r.b) for r in kept] == [(1.0, None), (3.0, None)]


def test_raster_index_is_half_even_and_clipped(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (95.0, 200.0), (0.0, 0.0)],
                               "latitude double, longitude double")
    got = df.select(lat_raster_index("latitude", GRID_025), lon_raster_index("longitude", GRID_025)).collect()
    assert [tuple(r) for r in got] == [(0, 0), (720, 1440), (720, 1440), (360, 720)]
    assert not math.isnan(GRID_025.n_cells) and GRID_025.n_cells == 721 * 1441
