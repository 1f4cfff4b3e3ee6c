import datetime as dt
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.functions.cells import GridSpec
from tidemart.functions.cleaning import drop_missing
from tidemart.operators import reshape, series
from tidemart.sources.gridded import grid_flatten, split_rows

SMALL = GridSpec(step=0.25, lat_min=-0.25, lat_max=0.25, lon_min=10.0, lon_max=10.5)  # 3 x 3


def _cells(spark, rows):
    return spark.createDataFrame(
        [(dt.date(1993, 1, 1), la, lo, v) for la, lo, v in rows],
        "year_month date, latitude double, longitude double, sst_celsius double")


def test_dense_raster_matches_numpy(spark):
    rows = [(0.0, 10.0, 26.5), (0.25, 10.5, 3.0), (-0.25, 10.25, -1.0)]
    r = reshape.dense_raster(_cells(spark, rows), "sst_celsius", SMALL).orderBy("lat_i").collect()
    grid = np.full((SMALL.n_lat, SMALL.n_lon), np.nan)
    for la, lo, v in rows:
        grid[int(np.round((la - SMALL.lat_min) / 0.25)), int(np.round((lo - SMALL.lon_min) / 0.25))] = v
    got = np.array([row["values"] for row in r])
    assert got.shape == grid.shape
    assert np.array_equal(np.isnan(got), np.isnan(grid))
    assert np.allclose(got[~np.isnan(got)], grid[~np.isnan(grid)])
    assert [row.latitude for row in r] == [-0.25, 0.0, 0.25]


def test_dense_fill_has_every_cell(spark):
    out = reshape.dense_fill(_cells(spark, [(0.0, 10.0, 1.0)]), "sst_celsius", SMALL).collect()
    assert len(out) == SMALL.n_cells
    present = [r for r in out if not math.isnan(r.sst_celsius)]
    assert [(r.latitude, r.longitude, r.sst_celsius) for r in present] == [(0.0, 10.0, 1.0)]


def test_two_by_two_grid_with_one_nan_flattens_to_three_rows(spark):
    df = spark.createDataFrame(
        [(1993, 1, [10.0, 10.25], [0.0, 0.25], [[1.0, 2.0], [float("nan"), 4.0]])],
        "year int, month int, lon array<double>, lat array<double>, grid array<array<double>>")
    rows = split_rows(df, "grid", "lat", ["year", "month", "lon"])
    flat = grid_flatten(rows, "values", "v", lon_axis_col="lon", keep=["year", "month", "latitude"])
    assert flat.count() == 4
    kept = sorted((r.latitude, r.longitude, r.v) for r in drop_missing(flat, "v").collect())
    assert kept == [(0.0, 10.0, 1.0), (0.0, 10.25, 2.0), (0.25, 10.25, 4.0)]


def test_raster_roundtrip(spark):
    rows = [(0.0, 10.0, 26.5), (0.25, 10.5, 3.0)]
    raster = reshape.dense_raster(_cells(spark, rows), "sst_celsius", SMALL)
    flat = drop_missing(grid_flatten(raster, "values", "sst_celsius", lon_min=SMALL.lon_min,
                                     step=SMALL.step, keep=["latitude"]), "sst_celsius")
    assert sorted(tuple(r) for r in flat.collect()) == sorted(rows)


def test_pivot_grid(spark):
    df = _cells(spark, [(0.0, 10.0, 1.0), (0.0, 10.25, 2.0), (0.25, 10.0, 3.0)])
    p = reshape.pivot_grid(df, "sst_celsius", col_values=[10.0, 10.25]).orderBy("latitude").collect()
    assert [tuple(r) for r in p] == [(0.0, 1.0, 2.0), (0.25, 3.0, None)]
    discovered = reshape.pivot_grid(df, "sst_celsius").columns
    assert discovered == ["latitude", "10.0", "10.25"]


def test_pivot_grid_rejects_duplicates(spark):
    df = _cells(spark, [(0.0, 10.0, 1.0), (0.0, 10.0, 2.0)])
    with pytest.raises(Exception, match="duplicate cell"):
        reshape.pivot_grid(df, "sst_celsius", col_values=[10.0]).collect()


def test_latest_month_uses_year_then_month(spark):
    df = spark.createDataFrame([(2022, 12), (2023, 2), (2023, 1), (2021, 11)], "year int, month int")
    r = series.latest_month(df).collect()[0]
    assert (r.latest_year, r.latest_month) == (2023, 2)
    assert series.slice_latest_month(df).count() == 1


def test_first_point_per_zone(spark):
    df = spark.createDataFrame([(dt.date(1993, 2, 1), "Arctic", 2.0), (dt.date(1993, 1, 1), "Arctic", 1.0),
                                (dt.date(1993, 3, 1), "Tropical", 5.0)],
                               "year_month date, latitude_zone string, avg_sst_celsius double")
    got = {r.latitude_zone: (r.first_month, r.first_avg_sst_celsius)
           for r in series.first_point_per_zone(df).collect()}
    assert got == {"Arctic": (dt.date(1993, 1, 1), 1.0), "Tropical": (dt.date(1993, 3, 1), 5.0)}


def test_zone_series_arrays_are_month_ordered(spark):
    df = spark.createDataFrame([(dt.date(1993, 2, 1), "Arctic", 2.0), (dt.date(1993, 1, 1), "Arctic", 1.0)],
                               "year_month date, latitude_zone string, avg_sst_celsius double")
    s = reshape.zone_series_arrays(df).collect()[0].series
    assert [e.avg_sst_celsius for e in s] == [1.0, 2.0]


def test_sorted_axis(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (2.0,)], "longitude double")
    assert [r[0] for r in series.sorted_axis(df, "longitude").collect()] == [1.0, 2.0, 3.0]


def test_clipping_collision_is_deterministic(spark):
    df = _cells(spark, [(0.5, 10.0, 1.0), (0.75, 10.0, 2.0)])  # both clip to the top row
    cells = reshape.raster_cells(df, "sst_celsius", SMALL).collect()
    assert len(cells) == 1 and cells[0].sst_celsius == 2.0
    assert F is not None


def test_rename_and_tag_month(spark):
    from tidemart.sources.gridded import rename_source_columns, tag_month
    df = spark.createDataFrame([(1.0, 2.0, 280.0)], "lat double, lon double, analysed_sst double")
    out = tag_month(rename_source_columns(df), 1993, 1)
    assert out.columns == ["latitude", "longitude", "sst_celsius", "year", "month"]
    assert out.schema["year"].dataType.simpleString() == "int"


def test_dense_raster_skips_cells_without_coordinates(spark):
    df = spark.createDataFrame([(dt.date(1993, 1, 1), 0.0, 10.0, 1.0), (dt.date(1993, 1, 1), 0.0, None, 2.0)],
                               "year_month date, latitude double, longitude double, sst_celsius double")
    r = reshape.dense_raster(df, "sst_celsius", SMALL).orderBy("lat_i").collect()
    assert len(r) == SMALL.n_lat and r[1]["values"][0] == 1.0


def test_dense_raster_without_coordinates_leaves_every_other_cell_empty(spark):
    grid = GridSpec(step=0.5, lat_min=0.0, lat_max=1.0, lon_min=10.0, lon_max=11.0)
    obs = spark.createDataFrame([(None, 10.5, 1.0), (0.5, None, 2.0), (1.0, 10.0, 3.0)],
                                "latitude double, longitude double, v double").withColumn("year_month", F.lit("m"))
    rows = {r.lat_i: [None if math.isnan(x) else x for x in r["values"]] for r in reshape.dense_raster(obs, "v", grid).collect()}
    assert rows == {0: [None] * 3, 1: [None] * 3, 2: [3.0, None, None]}


def test_pivot_grid_refuses_a_cell_off_the_axis(spark):
    for lon in (99.0, None):
        df = spark.createDataFrame([(0.0, 10.0, 1.0), (0.0, lon, 2.0)], "latitude double, longitude double, v double")
        with pytest.raises(PySparkException, match="off the axis"):
            reshape.pivot_grid(df, "v", col_values=[10.0, 11.0]).collect()
