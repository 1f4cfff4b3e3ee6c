"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the derived observation views in
``sources.fixtures``) over their whole extent. Double outputs are rounded to 6
digits so that results can be compared across engines (the last ulp of an average
depends on summation order).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.calendar import (
    month_date, month_label, month_label_to_month, month_label_to_year, month_spine, parse_date,
)
from tidemart.functions.cells import GRID_025, GridSpec, lat_raster_index, lon_raster_index, snap
from tidemart.functions.cleaning import drop_missing
from tidemart.functions.units import kelvin_to_celsius
from tidemart.functions.zones import decade, latitude_zone
from tidemart.operators import joins, marts, quality, reshape, series, staging
from tidemart.operators.quantiles import exact_percentiles
from tidemart.operators.trends import linear_trend, month_ordinal, with_fitted
from tidemart.plans import dashboard
from tidemart.sources import fixtures as fx
from tidemart.sources.frames import concat_months, empty_typed, values_table
from tidemart.sources.gridded import grid_flatten, rename_source_columns, tag_month
from tidemart.sources.lake import scan_lake, scan_newest_month, scan_published, write_lake_month, write_published
from tidemart.sources.scratch import ends, scratch_path
from tidemart.sources.tables import (
    append_table, bulk_load_append, create_cell_table, create_staged_view, create_table, ctas_temp, delete_insert,
    publish_lake, read_cells, read_published, read_table, write_cells,
)
from tidemart.schemas import STAGING_SST

Query = Callable[[SparkSession, str], DataFrame]

#: the coarse grid that the fixture's observations lie on
LATTICE = GridSpec(step=45.0)


def round_double(c, digits: int = 6):
    """Round a DOUBLE for cross-engine comparison: first to 12 decimals (absorbs the
    last-ulp noise of a summation order), then half-up to ``digits`` in decimal
    arithmetic, so a value sitting on a rounding tie rounds the same way everywhere.
    NaN and infinities pass through."""
    exact = F.round(c.cast("decimal(38,12)"), digits).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(exact)


def round_any(c):
    """:func:`round_double` before rows are left out: a magnitude beyond its decimals, which has no
    digit to round, passes instead of failing a query whose result does not hold the row."""
    return F.when(F.abs(c) < F.lit(1e25), round_double(c)).otherwise(c)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (order and names kept)."""
    def ref(name):
        return F.col("`" + name.replace("`", "``") + "`")
    return df.select(*[round_double(ref(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else ref(f.name)
                       for f in df.schema.fields])


# --- shared building blocks ---------------------------------------------------------

def _keyed(spark, sf):
    sla = staging.stage_sla(fx.raw_sla(spark, sf))
    sst = staging.regrid_sst(fx.raw_sst(spark, sf))
    return sla, sst


def _monthly(spark, sf, start=None, end=None):
    sla, sst = _keyed(spark, sf)
    return marts.monthly_global_trends(sla, sst, start, end)


def _zones(spark, sf):
    sla, sst = _keyed(spark, sf)
    return marts.latitude_zone_stats(sla, sst)


def _staged_sst(spark, sf):
    return staging.public_cells(staging.regrid_sst(fx.raw_sst(spark, sf)))


def _staged_sla(spark, sf):
    return staging.public_cells(staging.stage_sla(fx.raw_sla(spark, sf)))


def _latest_staged_sst(spark, sf):
    return series.slice_latest_month(_staged_sst(spark, sf))


# --- queries ------------------------------------------------------------------------

def q_snap(spark, sf):
    raw = fx.raw_sst(spark, sf)
    return raw.select("year", "month", "latitude", "longitude",
                      (snap("latitude") + F.lit(0.0)).alias("lat_snap"),
                      (snap("longitude") + F.lit(0.0)).alias("lon_snap"))


def q_calendar(spark, sf):
    raw = fx.raw_sla(spark, sf)
    months = raw.select(month_date("year", "month").alias("year_month")).distinct()
    label = month_label("year_month")
    return months.select(
        "year_month",
        label.alias("month_label"),
        month_label_to_year(label).alias("label_year"),
        month_label_to_month(label).alias("label_month"),
        parse_date(F.concat(label, F.lit("-01"))).alias("parsed_date"),
        F.year("year_month").alias("year"))


def q_latitude_zone(spark, sf):
    return _staged_sla(spark, sf).select(
        "year_month", "latitude", "longitude", latitude_zone("latitude").alias("latitude_zone"))


def q_decade(spark, sf):
    raw = fx.raw_sla(spark, sf)
    return raw.groupBy("year").agg(F.count(F.lit(1)).alias("n_obs")).select(
        "year", decade("year").alias("decade"), "n_obs")


def q_regrid_sst(spark, sf):
    return rounded(_staged_sst(spark, sf))


def q_stage_sla(spark, sf):
    return rounded(_staged_sla(spark, sf))


def q_cell_join(spark, sf):
    sla, sst = _keyed(spark, sf)
    return rounded(staging.public_cells(joins.cell_join(sla, sst)))


def q_monthly_global_trends(spark, sf):
    return rounded(_monthly(spark, sf))


def q_monthly_global_trends_range(spark, sf):
    return rounded(_monthly(spark, sf, "1997-03-15", "1999-06-30"))


def q_latitude_zone_stats(spark, sf):
    return rounded(_zones(spark, sf))


def q_monthly_from_partials(spark, sf):
    """A3 as the batch build computes it: one cell join -> zone partials -> mart."""
    sla, sst = _keyed(spark, sf)
    return rounded(marts.marts_from_partials(marts.zone_partials(sla, sst))[0])


def q_zones_from_partials(spark, sf):
    """A4 as the batch build computes it."""
    sla, sst = _keyed(spark, sf)
    return rounded(marts.marts_from_partials(marts.zone_partials(sla, sst))[1])


def q_decadal_means(spark, sf):
    return rounded(marts.decadal_means(_monthly(spark, sf)))


NARROW_DECADES = [(1995, 1996, "1995-1996"), (1997, 1998, "1997-1998")]


def q_decadal_means_narrow(spark, sf):
    return rounded(marts.decadal_means(_monthly(spark, sf), NARROW_DECADES, "1999-2001"))


def q_raw_cell_join(spark, sf):
    return joins.raw_cell_join(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf), shown=round_any)


def q_raw_monthly_trends(spark, sf):
    return rounded(marts.raw_monthly_trends(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf)))


def q_raw_zone_stats(spark, sf):
    return rounded(marts.raw_zone_stats(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf)))


def q_misaligned_join(spark, sf):
    sla, sst = _keyed(spark, sf)
    # move every SLA cell 5 degrees north and 15 degrees east: off the SST lattice
    return joins.misaligned_join_count(joins.shift_cells(sla, 20, 60), sst)


def q_latest_month(spark, sf):
    return series.latest_month(fx.raw_sla(spark, sf))


def q_sla_map_limits(spark, sf):
    latest = series.slice_latest_month(fx.raw_sla(spark, sf))
    return rounded(dashboard.map_limits(latest, "sea_level_anomaly_m", symmetric=True))


def q_sst_map_limits(spark, sf):
    # the exploration script slices SST with the month found on the SLA table
    s = series.latest_month_value(fx.raw_sla(spark, sf))
    raw = fx.raw_sst(spark, sf)
    latest = raw.where(F.struct(F.col("year").alias("y"), F.col("month").alias("m")) == s)
    return rounded(dashboard.map_limits(latest, "sst_celsius", symmetric=False))


def q_zone_percentiles(spark, sf):
    cells = _staged_sst(spark, sf).withColumn("latitude_zone", latitude_zone("latitude"))
    return rounded(exact_percentiles(cells, "sst_celsius", [0.02, 0.5, 0.98],
                                     names=["p02", "p50", "p98"], by=["latitude_zone"]))


def q_linear_trend(spark, sf):
    return rounded(dashboard.trend_line(_monthly(spark, sf), "avg_sla_m", scale=100.0, prefix="sla_"))


def q_linear_trend_by_zone(spark, sf):
    """A10 per latitude zone, on the year as x."""
    return rounded(linear_trend(_zones(spark, sf), "avg_sst_celsius", "year", by=["latitude_zone"]))


def q_linear_trend_ordinal(spark, sf):
    df = marts.raw_monthly_trends(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf))
    df = month_ordinal(df, "year_month", out="x_ordinal")
    df = with_fitted(df, ["avg_sla_m", "avg_sst_celsius"], "x_ordinal",
                     ["trend_sla_m", "trend_sst_celsius"])
    return rounded(df)


def q_trends(spark, sf):
    return rounded(dashboard.trends(_monthly(spark, sf)))


def q_trends_window(spark, sf):
    return rounded(dashboard.trends(_monthly(spark, sf), year_min=1997, year_max=1999))


def q_decades(spark, sf):
    return rounded(dashboard.decades(_monthly(spark, sf)))


def q_zones(spark, sf):
    return rounded(dashboard.zones(_zones(spark, sf)))


def q_zone_markers(spark, sf):
    return rounded(dashboard.zone_markers(_zones(spark, sf)))


def q_distinct_zones(spark, sf):
    return series.distinct_values(_zones(spark, sf), "latitude_zone")


def q_sorted_axis(spark, sf):
    return series.sorted_axis(fx.raw_sst(spark, sf), "longitude")


def q_raster_index(spark, sf):
    cells = _staged_sst(spark, sf)
    return cells.select("year_month", "latitude", "longitude",
                        lat_raster_index("latitude", GRID_025).alias("lat_i"),
                        lon_raster_index("longitude", GRID_025).alias("lon_i"))


def q_sst_map(spark, sf):
    """The full 721 x 1441 grid of the newest staged month, long form."""
    return rounded(reshape.dense_fill(_latest_staged_sst(spark, sf), "sst_celsius", GRID_025, unique_cells=True))


def q_sst_map_month(spark, sf):
    """D4 by (year, month): raster rows of one staged month, cells without a value left out."""
    raster = dashboard.sst_map(_staged_sst(spark, sf), 1997, 6)
    flat = grid_flatten(raster, "values", "sst_celsius", lon_min=GRID_025.lon_min, step=GRID_025.step,
                        keep=["year_month", "latitude"])
    return rounded(drop_missing(flat, "sst_celsius"))


def q_grid_flatten(spark, sf):
    """Dense raster rows of the newest month flattened back to observations."""
    raster = reshape.dense_raster(_latest_staged_sst(spark, sf), "sst_celsius", GRID_025)
    flat = grid_flatten(raster, "values", "sst_celsius", lon_min=GRID_025.lon_min,
                        step=GRID_025.step, keep=["year_month", "latitude"])
    return rounded(drop_missing(flat, "sst_celsius"))


def q_grid_flatten_two(spark, sf):
    """S12 with two variables: raster rows of both measures zipped and exploded once."""
    latest = _latest_staged_sst(spark, sf)
    rows = (reshape.dense_raster(latest, "sst_celsius", GRID_025).withColumnRenamed("values", "sst")
            .join(reshape.dense_raster(latest, "sea_ice_fraction", GRID_025)
                  .select("year_month", "lat_i", F.col("values").alias("ice")), ["year_month", "lat_i"]))
    flat = grid_flatten(rows, ["sst", "ice"], ["sst_celsius", "sea_ice_fraction"], lon_min=GRID_025.lon_min,
                        step=GRID_025.step, keep=["year_month", "latitude"])
    return rounded(drop_missing(flat, "sst_celsius", ["sst_celsius", "sea_ice_fraction"]))


def q_scan_range(spark, sf):
    """The raw SST observations written as a lake and read back for a range that
    begins and ends inside a month."""
    base = scratch_path(spark, "lake")
    raw = fx.raw_sst(spark, sf)
    write_lake_month(raw, base)
    back = scan_lake(spark, base, raw.schema, "1996-11-15", "1997-02-02")
    return rounded(back.select(*raw.columns))


def q_published_range(spark, sf):
    """S1 / S3 in the published layout: one object per month, read for the same range."""
    prefix = scratch_path(spark, "published")
    raw = fx.raw_sst(spark, sf)
    write_published(raw, prefix)
    return rounded(scan_published(spark, prefix, raw.schema, "1996-11-15", "1997-02-02"))


def q_newest_month_slice(spark, sf):
    """A8 / F4 on a lake: the newest month, found by listing folders."""
    base = scratch_path(spark, "lake")
    raw = fx.raw_sla(spark, sf)
    write_lake_month(raw, base)
    return rounded(scan_newest_month(spark, base, raw.schema))


def _table(spark, kind: str) -> tuple[str, str]:
    """Name and folder of a table that ends with the open lifetime."""
    place = scratch_path(spark, kind)
    name = f"tidemart_{kind}_{uuid.uuid4().hex}"
    ends("table", name)
    return name, place


def q_bucketed_join(spark, sf):
    """Both variables staged into bucketed tables, read back and joined in place."""
    sides = []
    for keyed, measures in zip(_keyed(spark, sf), (["sea_level_anomaly_m"], ["sst_celsius", "sea_ice_fraction"])):
        name, place = _table(spark, "cells")
        create_cell_table(spark, name, measures, buckets=4, location=place)
        write_cells(spark, keyed, name)
        sides.append(read_cells(spark, name))
    return rounded(staging.public_cells(joins.cell_join(*sides)))


def q_staged_view(spark, sf):
    """The staging view of the catalog, over an external table on the raw lake."""
    base = scratch_path(spark, "lake")
    raw = fx.raw_sla(spark, sf)
    write_lake_month(raw, base)
    name, _ = _table(spark, "lake_table")
    publish_lake(spark, base, raw.schema, name)
    create_staged_view(spark, f"{name}_staged", name)
    ends("catalog view", f"{name}_staged")
    return rounded(spark.table(f"{name}_staged"))


def q_ctas_table(spark, sf):
    """A computed-once temporary table, read twice by name."""
    source, name = (f"tidemart_{k}_{uuid.uuid4().hex}" for k in ("source", "ctas"))
    fx.raw_sla(spark, sf).createOrReplaceTempView(source)
    ends("view", source)
    ctas_temp(spark, name, f"SELECT year, month, count(*) AS n, max(sea_level_anomaly_m) AS top FROM {source} GROUP BY year, month")
    years = read_table(spark, f"SELECT year, sum(n) AS year_n FROM {name} GROUP BY year")
    return rounded(read_table(spark, name).join(years, "year").select("year", "month", "n", "year_n", "top"))


def q_month_replacement(spark, sf):
    """Staged SST appended to a table, then the months of one year replaced."""
    name, place = _table(spark, "staged")
    staged = _staged_sst(spark, sf)
    create_table(spark, name, STAGING_SST, "year_month", ["year", "month"], location=place)
    append_table(spark, staged, name)
    delete_insert(spark, staged.where("year = 1996 AND latitude >= 0").withColumn("sst_celsius", F.col("sst_celsius") + 100), name)
    return rounded(read_published(spark, name, STAGING_SST))


def q_bulk_load(spark, sf):
    """The month folders of a lake loaded into a table twice, as a re-run does."""
    base = scratch_path(spark, "lake")
    raw = fx.raw_sla(spark, sf)
    write_lake_month(raw, base)
    name, place = _table(spark, "loaded")
    for _ in range(2):
        bulk_load_append(spark, [f"{base}/year={y}" for y in (1995, 1997)], raw.schema, name, location=place)
    return rounded(spark.table(name).select(*raw.columns))


def q_rename_tag(spark, sf):
    """Source names to published names, one month's rows tagged with year and month."""
    raw = series.slice_month(fx.raw_sst_kelvin(spark, sf), 1997, 6).drop("year", "month")
    return rounded(tag_month(rename_source_columns(raw.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})), 1997, 6))


def q_trends_ordered(spark, sf):
    """O1: the order of the D1 series, as the position of each month in the sorted result."""
    ordered = dashboard.trends(_monthly(spark, sf), ordered=True).select("year_month")
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return ordered.withColumn("position", place.cast("long"))


def q_raw_cell_join_filtered(spark, sf):
    """J2 with the key filter before the shuffle of the larger side."""
    return joins.raw_cell_join(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf), prefilter=True, shown=round_any)


def q_concat_months(spark, sf):
    """UNION ALL of three month slices, of which one is empty."""
    raw = fx.raw_sla(spark, sf)
    return rounded(concat_months([series.slice_month(raw, y, m) for y, m in ((1995, 3), (1996, 4), (2050, 1))]))


def q_values_join(spark, sf):
    """An inline table of zone codes joined to the zones of the mart."""
    codes = values_table(spark, [("Arctic", 1), ("Tropical", 3), ("Antarctic", 5), ("Nowhere", 9)],
                         "latitude_zone string, code int")
    return _zones(spark, sf).groupBy("latitude_zone").agg(F.count(F.lit(1)).alias("months")).join(codes, "latitude_zone")


def q_zone_slice(spark, sf):
    """one zone of the mart."""
    return rounded(_zones(spark, sf).where(F.col("latitude_zone") == "Tropical"))


def q_point_lookup(spark, sf):
    """the series of one cell, looked up by its integer key."""
    _, sst = _keyed(spark, sf)
    return rounded(staging.public_cells(staging.point_lookup(sst, 7.5, -45.0)))


def q_sst_raster_rows(spark, sf):
    """R2 / D4 as raster rows: 721 rows of 1441 values (NaN where no cell) for the newest
    staged month."""
    return reshape.dense_raster(rounded(_latest_staged_sst(spark, sf)), "sst_celsius", GRID_025)


def q_zone_series_arrays(spark, sf):
    """R3 array form: one month-ordered series per zone, as two parallel arrays."""
    arrays = reshape.zone_series_arrays(rounded(_zones(spark, sf)), "avg_sst_celsius")
    return arrays.select("latitude_zone", F.transform("series", lambda x: F.date_format(x["year_month"], "yyyy-MM-dd")).alias("months"),
                         F.transform("series", lambda x: x["avg_sst_celsius"]).alias("avg_sst_celsius"))


def q_latest_sla_grid(spark, sf):
    """Pivot of the newest month of staged SLA (one column per longitude)."""
    latest = series.slice_latest_month(_staged_sla(spark, sf))
    return rounded(dashboard.latest_map(latest, "sea_level_anomaly_m", col_values=LATTICE.lon_axis))


def q_latest_sst_grid(spark, sf):
    """Pivot of the staged SST in the newest month of SLA. The pivot needs unique
    cells, so the staged month is taken, not the raw one."""
    ym = series.latest_month_value(fx.raw_sla(spark, sf))
    staged = _staged_sst(spark, sf)
    latest = staged.where(F.struct(F.col("year").cast("int").alias("y"), F.col("month").cast("int").alias("m")) == ym)
    return rounded(dashboard.latest_map(latest, "sst_celsius", col_values=LATTICE.lon_axis))


def q_quality_checks(spark, sf):
    sla, sst = _keyed(spark, sf)
    return quality.partials_checks(marts.zone_partials(sla, sst))


def q_quality_checks_marts(spark, sf):
    """The same six checks, each over the finished mart tables."""
    sla, sst = _keyed(spark, sf)
    return quality.mart_checks(*marts.marts_from_partials(marts.zone_partials(sla, sst)))


def q_edge_regrid(spark, sf):
    """A1 over coordinates on rounding ties, NaN and NULL measures dropped first."""
    return rounded(staging.public_cells(staging.regrid_sst(drop_missing(fx.edge_obs(spark, sf), "sst_celsius"))))


def q_edge_zones(spark, sf):
    """P9 / P10 on zone edges and in every decade."""
    obs = fx.edge_obs(spark, sf).select(latitude_zone("latitude").alias("latitude_zone"), decade("year").alias("decade"),
                                        (F.abs("latitude").isin(66.5, 23.5)).alias("on_edge"))
    return obs.groupBy("latitude_zone", "decade", "on_edge").agg(F.count(F.lit(1)).alias("n"))


def q_edge_percentiles(spark, sf):
    """A9 with NaN and NULL values and a group that has no valid one."""
    obs = fx.edge_obs(spark, sf).select(
        F.when(F.col("month") < 12, F.col("month")).alias("grp"),
        F.when(F.col("month") != 3, F.col("sst_celsius")).alias("v"))
    return rounded(exact_percentiles(obs, "v", [0.02, 0.5, 0.98], names=["p02", "p50", "p98"], by=["grp"]))


def q_edge_checks(spark, sf):
    """Q1-Q5, each on data that breaks it."""
    obs = fx.edge_obs(spark, sf)
    zones = obs.select(latitude_zone("latitude").alias("latitude_zone"))
    checks = [quality.check_unique(obs, ["year", "month"]), quality.check_not_null(obs, "sst_celsius"),
              quality.check_accepted_values(zones, "latitude_zone", ["Arctic", "Tropical"]),
              quality.check_positive(obs.select((F.col("year") - 2000).alias("v")), "v"),
              quality.check_not_empty(obs.where("year < 1900"))]
    return reduce(DataFrame.unionByName, checks)


def q_check_unique(spark, sf):
    return quality.check_unique(_monthly(spark, sf), ["year_month"])


def q_check_not_null(spark, sf):
    return quality.check_not_null(_monthly(spark, sf), "year_month")


def q_check_accepted_values(spark, sf):
    return quality.check_accepted_values(_zones(spark, sf), "latitude_zone")


def q_check_positive(spark, sf):
    return quality.check_positive(_monthly(spark, sf), "grid_points")


def q_check_not_empty(spark, sf):
    return quality.check_not_empty(_monthly(spark, sf))


def q_empty_typed(spark, sf):
    return rounded(empty_typed(spark, STAGING_SST).unionByName(_staged_sst(spark, sf)))


def q_month_spine(spark, sf):
    orders = fx.table(spark, sf, "orders")
    bounds = orders.agg(F.min("o_orderdate").cast("date").alias("start"),
                        F.max("o_orderdate").cast("date").alias("end"))
    return month_spine(bounds)


def q_kelvin_to_celsius(spark, sf):
    raw = fx.raw_sst_kelvin(spark, sf)
    return rounded(raw.select("year", "month", "latitude", "longitude",
                              kelvin_to_celsius("analysed_sst").alias("sst_celsius")))


def q_drop_missing(spark, sf):
    raw = fx.raw_sst(spark, sf)
    return rounded(drop_missing(raw, "sea_ice_fraction"))


QUERIES: dict[str, Query] = {
    "snap": q_snap,
    "calendar": q_calendar,
    "latitude_zone": q_latitude_zone,
    "decade": q_decade,
    "regrid_sst": q_regrid_sst,
    "stage_sla": q_stage_sla,
    "cell_join": q_cell_join,
    "monthly_global_trends": q_monthly_global_trends,
    "monthly_global_trends_range": q_monthly_global_trends_range,
    "latitude_zone_stats": q_latitude_zone_stats,
    "monthly_from_partials": q_monthly_from_partials,
    "zones_from_partials": q_zones_from_partials,
    "decadal_means": q_decadal_means,
    "decadal_means_narrow": q_decadal_means_narrow,
    "raw_cell_join": q_raw_cell_join,
    "raw_monthly_trends": q_raw_monthly_trends,
    "raw_zone_stats": q_raw_zone_stats,
    "misaligned_join": q_misaligned_join,
    "latest_month": q_latest_month,
    "sla_map_limits": q_sla_map_limits,
    "sst_map_limits": q_sst_map_limits,
    "zone_percentiles": q_zone_percentiles,
    "linear_trend": q_linear_trend,
    "linear_trend_ordinal": q_linear_trend_ordinal,
    "trends": q_trends,
    "trends_window": q_trends_window,
    "decades": q_decades,
    "zones": q_zones,
    "zone_markers": q_zone_markers,
    "distinct_zones": q_distinct_zones,
    "sorted_axis": q_sorted_axis,
    "raster_index": q_raster_index,
    "sst_map": q_sst_map,
    "grid_flatten": q_grid_flatten,
    "sst_map_month": q_sst_map_month,
    "grid_flatten_two": q_grid_flatten_two,
    "scan_range": q_scan_range,
    "published_range": q_published_range,
    "newest_month_slice": q_newest_month_slice,
    "bucketed_join": q_bucketed_join,
    "staged_view": q_staged_view,
    "ctas_table": q_ctas_table,
    "month_replacement": q_month_replacement,
    "bulk_load": q_bulk_load,
    "rename_tag": q_rename_tag,
    "trends_ordered": q_trends_ordered,
    "raw_cell_join_filtered": q_raw_cell_join_filtered,
    "concat_months": q_concat_months,
    "values_join": q_values_join,
    "zone_slice": q_zone_slice,
    "point_lookup": q_point_lookup,
    "linear_trend_by_zone": q_linear_trend_by_zone,
    "sst_raster_rows": q_sst_raster_rows,
    "zone_series_arrays": q_zone_series_arrays,
    "latest_sla_grid": q_latest_sla_grid,
    "latest_sst_grid": q_latest_sst_grid,
    "quality_checks": q_quality_checks,
    "quality_checks_marts": q_quality_checks_marts,
    "edge_regrid": q_edge_regrid,
    "edge_zones": q_edge_zones,
    "edge_percentiles": q_edge_percentiles,
    "edge_checks": q_edge_checks,
    "check_unique": q_check_unique,
    "check_not_null": q_check_not_null,
    "check_accepted_values": q_check_accepted_values,
    "check_positive": q_check_positive,
    "check_not_empty": q_check_not_empty,
    "empty_typed": q_empty_typed,
    "month_spine": q_month_spine,
    "kelvin_to_celsius": q_kelvin_to_celsius,
    "drop_missing": q_drop_missing,
}
