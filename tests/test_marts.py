import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import RAW_SLA_SCHEMA, RAW_SST_SCHEMA
from tidemart.functions.zones import ZONE_NAMES
from tidemart.operators import joins, marts, quality, staging
from tidemart.plans.inspect import count_exchanges


def _stage(raw_sla, raw_sst):
    return staging.stage_sla(raw_sla), staging.regrid_sst(raw_sst)


def test_regrid_four_points_to_one_cell(raw_sst):
    cells = staging.public_cells(staging.regrid_sst(raw_sst))
    hit = cells.where((F.col("latitude") == 0.0) & (F.col("longitude") == 10.0)).collect()
    assert len(hit) == 1
    assert abs(hit[0]["sst_celsius"] - 26.5) < 1e-9
    assert cells.count() == 2


def test_staging_schema(raw_sst):
    cells = staging.public_cells(staging.regrid_sst(raw_sst))
    assert [(f.name, f.dataType.simpleString()) for f in cells.schema.fields] == [
        ("year_month", "date"), ("year", "bigint"), ("month", "bigint"), ("latitude", "double"),
        ("longitude", "double"), ("sst_celsius", "double"), ("sea_ice_fraction", "double")]


def test_all_zones_are_known(raw_sst):
    from tidemart.functions.zones import latitude_zone
    cells = staging.public_cells(staging.regrid_sst(raw_sst))
    zones = {r[0] for r in cells.select(latitude_zone("latitude")).distinct().collect()}
    assert zones <= set(ZONE_NAMES)


def test_monthly_mart_invariants(raw_sla, raw_sst):
    sla, sst = _stage(raw_sla, raw_sst)
    m = marts.monthly_global_trends(sla, sst)
    rows = m.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.year_month == dt.date(1993, 1, 1) and r.year == 1993 and r.month == 1
    assert r.grid_points == 2
    assert r.avg_sla_m == pytest.approx((0.05 + 0.12) / 2)
    assert r.avg_sst_celsius == pytest.approx((26.5 - 1.5) / 2)
    assert r.avg_sea_ice_fraction == pytest.approx(0.4)
    checks = {c.check: c.passed for c in quality.mart_checks(m, marts.latitude_zone_stats(sla, sst)).collect()}
    assert all(checks.values()), checks


def test_zone_mart(raw_sla, raw_sst):
    sla, sst = _stage(raw_sla, raw_sst)
    z = {r.latitude_zone: r for r in marts.latitude_zone_stats(sla, sst).collect()}
    assert set(z) == {"Tropical", "Arctic"}
    assert z["Arctic"].avg_sst_celsius == -1.5 and z["Arctic"].grid_points == 1
    assert z["Tropical"].avg_sst_celsius == 26.5


def test_misaligned_join_is_empty(spark, raw_sst):
    sla_offset = spark.createDataFrame([(1993, 2, 5.0, 15.0, 0.03)], RAW_SLA_SCHEMA)
    n = joins.misaligned_join_count(staging.stage_sla(sla_offset), staging.regrid_sst(raw_sst))
    assert n.collect()[0].joined_rows == 0


def test_null_and_nan_measures(spark):
    sst = spark.createDataFrame([
        (1993, 1, 0.0, 0.0, 10.0, None), (1993, 1, 0.0, 0.0, 20.0, 0.5)], RAW_SST_SCHEMA)
    sla = spark.createDataFrame([(1993, 1, 0.0, 0.0, None), (1993, 1, 0.25, 0.0, 0.2)], RAW_SLA_SCHEMA)
    sst2 = spark.createDataFrame([(1993, 1, 0.25, 0.0, 5.0, None)], RAW_SST_SCHEMA)
    m = marts.monthly_global_trends(staging.stage_sla(sla), staging.regrid_sst(sst.unionByName(sst2))).collect()[0]
    # COUNT(*) counts both joined cells, AVG skips the NULL SLA and the NULL ice
    assert m.grid_points == 2
    assert m.avg_sla_m == pytest.approx(0.2)
    assert m.avg_sst_celsius == pytest.approx((15.0 + 5.0) / 2)
    assert m.avg_sea_ice_fraction == pytest.approx(0.5)


def test_nan_is_nulled_at_ingest_not_in_sql(spark):
    from tidemart.functions.cleaning import drop_missing
    sst = spark.createDataFrame([(1993, 1, 0.0, 0.0, 10.0, float("nan")),
                                 (1993, 1, 0.0, 0.0, float("nan"), 0.5)], RAW_SST_SCHEMA)
    clean = drop_missing(sst, "sst_celsius", ["sea_ice_fraction"])
    cell = staging.regrid_sst(clean).collect()[0]
    assert cell.sst_celsius == 10.0 and cell.sea_ice_fraction is None
    raw = staging.regrid_sst(sst).collect()[0]
    assert math.isnan(raw.sst_celsius)


def test_empty_input_gives_empty_mart(spark):
    sla = spark.createDataFrame([], RAW_SLA_SCHEMA)
    sst = spark.createDataFrame([], RAW_SST_SCHEMA)
    assert marts.monthly_global_trends(staging.stage_sla(sla), staging.regrid_sst(sst)).count() == 0
    checks = {c.check: c.passed for c in quality.mart_checks(
        marts.monthly_global_trends(staging.stage_sla(sla), staging.regrid_sst(sst))).collect()}
    assert checks["monthly.not_empty"] is False


def test_month_appended_twice_is_hidden_by_staging(raw_sla, raw_sst):
    sla, sst = _stage(raw_sla, raw_sst)
    once = marts.monthly_global_trends(sla, sst).collect()
    sla2, sst2 = _stage(raw_sla.unionByName(raw_sla), raw_sst.unionByName(raw_sst))
    twice = marts.monthly_global_trends(sla2, sst2).collect()
    assert once == twice


def test_month_range_filter(spark):
    rows = [(1993, m, 0.0, 0.0, float(m), 0.0) for m in range(1, 13)]
    sst = spark.createDataFrame(rows, RAW_SST_SCHEMA)
    sla = spark.createDataFrame([(y, m, 0.0, 0.0, 0.1) for (y, m, *_rest) in rows], RAW_SLA_SCHEMA)
    m = marts.monthly_global_trends(staging.stage_sla(sla), staging.regrid_sst(sst),
                                    "1993-03-15", "1993-06-30")
    assert sorted(r.month for r in m.collect()) == [4, 5, 6]


def test_raw_join_needs_exact_coordinates(raw_sla, raw_sst):
    joined = joins.raw_cell_join(raw_sla, raw_sst).collect()
    assert sorted((r.latitude, r.longitude) for r in joined) == [(0.0, 10.0), (70.0, 20.0)]
    per_month = marts.raw_monthly_trends(raw_sla, raw_sst).collect()[0]
    assert per_month.avg_sst_celsius == pytest.approx((25.0 - 1.5) / 2)


def test_check_unique_detects_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    r = quality.check_unique(df, ["k"]).collect()[0]
    assert r.passed is False and r.violations == 2


def test_check_accepted_values_rejects_null(spark):
    df = spark.createDataFrame([("Arctic",), (None,), ("Mars",)], "latitude_zone string")
    r = quality.check_accepted_values(df, "latitude_zone").collect()[0]
    assert r.violations == 2


def test_flagship_plan_has_three_exchanges(spark):
    """Integer cell keys let the join reuse the staging aggregates' partitioning."""
    from tidemart.sources import fixtures as fx
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sf = "/root/testdata/sf0.001"
        m = marts.monthly_global_trends(staging.stage_sla(fx.raw_sla(spark, sf)),
                                        staging.regrid_sst(fx.raw_sst(spark, sf)))
        assert count_exchanges(m) == 3
        z = marts.latitude_zone_stats(staging.stage_sla(fx.raw_sla(spark, sf)),
                                      staging.regrid_sst(fx.raw_sst(spark, sf)))
        assert count_exchanges(z) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_fixture_counts_match_survey(spark):
    from tidemart.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    sla, sst = staging.stage_sla(fx.raw_sla(spark, sf)), staging.regrid_sst(fx.raw_sst(spark, sf))
    assert sst.count() == 5056 and sla.count() == 1441
    j = joins.cell_join(sla, sst)
    assert j.count() == 406 and j.select("year", "month").distinct().count() == 79
    assert joins.raw_cell_join(fx.raw_sla(spark, sf), fx.raw_sst(spark, sf)).count() == 55


def test_marts_from_partials_equal_direct_marts(spark):
    from tidemart.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    sla, sst = staging.stage_sla(fx.raw_sla(spark, sf)), staging.regrid_sst(fx.raw_sst(spark, sf))
    monthly, zones = marts.marts_from_partials(marts.zone_partials(sla, sst))
    direct_m = marts.monthly_global_trends(sla, sst)
    direct_z = marts.latitude_zone_stats(sla, sst)
    assert monthly.columns == direct_m.columns and zones.columns == direct_z.columns

    def close(a, b):
        assert len(a) == len(b)
        for ra, rb in zip(sorted(a), sorted(b)):
            for x, y in zip(ra, rb):
                assert (x == y) or (x is not None and y is not None and abs(x - y) < 1e-12)
    close(monthly.collect(), direct_m.collect())
    close(zones.collect(), direct_z.collect())


def test_hot_month_is_spread_over_reducers(spark):
    """A month holding most rows is not one task: staging shuffles on the cell key."""
    rows = [(1993, 1, (i % 400) * 0.25 - 50.0, (i // 400) * 0.25, 1.0, 0.0) for i in range(24000)]
    rows += [(1993, m, 0.0, 0.0, 1.0, 0.0) for m in range(2, 13) for _ in range(100)]
    sst = spark.createDataFrame(rows, RAW_SST_SCHEMA)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = staging.regrid_sst(sst)
        sizes = [r["n"] for r in staged.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    assert sum(sizes) == 24000 + 11
    assert len(sizes) == 8 and max(sizes) < 0.2 * sum(sizes)
