"""Published objects, newest month by listing, bucketed cells, catalog views, lifetimes, key filter."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import RAW_SLA_ROWS, RAW_SST_ROWS
from tidemart.operators import joins, marts, staging
from tidemart.plans.inspect import count_exchanges, physical_plan, shuffle_metrics
from tidemart.plans.pipeline import Layout, build
from tidemart.schemas import RAW_SLA, RAW_SST
from tidemart.sources import lake, scratch, tables


def _place(scratch_dir, name):
    return os.path.join(tempfile.mkdtemp(prefix=name + "-", dir=scratch_dir), name)


def _name(kind):
    return f"{kind}_{uuid.uuid4().hex}"


def _months(spark, months, value=0.0, schema=RAW_SLA):
    if schema is RAW_SLA:
        rows = [(y, m, la, lo, v + value) for y, m in months for (_, _, la, lo, v) in RAW_SLA_ROWS]
    else:
        rows = [(y, m, la, lo, v + value, i) for y, m in months for (_, _, la, lo, v, i) in RAW_SST_ROWS]
    return spark.createDataFrame(rows, schema)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- published layout ---------------------------------------------------------------

def test_published_months_round_trip(spark, scratch):
    prefix = _place(scratch, "sla")
    df = _months(spark, [(1993, 11), (1993, 12), (1994, 1)])
    assert sorted(lake.write_published(df, prefix, RAW_SLA)) == [(1993, 11), (1993, 12), (1994, 1)]
    found = sorted(os.path.relpath(os.path.join(d, f), prefix) for d, _, names in os.walk(prefix) for f in names if not f.startswith("."))
    assert found == ["1993/11.parquet", "1993/12.parquet", "1994/01.parquet"]
    assert _rows(lake.scan_published(spark, prefix, RAW_SLA, "1993-11-20", "1994-01-02")) == _rows(df)
    assert _rows(lake.scan_published(spark, prefix, RAW_SLA, "1993-12-01", "1993-12-31")) == _rows(df.where("month = 12"))
    lake.write_published(_months(spark, [(1993, 12)], 1.0), prefix, RAW_SLA)  # replaces its month only
    again = lake.scan_published(spark, prefix, RAW_SLA, "1993-11-01", "1994-01-31")
    assert _rows(again.where("month <> 12")) == _rows(df.where("month <> 12"))
    assert {r.sea_level_anomaly_m for r in again.where("month = 12").collect()} == {1.05, 1.12}


def test_published_missing_months_are_named(spark, scratch):
    prefix = _place(scratch, "sla")
    lake.write_published(_months(spark, [(1993, 1), (1993, 3)]), prefix)
    with pytest.raises(lake.MissingMonth, match="1993-02, 1993-04"):
        lake.scan_published(spark, prefix, RAW_SLA, "1993-01-01", "1993-04-30")
    kept = lake.scan_published(spark, prefix, RAW_SLA, "1993-01-01", "1993-04-30", missing="skip")
    assert {r.month for r in kept.collect()} == {1, 3}
    assert lake.scan_published(spark, prefix, RAW_SLA, "2001-01-01", "2001-02-01", missing="skip").collect() == []


def test_published_object_of_another_month_fails(spark, scratch):
    prefix = _place(scratch, "sla")
    _months(spark, [(1993, 2)]).coalesce(1).write.parquet(f"{prefix}/1993/01.parquet")  # a folder is an object, too
    with pytest.raises(Exception, match="another month's row"):
        lake.scan_published(spark, prefix, RAW_SLA, "1993-01-01", "1993-01-31").count()


# --- newest month -------------------------------------------------------------------

def test_newest_month_opens_no_other_file(spark, scratch):
    base = _place(scratch, "lake")
    df = _months(spark, [(1993, 9), (1993, 10), (1992, 12)])
    lake.write_lake_month(df, base)
    for d, _, names in os.walk(base):
        for f in names:
            if f.endswith(".parquet") and "month=10" not in d:
                open(os.path.join(d, f), "wb").write(b"not a parquet file")
    assert lake.newest_lake_month(spark, base) == (1993, 10)
    assert _rows(lake.scan_newest_month(spark, base, RAW_SLA)) == _rows(df.where("month = 10"))
    os.makedirs(f"{base}/year=1999/month=1")  # a folder without data is no month
    os.makedirs(f"{base}/year=__HIVE_DEFAULT_PARTITION__/month=1")
    assert lake.newest_lake_month(spark, base) == (1993, 10)
    assert lake.lake_months(spark, base)[:2] == [(1999, 1), (1993, 10)]


def test_newest_month_of_an_empty_lake(spark, scratch):
    base = _place(scratch, "none")
    assert lake.newest_lake_month(spark, base) is None
    assert lake.scan_newest_month(spark, base, RAW_SLA).collect() == []


# --- bucketed cells -----------------------------------------------------------------

def _cell_tables(spark, scratch, months):
    sla = staging.stage_sla(_months(spark, months))
    sst = staging.regrid_sst(_months(spark, months, schema=RAW_SST))
    names = []
    for keyed, measures in ((sla, ["sea_level_anomaly_m"]), (sst, ["sst_celsius", "sea_ice_fraction"])):
        name = _name("cells")
        tables.create_cell_table(spark, name, measures, buckets=4, location=_place(scratch, name))
        tables.write_cells(spark, keyed, name)
        names.append(name)
    return (sla, sst), names


def test_bucketed_cells_join_without_exchange(spark, scratch):
    months = [(1993, 1), (1993, 2), (1994, 1)]
    (sla, sst), names = _cell_tables(spark, scratch, months)
    back = [tables.read_cells(spark, n) for n in names]
    joined = joins.cell_join(*back)
    assert count_exchanges(joined) == 0 and "SortMergeJoin" in physical_plan(joined)
    assert _rows(joined) == _rows(joins.cell_join(sla, sst).select(*joined.columns))
    monthly = marts.monthly_global_trends(*back)
    assert count_exchanges(monthly) == 1  # that of the aggregate
    assert shuffle_metrics(monthly)["shuffles"] == 1
    assert _rows(monthly) == _rows(marts.monthly_global_trends(sla, sst))


def test_bucketed_cells_replace_months_and_prune(spark, scratch):
    _, (name, _) = _cell_tables(spark, scratch, [(1993, 1), (1993, 2), (1993, 3)])
    tables.write_cells(spark, staging.stage_sla(_months(spark, [(1993, 2)], 1.0)), name)
    got = {(r.month, r.top) for r in tables.read_cells(spark, name).groupBy("month").agg(F.round(F.max("sea_level_anomaly_m"), 6).alias("top")).collect()}
    assert got == {(1, 0.12), (2, 1.12), (3, 0.12)}
    two = tables.read_cells(spark, name, "1993-02-10", "1993-03-01")
    assert {r.month for r in two.collect()} == {2, 3} and len(two.inputFiles()) < len(tables.read_cells(spark, name).inputFiles())
    with pytest.raises(ValueError, match="not bucketed"):
        plain = _name("plain")
        tables.create_table(spark, plain, RAW_SLA, "year", location=_place(scratch, plain))
        tables.write_cells(spark, staging.stage_sla(_months(spark, [(1993, 2)])), plain)


# --- views and lifetimes ------------------------------------------------------------

def test_catalog_view_is_seen_by_another_session(spark, scratch):
    base, table, view = _place(scratch, "lake"), _name("lake"), _name("staged")
    lake.write_lake_month(_months(spark, [(1993, 1), (1993, 2)]), base, RAW_SLA)
    assert tables.publish_lake(spark, base, RAW_SLA, table) == 2
    tables.create_staged_view(spark, view, table)
    other = spark.newSession()
    want = staging.public_cells(staging.stage_sla(lake.scan_lake(spark, base, RAW_SLA)))
    assert _rows(other.table(view)) == _rows(want) and other.table(view).columns == want.columns
    lake.append_lake(_months(spark, [(1994, 7)]), base, RAW_SLA)
    assert tables.publish_lake(spark, base, RAW_SLA, table) == 3
    assert {(r.year, r.month) for r in spark.newSession().table(view).collect()} == {(1993, 1), (1993, 2), (1994, 7)}
    pruned = spark.table(view).where("year = 1994")
    assert "PartitionFilters: [isnotnull(year" in physical_plan(pruned)


def test_ctas_is_computed_once_and_ends(spark):
    name = _name("once")
    with scratch.lifetime(spark):
        made = tables.ctas_temp(spark, name, "SELECT id, rand() AS x FROM range(50)")
        assert _rows(made) == _rows(tables.read_table(spark, name)) == _rows(spark.table(name))
        (folder,) = [n for kind, n in scratch._OPEN[-1] if kind == "folder"]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert fs.exists(path)
    assert not fs.exists(path) and not spark.catalog.tableExists(name)


def test_lifetimes_nest_and_end_after_errors(spark):
    with scratch.lifetime(spark):
        outer = scratch.written(spark.range(3))
        with pytest.raises(RuntimeError):
            with scratch.lifetime(spark):
                inner = scratch.written(spark.range(5))
                assert inner.count() == 5
                raise RuntimeError
        with pytest.raises(Exception):
            inner.count()
        assert outer.count() == 3 and scratch.drop_written(spark) == 1


def test_build_with_buckets_and_catalog_view(spark, scratch):
    sla, sst = _place(scratch, "sla"), _place(scratch, "sst")
    months = [(1993, 1), (1993, 2)]
    lake.write_lake_month(_months(spark, months), sla, RAW_SLA)
    lake.write_lake_month(_months(spark, months, schema=RAW_SST), sst, RAW_SST)
    plain = Layout(sla, sst, prefix=_name("p") + "_")
    layout = Layout(sla, sst, prefix=_name("b") + "_", cell_buckets=2, catalog_view=True)
    for x in (plain, layout):
        build(spark, x, "1993-01-01", "1993-02-28")
    assert _rows(spark.table(plain.monthly)) == _rows(spark.table(layout.monthly)) and spark.table(layout.monthly).count() == 2
    assert _rows(spark.table(plain.zones)) == _rows(spark.table(layout.zones))
    assert spark.newSession().table(layout.staged_view).count() == 4


# --- key filter and raw averages ----------------------------------------------------

@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_key_filter_cuts_the_shuffle_of_the_larger_side(spark, no_broadcast):
    raw = "CAST(2000 AS INT) AS year, CAST(1 AS INT) AS month, CAST(id % 700 AS DOUBLE) / 8 - 40 AS latitude, CAST(id DIV 700 AS DOUBLE) / 8 - 90 AS longitude"
    sst = spark.range(0, 200_000, numPartitions=4).selectExpr(*raw.split(", "), "CAST(id AS DOUBLE) AS sst_celsius", "0.5D AS sea_ice_fraction")
    sla = sst.where("pmod(CAST(sst_celsius AS BIGINT), 20) = 0").withColumnsRenamed({"sst_celsius": "sea_level_anomaly_m"})
    plain, filtered = joins.raw_cell_join(sla, sst), joins.raw_cell_join(sla, sst, prefilter=True)
    assert _rows(plain) == _rows(filtered) and plain.count() == 10_000
    before, after = shuffle_metrics(plain)["shuffle_bytes"], shuffle_metrics(filtered)["shuffle_bytes"]
    assert after < 0.4 * before
    assert joins.key_filter(sst, sla, joins.RAW_KEYS, log2_bits=10) is sst  # too many keys for the filter


def test_key_filter_edge_cases(spark):
    sla = spark.createDataFrame([(1993, 1, -0.0, 10.0, 0.5), (None, 1, 0.0, 10.0, 0.1)], RAW_SLA)
    sst = spark.createDataFrame([(1993, 1, 0.0, 10.0, 1.0, 0.0), (1993, 1, 9.0, 10.0, 1.0, 0.0), (None, 1, 0.0, 10.0, 1.0, 0.0)], RAW_SST)
    assert joins.raw_cell_join(sla, sst, prefilter=True).count() == joins.raw_cell_join(sla, sst).count() == 1
    assert joins.raw_cell_join(sla.limit(0), sst, prefilter=True).count() == 0


def test_raw_averages_take_two_exchanges(spark):
    sla = spark.createDataFrame([*RAW_SLA_ROWS, *RAW_SLA_ROWS[:1], (1993, 2, 0.0, 10.0, 0.3), (None, 1, 0.0, 10.0, 9.0)], RAW_SLA)
    sst = spark.createDataFrame([*RAW_SST_ROWS, (None, 1, 0.0, 10.0, 9.0, 0.0), (1993, 1, 0.0, 10.0, None, 0.0)], RAW_SST)
    for made, by in ((marts.raw_monthly_trends(sla, sst), 1), (marts.raw_zone_stats(sla, sst), 2)):
        assert count_exchanges(made) == 2
        full = joins.raw_cell_join(sla, sst)
        assert made.count() == by
    r = marts.raw_monthly_trends(sla, sst).first()
    want = full.agg(F.avg("sea_level_anomaly_m"), F.avg("sst_celsius")).first()
    assert (r.avg_sla_m, r.avg_sst_celsius) == pytest.approx(tuple(want))


def test_shuffles_of_registered_plans(spark):
    from tidemart.plans.registry import QUERIES
    sf = "/root/testdata/sf0.001"
    with scratch.lifetime(spark):
        assert shuffle_metrics(QUERIES["sst_map"](spark, sf))["shuffle_bytes"] < 1 << 20
        for name in ("zone_percentiles", "sla_map_limits", "sst_map_limits"):
            assert shuffle_metrics(QUERIES[name](spark, sf))["shuffles"] <= 6, name
