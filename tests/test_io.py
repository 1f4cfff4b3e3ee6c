import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import RAW_SLA_ROWS, RAW_SST_ROWS
from tidemart.operators import marts, staging
from tidemart.plans.pipeline import Layout, build
from tidemart.schemas import MONTHLY_GLOBAL_TRENDS, RAW_SLA, RAW_SST, STAGING_SST
from tidemart.sources.frames import concat_months, empty_typed, values_table
from tidemart.sources.lake import append_lake, scan_lake, scan_paths, write_lake_month
from tidemart.sources.tables import create_table, ctas_temp, delete_insert, read_published, read_table


def _tmp(scratch, name):
    return tempfile.mkdtemp(prefix=name + "-", dir=scratch)


def _sst_month(spark, y, m, value):
    rows = [(y, m, la, lo, value, 0.0) for (_, _, la, lo, _, _) in RAW_SST_ROWS]
    return spark.createDataFrame(rows, RAW_SST)


def test_write_lake_month_replaces_only_its_month(spark, scratch):
    base = os.path.join(_tmp(scratch, "lake"), "sst")
    write_lake_month(_sst_month(spark, 1993, 1, 1.0).unionByName(_sst_month(spark, 1993, 2, 2.0)), base)
    write_lake_month(_sst_month(spark, 1993, 1, 9.0), base)
    got = {(r.month, r.v) for r in scan_lake(spark, base, RAW_SST)
           .groupBy("month").agg(F.max("sst_celsius").alias("v")).collect()}
    assert got == {(1, 9.0), (2, 2.0)}
    assert sorted(os.listdir(base)) == ["year=1993"]


def test_scan_lake_prunes_partitions(spark, scratch):
    base = os.path.join(_tmp(scratch, "lake"), "sst")
    write_lake_month(concat_months([_sst_month(spark, 1993, m, float(m)) for m in (1, 2, 3)]), base)
    df = scan_lake(spark, base, RAW_SST, "1993-02-01", "1993-02-28")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the month-range predicate is evaluated on partition values, before any file is opened
    part_filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "make_date(year" in part_filters
    assert {r.month for r in df.select("month").distinct().collect()} == {2}


def test_append_and_multi_path_read(spark, scratch):
    base = os.path.join(_tmp(scratch, "lake"), "sla")
    sla = spark.createDataFrame(RAW_SLA_ROWS, RAW_SLA)
    append_lake(sla, base)
    append_lake(sla, base)
    assert scan_lake(spark, base, RAW_SLA).count() == 4
    paths = [os.path.join(base, "year=1993", "month=1")]
    again = scan_paths(spark, paths, RAW_SLA, base)
    assert again.count() == 4 and {r.year for r in again.select("year").distinct().collect()} == {1993}


def test_delete_insert_keeps_other_months(spark, scratch):
    name = "t_di_" + os.path.basename(_tmp(scratch, "t")).replace("-", "_")
    create_table(spark, name, STAGING_SST, "year_month", ["year", "month"])

    def month(y, m, v):
        return spark.createDataFrame([(dt.date(y, m, 1), y, m, 0.0, 0.0, v, 0.1)], STAGING_SST)
    delete_insert(spark, month(1993, 1, 1.0).unionByName(month(1993, 2, 2.0)), name)
    delete_insert(spark, month(1993, 2, 5.0), name)
    delete_insert(spark, empty_typed(spark, STAGING_SST), name)
    got = sorted((r.month, r.sst_celsius) for r in read_table(spark, name).collect())
    assert got == [(1, 1.0), (2, 5.0)]
    # the session setting is restored afterwards
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_values_table_and_ctas(spark):
    zones = values_table(spark, [("Arctic", 1), ("Tropical", 3)], "zone string, ord int")
    zones.createOrReplaceTempView("zone_order")
    v = ctas_temp(spark, "zone_first", "SELECT zone FROM zone_order WHERE ord = 1")
    assert [r.zone for r in v.collect()] == ["Arctic"]
    assert read_table(spark, "SELECT count(*) AS n FROM zone_first").collect()[0].n == 1


def test_empty_typed_keeps_types(spark):
    df = empty_typed(spark, RAW_SST)
    assert df.count() == 0 and df.schema == RAW_SST


def test_batch_build_end_to_end(spark, scratch):
    root = _tmp(scratch, "build")
    layout = Layout(sla_lake=os.path.join(root, "sla"), sst_lake=os.path.join(root, "sst"),
                    prefix="b" + os.path.basename(root).replace("-", "_")[-8:] + "_")
    sst = concat_months([_sst_month(spark, 1993, m, float(m)) for m in (1, 2)])
    sla_rows = [(1993, m, la, lo, v) for m in (1, 2) for (_, _, la, lo, v) in RAW_SLA_ROWS]
    sla = spark.createDataFrame(sla_rows, RAW_SLA)
    write_lake_month(sst, layout.sst_lake, RAW_SST)
    write_lake_month(sla, layout.sla_lake, RAW_SLA)
    build(spark, layout, "1993-01-01", "1993-02-28")
    direct = marts.monthly_global_trends(staging.stage_sla(sla), staging.regrid_sst(sst))
    stored = read_published(spark, layout.monthly, MONTHLY_GLOBAL_TRENDS)
    assert stored.columns == direct.columns
    assert sorted(stored.collect()) == sorted(direct.collect())
    assert spark.table(layout.zones).count() == 4
    # rebuilding one month is idempotent and leaves the other month alone
    write_lake_month(_sst_month(spark, 1993, 2, 20.0), layout.sst_lake, RAW_SST)
    build(spark, layout, "1993-02-01", "1993-02-28")
    got = {r.month: r.avg_sst_celsius for r in spark.table(layout.monthly).collect()}
    assert got[1] == pytest.approx((1.0 + 1.0) / 2) and got[2] == pytest.approx(20.0)
    assert spark.table(layout.monthly).count() == 2


def test_range_partitioned_lake_write(spark, scratch):
    base = os.path.join(_tmp(scratch, "lake"), "sst")
    months = concat_months([_sst_month(spark, 1993, m, float(m)) for m in (1, 2, 3)])
    write_lake_month(months, base, RAW_SST, range_partitions=4)
    back = scan_lake(spark, base, RAW_SST)
    assert back.count() == months.count()
    assert sorted(back.collect()) == sorted(months.select(*back.columns).collect())


def test_ingest_gridded_month(spark, scratch):
    from tidemart.plans.pipeline import ingest_month
    from tidemart.sources.gridded import grid_flatten
    rows = spark.createDataFrame(
        [(1993, 1, 0.0, [10.0, 10.05], [300.15, float("nan")], [0.0, 0.5]),
         (1993, 1, 0.05, [10.0, 10.05], [float("nan"), 301.15], [float("nan"), float("nan")])],
        "year int, month int, latitude double, lon array<double>, sst array<double>, ice array<double>")
    both = grid_flatten(rows, ["sst", "ice"], ["sst_celsius", "sea_ice_fraction"], lon_axis_col="lon",
                        keep=["year", "month", "latitude"])
    assert "Join" not in both._jdf.queryExecution().optimizedPlan().toString()
    base = os.path.join(_tmp(scratch, "ingest"), "sst")
    ingest_month(spark, both, base, RAW_SST, "sst_celsius", "sst_celsius",
                 measures=["sst_celsius", "sea_ice_fraction"], kelvin=["sst_celsius"])
    got = sorted((round(r.latitude, 4), round(r.longitude, 4), round(r.sst_celsius, 4), r.sea_ice_fraction)
                 for r in scan_lake(spark, base, RAW_SST).collect())
    assert got == [(0.0, 10.0, 27.0, 0.0), (0.05, 10.05, 28.0, None)]


def test_bulk_load_append_appends_again_on_rerun(spark, scratch):
    from tidemart.sources.tables import bulk_load_append
    root = _tmp(scratch, "bulk")
    files = []
    for m in (1, 2):
        path = os.path.join(root, f"1993_{m:02d}.parquet")
        _sst_month(spark, 1993, m, float(m)).write.parquet(path)
        files.append(path)
    name = "raw_sst_" + os.path.basename(root).replace("-", "_")
    bulk_load_append(spark, files, RAW_SST, name, ["year", "month"])
    assert spark.table(name).count() == 10
    bulk_load_append(spark, files[:1], RAW_SST, name, ["year", "month"])  # append semantics
    assert spark.table(name).count() == 15


def test_pipeline_command_line(spark, scratch):
    from tidemart.plans.pipeline import main
    root = _tmp(scratch, "cli")
    sla_lake, sst_lake = os.path.join(root, "sla"), os.path.join(root, "sst")
    write_lake_month(_sst_month(spark, 1993, 3, 3.0), sst_lake, RAW_SST)
    write_lake_month(spark.createDataFrame([(1993, 3, la, lo, v) for (_, _, la, lo, v) in RAW_SLA_ROWS],
                                           RAW_SLA), sla_lake, RAW_SLA)
    prefix = "c" + os.path.basename(root).replace("-", "_")[-8:] + "_"
    main(["--sla-lake", sla_lake, "--sst-lake", sst_lake, "--start", "1993-01-01",
          "--end", "1993-12-31", "--prefix", prefix])
    rows = spark.table(f"{prefix}mart.monthly_global_trends").collect()
    assert [(r.month, r.grid_points) for r in rows] == [(3, 2)]


def test_scan_lake_takes_whole_months(spark, scratch):
    base = os.path.join(_tmp(scratch, "mid"), "sst")
    months = [(1993, 11), (1993, 12), (1994, 1), (1994, 2), (1994, 3)]
    write_lake_month(concat_months([_sst_month(spark, y, m, 1.0) for y, m in months]), base, RAW_SST)
    got = scan_lake(spark, base, RAW_SST, "1993-11-15", "1994-02-02").select("year", "month").distinct().collect()
    assert sorted((r.year, r.month) for r in got) == months[:4]


def test_build_stages_the_months_it_loads_and_the_view_covers_the_lake(spark, scratch):
    root = _tmp(scratch, "range")
    layout = Layout(sla_lake=os.path.join(root, "sla"), sst_lake=os.path.join(root, "sst"),
                    prefix="r" + os.path.basename(root).replace("-", "_")[-8:] + "_")
    months = [(1993, 11), (1993, 12), (1994, 1)]
    write_lake_month(concat_months([_sst_month(spark, y, m, 1.0) for y, m in months]), layout.sst_lake, RAW_SST)
    write_lake_month(spark.createDataFrame([(y, m, la, lo, v) for y, m in months for (_, _, la, lo, v) in RAW_SLA_ROWS],
                                           RAW_SLA), layout.sla_lake, RAW_SLA)
    build(spark, layout, "1993-11-15", "1993-12-31")
    build(spark, layout, "1994-01-01", "1994-01-31")
    staged = spark.table(layout.staging_sst).select("year", "month").distinct().collect()
    assert sorted((r.year, r.month) for r in staged) == months
    marts_of = spark.table(layout.monthly).select("year", "month").collect()
    assert sorted((r.year, r.month) for r in marts_of) == months[1:]  # the mart range is a plain date range
    view = spark.table(f"{layout.prefix}staging_sea_level_anomaly").select("year", "month").distinct().collect()
    assert sorted((r.year, r.month) for r in view) == months


def test_bulk_load_of_lake_folders_keeps_their_months(spark, scratch):
    from pyspark.errors import PySparkException
    from tidemart.sources.tables import bulk_load_append
    root = _tmp(scratch, "bulklake")
    base = os.path.join(root, "sst")
    write_lake_month(concat_months([_sst_month(spark, 1993, m, 1.0) for m in (1, 2)]), base, RAW_SST)
    name = "lake_sst_" + os.path.basename(root).replace("-", "_")
    bulk_load_append(spark, [f"{base}/year=1993/month={m}" for m in (1, 2)], RAW_SST, name, ["year", "month"])
    got = spark.table(name).groupBy("year", "month").count().collect()
    assert sorted(tuple(r) for r in got) == [(1993, 1, 5), (1993, 2, 5)]
    bare = os.path.join(root, "bare")
    _sst_month(spark, 1993, 1, 1.0).withColumn("month", F.lit(None).cast("int")).write.parquet(bare)
    with pytest.raises(PySparkException, match="month is NULL"):
        bulk_load_append(spark, [bare], RAW_SST, name)


def test_writes_are_sized_by_month(spark, scratch):
    import glob
    rows = spark.range(0, 24_000, numPartitions=16).selectExpr(
        "1993 as year", "case when id % 2 = 0 then 1 else cast(id % 12 as int) + 1 end as month",
        "cast(id % 700 as double) / 8 as latitude", "cast(id as double) / 100 as longitude",
        "rand(1) as sst_celsius", "rand(2) as sea_ice_fraction")
    base = os.path.join(_tmp(scratch, "sized"), "sst")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
        write_lake_month(rows, base, RAW_SST)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    files = {m: len(glob.glob(f"{base}/year=1993/month={m}/*.parquet")) for m in range(1, 13)}
    assert files[1] > 2 and all(1 <= files[m] <= 2 for m in range(2, 13) if files[m]), files
    assert scan_lake(spark, base, RAW_SST).count() == 24_000


def test_delete_insert_refuses_a_table_without_dynamic_overwrite(spark, scratch):
    name = "plain_" + os.path.basename(_tmp(scratch, "plain")).replace("-", "_")
    spark.sql(f"CREATE TABLE {name} (a INT, year_month DATE) USING parquet PARTITIONED BY (year_month)")
    with pytest.raises(ValueError, match="dynamic overwrite"):
        delete_insert(spark, spark.table(name), name)


def test_rows_without_coordinates_are_counted_and_dropped(spark):
    from tidemart.sources.lake import coordinate_check, ingest_grid
    rows = spark.createDataFrame([(1993, 1, 0.0, 1.0, 5.0), (1993, 1, float("nan"), 1.0, 5.0), (1993, 1, None, 1.0, 5.0),
                                  (1993, 1, 2.0, float("inf"), 5.0)],
                                 "year int, month int, latitude double, longitude double, sst_celsius double")
    assert tuple(coordinate_check(rows).first()) == ("valid_coordinates", False, 3)
    assert ingest_grid(rows, "sst_celsius", "sst_celsius").count() == 1
