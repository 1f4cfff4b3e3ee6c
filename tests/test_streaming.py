import os
import tempfile

import pytest

from conftest import RAW_SLA_ROWS, RAW_SST_ROWS
from tidemart.plans.pipeline import Layout
from tidemart.schemas import RAW_SLA, RAW_SST
from tidemart.sources.lake import write_lake_month
from tidemart.streaming.incremental import _month_ranges, start_incremental_build


def test_month_ranges():
    assert _month_ranges([(1993, 12), (1993, 11), (1994, 1), (1994, 3)]) == [
        ("1993-11-01", "1994-01-31"), ("1994-03-01", "1994-03-31")]


def test_incremental_build_processes_new_months(spark, scratch):
    root = tempfile.mkdtemp(prefix="stream-", dir=scratch)
    layout = Layout(sla_lake=os.path.join(root, "sla"), sst_lake=os.path.join(root, "sst"),
                    prefix="s" + os.path.basename(root).replace("-", "_")[-8:] + "_")

    def land(month, sst_value):
        sst = spark.createDataFrame([(1993, month, la, lo, sst_value, ice)
                                     for (_, _, la, lo, _, ice) in RAW_SST_ROWS], RAW_SST)
        sla = spark.createDataFrame([(1993, month, la, lo, v) for (_, _, la, lo, v) in RAW_SLA_ROWS], RAW_SLA)
        write_lake_month(sst, layout.sst_lake)
        write_lake_month(sla, layout.sla_lake)

    land(1, 10.0)
    ckpt = os.path.join(root, "ckpt")
    start_incremental_build(spark, layout, ckpt).awaitTermination(120)
    got = {r.month: r.avg_sst_celsius for r in spark.table(layout.monthly).collect()}
    assert got == {1: pytest.approx(10.0)}

    land(2, 20.0)
    start_incremental_build(spark, layout, ckpt).awaitTermination(120)
    got = {r.month: r.avg_sst_celsius for r in spark.table(layout.monthly).collect()}
    assert got == {1: pytest.approx(10.0), 2: pytest.approx(20.0)}
    assert spark.table(layout.zones).count() == 4

    # a corrected month lands again (its files are replaced): only it is rebuilt
    land(1, 30.0)
    start_incremental_build(spark, layout, ckpt).awaitTermination(120)
    got = {r.month: r.avg_sst_celsius for r in spark.table(layout.monthly).collect()}
    assert got == {1: pytest.approx(30.0), 2: pytest.approx(20.0)}
