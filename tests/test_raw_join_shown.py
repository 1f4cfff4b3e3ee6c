"""The raw cell join rounds input rows, not the rows that a repeated key multiplies into."""

import pytest
from pyspark.sql import functions as F

from conftest import RAW_SLA_SCHEMA, RAW_SST_SCHEMA
from tidemart.operators import joins
from tidemart.plans import registry
from tidemart.plans.inspect import physical_plan

NAN, INF = float("nan"), float("inf")


@pytest.fixture
def sides(spark):
    sla = spark.createDataFrame([(1993, 1, -0.0, 10.1234565, 0.0000005), (1993, 1, 0.0, 10.1234565, None), (1993, 1, 0.0, 10.1234565, NAN),
                                 (1993, 1, 5.0, 5.0, 1.0), (None, 1, 0.0, 10.0, 1.0)], RAW_SLA_SCHEMA)
    sst = spark.createDataFrame([(1993, 1, 0.0, 10.1234565, 1.2345675, -INF), (1993, 1, 0.0, 10.1234565, None, 0.1234564999),
                                 (1993, 1, 0.0, 10.1234569, 1.0, 0.0), (1993, 1, 9.0, 9.0, 1e300, 1e300)], RAW_SST_SCHEMA)
    return sla, sst


@pytest.mark.parametrize("prefilter", [False, True])
def test_rounded_before_the_join_as_after_it(sides, prefilter):
    after = registry.rounded(joins.raw_cell_join(*sides))
    before = joins.raw_cell_join(*sides, prefilter=prefilter, shown=registry.round_any)
    assert before.schema.simpleString() == after.schema.simpleString()
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))
    assert before.count() == 6  # coordinates that only round alike do not meet


def test_float_measures_pass_as_they_are(sides):
    sla, sst = sides
    narrow = sst.withColumn("sea_ice_fraction", F.col("sea_ice_fraction").cast("float"))
    made = joins.raw_cell_join(sla, narrow, shown=registry.round_any)
    assert sorted(map(str, made.collect())) == sorted(map(str, registry.rounded(joins.raw_cell_join(sla, narrow)).collect()))


@pytest.mark.parametrize("name", ["raw_cell_join", "raw_cell_join_filtered"])
def test_no_rounding_above_the_join(spark, name):
    plan = physical_plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Join" in plan and "round(" in plan
    top = plan[: plan.index("SortMergeJoin" if "SortMergeJoin" in plan else "Join")]
    assert "round(" not in top
