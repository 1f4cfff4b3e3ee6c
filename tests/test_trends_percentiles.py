import datetime as dt
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemart.operators.quantiles import exact_percentiles, percentile_limits
from tidemart.operators.trends import days_since_start, linear_trend, month_ordinal, with_fitted
from tidemart.plans import dashboard


def _monthly(spark, values, start_year=1995):
    rows = []
    for i, (sla, sst) in enumerate(values):
        y, m = start_year + i // 12, i % 12 + 1
        rows.append((dt.date(y, m, 1), y, m, sla, sst, 0.1, 10))
    return spark.createDataFrame(
        rows, "year_month date, year bigint, month bigint, avg_sla_m double, avg_sst_celsius double, "
              "avg_sea_ice_fraction double, grid_points bigint")


def test_trends_match_polyfit(spark):
    rng = np.random.default_rng(3)
    vals = [(float(rng.normal(0.01 * i, 0.02)), float(rng.normal(18 + 0.002 * i, 0.1))) for i in range(40)]
    out = dashboard.trends(_monthly(spark, vals)).orderBy("year_month").toPandas()
    x = out["x_days"].to_numpy()
    assert x[0] == 0.0
    for col, trend in (("avg_sla_cm", "trend_sla_cm"), ("avg_sst_celsius", "trend_sst_celsius")):
        slope, intercept = np.polyfit(x, out[col].to_numpy(), 1)
        assert np.allclose(out[trend].to_numpy(), slope * x + intercept, rtol=1e-9, atol=1e-9)


def test_trend_origin_is_after_the_year_filter(spark):
    vals = [(0.0, 1.0)] * 36
    out = dashboard.trends(_monthly(spark, vals), year_min=1996, year_max=1996).orderBy("year_month").collect()
    assert len(out) == 12 and out[0].year_month == dt.date(1996, 1, 1) and out[0].x_days == 0.0


def test_one_month_has_no_trend(spark):
    out = dashboard.trends(_monthly(spark, [(0.01, 18.0)])).collect()
    assert len(out) == 1 and out[0].trend_sla_cm is None and out[0].trend_sst_celsius is None


def test_month_ordinal_and_fit(spark):
    df = _monthly(spark, [(float(i), 2.0 * i) for i in range(6)])
    o = with_fitted(month_ordinal(df), "avg_sst_celsius", "x_ordinal", "fit").orderBy("year_month").collect()
    assert [r.x_ordinal for r in o] == [0, 1, 2, 3, 4, 5]
    assert [r.fit for r in o] == pytest.approx([2.0 * i for i in range(6)])


def test_keyed_fit(spark):
    rows = [("a", float(i), float(i)) for i in range(5)] + [("b", float(i), 3.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    fits = {r.k: r for r in linear_trend(df, "y", "x", by=["k"]).collect()}
    assert fits["a"].slope == pytest.approx(1.0) and fits["b"].slope == pytest.approx(-1.0)
    assert fits["b"].intercept == pytest.approx(3.0)


def test_days_since_start_keyed(spark):
    df = spark.createDataFrame([("a", dt.date(2000, 1, 1)), ("a", dt.date(2000, 2, 1)),
                                ("b", dt.date(2001, 1, 1))], "k string, year_month date")
    got = {(r.k, r.x_days) for r in days_since_start(df, by=["k"]).collect()}
    assert got == {("a", 0.0), ("a", 31.0), ("b", 0.0)}


def _np_pct(values, p):
    v = np.asarray([x for x in values if x is not None], dtype=float)
    v = v[~np.isnan(v)]
    return None if len(v) == 0 else float(np.percentile(v, p * 100))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 187, 1000])
def test_exact_percentiles_small_groups(spark, n):
    rng = np.random.default_rng(n)
    vals = [float(x) for x in rng.integers(-200, 200, n) / 1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.02, 0.5, 0.98, 1.0]
    r = exact_percentiles(df, "v", probs, names=["a", "b", "c", "d", "e"]).collect()[0]
    assert r.n == n
    for name, p in zip("abcde", probs):
        assert r[name] == pytest.approx(_np_pct(vals, p), abs=1e-12), (name, p)


def test_exact_percentiles_with_wide_bins(spark):
    """With few mantissa bits the bins are wide; the result stays exact."""
    rng = np.random.default_rng(11)
    vals = rng.normal(0, 1, 20000)
    vals[:7000] = 0.25  # a third of all rows share one value
    vals[7000:7100] = np.nan
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(8)
    probs = [0.02, 0.3, 0.35, 0.5, 0.98]
    for bits in (0, 2, 16):
        r = exact_percentiles(df, "v", probs, names=["a", "b", "c", "d", "e"], bits=bits).collect()[0]
        assert r.n == 19900
        for name, p in zip("abcde", probs):
            assert r[name] == pytest.approx(_np_pct(vals.tolist(), p), abs=1e-12), (bits, name)


def test_exact_percentiles_grouped_and_equal_to_spark_percentile(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), float(v)) for k, v in zip(rng.integers(0, 4, 4000), rng.normal(10, 3, 4000))]
    rows += [(9, None), (9, float("nan"))]
    df = spark.createDataFrame(rows, "k int, v double")
    mine = {r.k: r for r in exact_percentiles(df, "v", [0.02, 0.98], names=["lo", "hi"], by=["k"]).collect()}
    ref = {r.k: r for r in df.where(~F.isnan("v")).groupBy("k").agg(
        F.percentile("v", 0.02).alias("lo"), F.percentile("v", 0.98).alias("hi")).collect()}
    gone = mine.pop(9)  # a group with no valid value keeps its row
    assert (gone.n, gone.lo, gone.hi) == (0, None, None)
    for k in range(4):
        assert mine[k].lo == pytest.approx(ref[k].lo, abs=1e-12)
        assert mine[k].hi == pytest.approx(ref[k].hi, abs=1e-12)


def test_percentiles_of_empty_input(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "v double")
    r = percentile_limits(df, "v").collect()[0]
    assert r.n == 0 and r.p_low is None and r.p_high is None


def test_map_limits_symmetric(spark):
    df = spark.createDataFrame([(float(x) / 100,) for x in range(-50, 21)], "v double")
    r = dashboard.map_limits(df, "v", symmetric=True).collect()[0]
    vals = [x / 100 for x in range(-50, 21)]
    assert r.abs_max == pytest.approx(max(abs(_np_pct(vals, 0.02)), abs(_np_pct(vals, 0.98))))


@settings(max_examples=int(os.environ.get("TIDEMART_PROPERTY_EXAMPLES", "12")), deadline=None,
          derandomize=not os.environ.get("TIDEMART_PROPERTY_EXAMPLES"),
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.sampled_from([0.0, 1.0, -1.0, 2.5]),
                                 st.floats(-1e6, 1e6, allow_nan=False, width=32),
                                 st.none(), st.just(float("nan"))), min_size=0, max_size=300),
       probs=st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4),
       bits=st.sampled_from([0, 3, 16, 20]))
def test_exact_percentiles_property(spark, values, probs, bits):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    names = [f"q{i}" for i in range(len(probs))]
    r = exact_percentiles(df, "v", probs, names=names, bits=bits).collect()[0]
    valid = [v for v in values if v is not None and v == v]
    assert r.n == len(valid)
    for name, p in zip(names, probs):
        want = _np_pct(values, p)
        if want is None:
            assert r[name] is None
        else:
            assert r[name] == pytest.approx(want, rel=1e-12, abs=1e-9), (p, bits)


def test_exact_percentiles_all_equal(spark):
    df = spark.createDataFrame([(7.5,)] * 5000, "v double")
    r = exact_percentiles(df, "v", [0.0, 0.02, 0.98, 1.0], names=["a", "b", "c", "d"], bits=4).collect()[0]
    assert (r.a, r.b, r.c, r.d) == (7.5, 7.5, 7.5, 7.5)


def test_dashboard_order_on_request(spark):
    vals = [(0.01 * i, 18.0 + i) for i in range(30)]
    out = dashboard.trends(_monthly(spark, vals), ordered=True).collect()
    assert [r.year_month for r in out] == sorted(r.year_month for r in out)
    dec = dashboard.decades(_monthly(spark, vals), edges=[(1995, 1995, "a"), (1996, 1996, "b")],
                            ordered=True).collect()
    assert [r.decade for r in dec] == ["2013-2023", "a", "b"]


def test_grouped_percentiles_keep_a_null_group(spark):
    rows = [(None, float(i)) for i in range(11)] + [("a", float(i) * 2) for i in range(11)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.n, r.p50) for r in exact_percentiles(df, "v", [0.5], names=["p50"], by=["k"]).collect()}
    assert got == {None: (11, 5.0), "a": (11, 10.0)}


def test_keyed_days_since_start_null_key(spark):
    df = spark.createDataFrame([(None, dt.date(2000, 1, 1)), (None, dt.date(2000, 3, 1))],
                               "k string, year_month date")
    assert sorted(r.x_days for r in days_since_start(df, by=["k"]).collect()) == [0.0, 60.0]


def test_grouped_percentiles_spread_one_large_group(spark, monkeypatch):
    """Values meet by bin: no bin holds more than a small share of a large group, and many groups join by bin."""
    from tidemart.operators import quantiles
    df = spark.range(0, 60_000, numPartitions=8).selectExpr("if(id % 3 = 0, 0, 1) as k", "hash(id) * 1e-3 as v")
    sizes = [r["count"] for r in df.where("k = 1").groupBy(quantiles.value_bin("v")).count().collect()]
    assert max(sizes) <= 40_000 / 1000
    want = {r.k: (r.lo, r.hi) for r in df.groupBy("k").agg(F.percentile("v", 0.02).alias("lo"),
                                                          F.percentile("v", 0.98).alias("hi")).collect()}
    for groups in (quantiles.MAX_GROUPS, 0):
        monkeypatch.setattr(quantiles, "MAX_GROUPS", groups)
        got = {r.k: (r.lo, r.hi) for r in exact_percentiles(df, "v", [0.02, 0.98], names=["lo", "hi"], by=["k"]).collect()}
        assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_value_bins_never_fall(spark):
    from tidemart.operators.quantiles import value_bin
    rng = np.random.default_rng(2)
    edges = [s * x for k in (-1074, -1022, -30, -1, 0, 1, 3, 52, 1000, 1023) for b in (2.0 ** k,) for s in (1, -1)
             for x in (b, np.nextafter(b, 0), np.nextafter(b, np.inf))]
    vals = sorted([0.0, float("inf"), -float("inf"), 1.7976931348623157e308, 5e-324, *edges, *rng.normal(0, 1e3, 2000), *rng.normal(0, 1e-9, 500)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, v double")
    for bits in (0, 7, 16):
        bins = [r.b for r in df.select("i", value_bin("v", bits).alias("b")).orderBy("i").collect()]
        assert None not in bins and bins == sorted(bins)


def test_percentiles_take_few_shuffles(spark):
    from tidemart.plans.inspect import shuffle_metrics
    df = spark.range(0, 5000, numPartitions=4).selectExpr("id % 5 as k", "id * 0.5 as v")
    assert shuffle_metrics(percentile_limits(df, "v"))["shuffles"] <= 4
    assert shuffle_metrics(percentile_limits(df, "v", by=["k"]))["shuffles"] <= 4  # and two for the bins, written before
