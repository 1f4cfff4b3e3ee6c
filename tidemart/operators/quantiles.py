"""Exact percentiles with linear interpolation, computed without gathering a group's
values in one task.

Semantics: NULL and NaN are skipped (``nanpercentile``); for probability ``p`` over
``n`` sorted values ``v[0..n-1]`` the result is ``v[lo] + (pos - lo) * (v[hi] - v[lo])``
with ``pos = p * (n - 1)``, ``lo = floor(pos)``, ``hi = ceil(pos)`` — the same as
numpy's default, SQL ``quantile_cont`` and Spark's ``percentile``. A group without a valid
value keeps its row, with ``n`` 0 and NULL percentiles, as GROUP BY would.

Why not Spark's ``percentile``: it merges a value->count map of the whole group
in one final task, so one large group (a month of a 0.05 degree grid is ~26 M cells)
lands in a single task. Instead, radix selection over the order-preserving leading bits of a
double (sign, exponent and the first ``bits`` bits of the mantissa):

1. a counting pass: rows per (group, bin), combined on the map side. Running counts over a
   group's bins tell which bin holds each wanted rank, and how many values lie below it. A
   histogram has at most ``2**bits`` bins per power of two that the values span, whatever
   the number of rows;
2. a second pass keeps the values of those bins only (at most two per probability), collapses
   them to counts per distinct value and ranks these. With 16 bits a bin is a 65,536th of
   a power of two: at most 128 distinct values of a FLOAT source.

The bins of a global result reach the second pass as a scalar subquery. Those of groups are
written once and broadcast if there are at most ``MAX_GROUPS`` groups (counted; about 100 bytes
per bin); beyond that they are joined on (group, bin), which spreads a large group over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.cleaning import nan_to_null
from tidemart.sources.scratch import written

BITS = 16
MAX_GROUPS = 50_000


def value_bin(v, bits: int = BITS) -> Column:
    """A LONG that never falls as ``v`` grows: sign, exponent and leading mantissa bits of a double.

    The exponent is the floor of the binary logarithm, which may be one too high just below a power
    of two; such values count to the first bin of that power, so the order holds."""
    x = F.col(v) if isinstance(v, str) else v
    size = F.abs(x)
    exponent = F.when(size == F.lit(float("inf")), F.lit(1025)).otherwise(F.floor(F.log2(size)).cast("int"))
    steps = F.lit(float(1 << bits))
    mantissa = F.when(exponent < 1024, F.floor((size / F.pow(F.lit(2.0), exponent) - F.lit(1.0)) * steps)).otherwise(F.lit(0))
    mantissa = F.greatest(F.lit(0).cast("long"), F.least(F.lit((1 << bits) - 1).cast("long"), mantissa.cast("long")))
    return (F.when(x == F.lit(0.0), F.lit(0).cast("long"))
            .otherwise(F.signum(x).cast("long") * ((exponent + F.lit(1100)).cast("long") * F.lit(1 << bits) + mantissa + F.lit(1))))


def _ranks(probs: list[float], n: Column) -> Column:
    """Array of all ranks that the probabilities interpolate between."""
    at = [F.lit(p) * (n - F.lit(1)).cast("double") for p in probs]
    return F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)])


def _within(ranks: Column) -> Column:
    return F.exists(ranks, lambda r: (r >= F.col("_from")) & (r < F.col("_to")))


def _running(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _located(data: DataFrame, keys: list[str], probs: list[float], bits: int) -> DataFrame:
    """Per group: ``_n`` and ``_bins``, the (bin, number of values below it) that hold wanted ranks."""
    placed = (data.groupBy(*keys, value_bin("_v", bits).alias("_b")).agg(F.count("_v").alias("_c"))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
              .withColumn("_to", F.sum("_c").over(_running(keys, "_b")))
              .withColumn("_from", F.col("_to") - F.col("_c")))
    return (placed.where((F.col("_n") == 0) | _within(_ranks(probs, F.col("_n"))))
            .groupBy(*keys).agg(F.max("_n").alias("_n"),
                                F.collect_list(F.when(F.col("_n") > 0, F.struct("_b", "_from"))).alias("_bins")))


def _in_bins(data: DataFrame, located: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """The values of ``data`` that lie in a located bin, as ``keys, _n, _b, _from, _v``."""
    own = data.withColumn("_b", value_bin("_v", bits)).where(F.col("_v").isNotNull())
    if keys and located.count() > MAX_GROUPS:
        bins = located.select(*keys, "_n", F.explode("_bins").alias("_x")).select(*keys, "_n", "_x.*")
        return own.join(bins, [*keys, "_b"])
    if keys:
        own = own.join(F.broadcast(located.where(F.col("_n") > 0)), keys)
    else:
        one = located.select(F.struct("_n", "_bins").alias("_t")).scalar()
        own = own.withColumn("_t", one).select("_v", "_b", "_t.*")
    start = F.try_element_at(F.filter("_bins", lambda x: x["_b"] == F.col("_b")), F.lit(1))["_from"]
    return own.withColumn("_from", start).where(F.col("_from").isNotNull())


def exact_percentiles(df: DataFrame, value: str, probs, names=None, by=None, bits: int = BITS) -> DataFrame:
    """Per group (``by``; global when empty): ``n`` and one column per probability."""
    group_keys = list(by or [])
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"p{int(round(p * 100)):02d}" for p in probs]

    # one non-NULL grouping column: a struct holding a NULL key is itself not NULL and
    # equal to itself, so plain equi-joins keep a NULL group
    keys = ["_g"] if group_keys else []
    data = df.select(*([F.struct(*group_keys).alias("_g")] if keys else []),
                     nan_to_null(F.col(value).cast("double")).alias("_v"))
    located = _located(data, keys, probs, bits)
    if keys:
        located = written(located)

    counts = (_in_bins(data, located, keys, bits).groupBy(*keys, "_n", "_b", "_from", "_v").agg(F.count(F.lit(1)).alias("_c")))
    # a group's candidates together: the windows over its bins and its result need no other exchange
    counts = counts.repartition("_g") if keys else counts.repartition(1)
    ranked = (counts.withColumn("_to", F.col("_from") + F.sum("_c").over(_running([*keys, "_b"], "_v")))
              .withColumn("_first", F.col("_to") - F.col("_c")))

    def at_rank(f, p):
        r = f(F.lit(p) * (F.col("_n") - F.lit(1)).cast("double")).cast("long")
        return F.min(F.when((F.col("_first") <= r) & (r < F.col("_to")), F.col("_v")))
    found = ranked.groupBy(*keys).agg(
        F.max("_n").alias("_n"), *[at_rank(F.floor, p).alias(f"_lo{j}") for j, p in enumerate(probs)],
        *[at_rank(F.ceil, p).alias(f"_hi{j}") for j, p in enumerate(probs)])
    if keys:  # groups without a valid value
        found = found.unionByName(located.where(F.col("_n") == 0).select("_g", "_n"), allowMissingColumns=True)

    n = F.coalesce(F.col("_n"), F.lit(0))
    columns = []
    for j, name in enumerate(names):
        pos = F.lit(probs[j]) * (n - F.lit(1)).cast("double")
        lo, hi = F.col(f"_lo{j}"), F.col(f"_hi{j}")
        between = F.when(lo == hi, lo).otherwise(lo + (pos - F.floor(pos)) * (hi - lo))
        columns.append(F.when(n > 0, between).alias(name))
    return found.select(*[F.col("_g").getField(k).alias(k) for k in group_keys], n.cast("long").alias("n"), *columns)


def percentile_limits(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98,
                      by=None, names=("p_low", "p_high"), **kw) -> DataFrame:
    """NaN-skipping low/high percentile pair (colour-scale limits)."""
    return exact_percentiles(df, value, [low, high], names=list(names), by=by, **kw)
