"""Marts: monthly global and per-latitude-zone summaries, and the exploration variants
built directly on the raw tables.

Averages are unweighted by cell area and ``grid_points`` counts joined cells even
when a measure is NULL (``COUNT(*)``), exactly as published.

Plan (broadcast off): 2 exchanges below the join (one per staged variable, each
after a map-side partial aggregate) + 1 tiny exchange for the final per-month
aggregate, whose input is already partially aggregated to at most
(#tasks x #months) rows. The month grouping therefore never concentrates raw rows
in one task, however large a single month is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.calendar import month_date
from tidemart.functions.cells import cell_coordinate
from tidemart.functions.zones import decade, latitude_zone
from tidemart.operators.joins import RAW_KEYS, cell_join
from tidemart.operators.staging import filter_months


def _month_parts():
    """``year_month, year, month`` of an aggregate grouped on integer (year, month)."""
    return [month_date("year", "month").alias("year_month"),
            F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month")]


def _bounded_join(sla_keyed: DataFrame, sst_keyed: DataFrame, start, end) -> DataFrame:
    return cell_join(filter_months(sla_keyed, start, end), filter_months(sst_keyed, start, end))


def _measures():
    return [
        F.avg("sea_level_anomaly_m").alias("avg_sla_m"),
        F.avg("sst_celsius").alias("avg_sst_celsius"),
        F.avg("sea_ice_fraction").alias("avg_sea_ice_fraction"),
        F.count(F.lit(1)).alias("grid_points"),
    ]


def monthly_global_trends(sla_keyed: DataFrame, sst_keyed: DataFrame,
                          start=None, end=None) -> DataFrame:
    """A3: one row per month with global averages and the joined cell count.

    ``start``/``end`` bound ``year_month`` inclusively (None = unbounded). The bound
    is applied to *both* join inputs: the predicate spans two join keys
    (``make_date(year, month, 1)``), which Spark cannot transfer across the join by
    itself, and stating it twice gives both lake scans static partition pruning
    (same result, as the join is inner).
    """
    joined = _bounded_join(sla_keyed, sst_keyed, start, end)
    agg = joined.groupBy("year", "month").agg(*_measures())
    return agg.select(*_month_parts(), "avg_sla_m", "avg_sst_celsius",
                      "avg_sea_ice_fraction", "grid_points")


def latitude_zone_stats(sla_keyed: DataFrame, sst_keyed: DataFrame,
                        start=None, end=None, step: float = 0.25) -> DataFrame:
    """A4: one row per month and latitude zone (zone of the *snapped* latitude)."""
    joined = _bounded_join(sla_keyed, sst_keyed, start, end).withColumn(
        "latitude_zone", latitude_zone(cell_coordinate("lat_idx", step)))
    agg = joined.groupBy("year", "month", "latitude_zone").agg(*_measures())
    return agg.select(*_month_parts(), "latitude_zone", "avg_sla_m",
                      "avg_sst_celsius", "avg_sea_ice_fraction", "grid_points")


def decadal_means(monthly: DataFrame, edges=None, else_label: str | None = None) -> DataFrame:
    """A5: per decade bucket, the average of the monthly averages (not of cells)."""
    kw = {} if else_label is None else {"else_label": else_label}
    return (monthly
            .withColumn("decade", decade(F.col("year"), edges, **kw))
            .groupBy("decade")
            .agg(F.avg("avg_sla_m").alias("avg_sla_m"),
                 F.avg("avg_sst_celsius").alias("avg_sst_celsius")))


def _raw_averages(raw_sla: DataFrame, raw_sst: DataFrame, keys: list, names: list[str]) -> DataFrame:
    """Averages over the join of the unsnapped raw tables, without making its rows.

    Both sides go through one aggregate: their rows are tagged, united and reduced (map-side
    combined) to a sum, a count of non-NULL values and a row count per side and raw key. A key
    with rows on both sides stands for rows x rows of the full join:
    avg = sum(sum_a * rows_b) / sum(count_a * rows_b). One exchange brings the two sides
    together; months that were appended several times cost nothing more than their scan.
    """
    def side(df, measure, own, other):
        keyed = df.select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                          F.col("latitude").cast("double").alias("latitude"),
                          F.col("longitude").cast("double").alias("longitude"), F.col(measure).cast("double").alias(f"v_{own}"))
        # a NULL key joins nothing
        return keyed.dropna(subset=RAW_KEYS).select(*RAW_KEYS, f"v_{own}", F.lit(None).cast("double").alias(f"v_{other}"),
                                                    F.lit(own == "a").alias("is_a"))
    both = side(raw_sla, "sea_level_anomaly_m", "a", "b").unionByName(side(raw_sst, "sst_celsius", "b", "a"))
    joined = (both.groupBy(*RAW_KEYS)
              .agg(*[f(f"v_{t}").alias(f"{n}_{t}") for t in "ab" for f, n in ((F.sum, "sum"), (F.count, "n"))],
                   F.count_if("is_a").alias("rows_a"), F.count_if(~F.col("is_a")).alias("rows_b"))
              .where((F.col("rows_a") > 0) & (F.col("rows_b") > 0)))

    def average(own, other):
        return F.try_divide(F.sum(F.col(f"sum_{own}") * F.col(f"rows_{other}")),
                            F.sum(F.col(f"n_{own}") * F.col(f"rows_{other}")))
    return joined.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(
        average("a", "b").alias("avg_sla_m"), average("b", "a").alias("avg_sst_celsius"))


def raw_monthly_trends(raw_sla: DataFrame, raw_sst: DataFrame) -> DataFrame:
    """The averages per month over the join of the unsnapped raw tables."""
    agg = _raw_averages(raw_sla, raw_sst, [F.col("year"), F.col("month")], ["year", "month"])
    return agg.select(month_date("year", "month").alias("year_month"),
                      "avg_sla_m", "avg_sst_celsius")


def raw_zone_stats(raw_sla: DataFrame, raw_sst: DataFrame) -> DataFrame:
    """The averages per month and zone over the join of the unsnapped raw tables."""
    agg = _raw_averages(raw_sla, raw_sst, [F.col("year"), F.col("month"), latitude_zone(F.col("latitude"))],
                        ["year", "month", "latitude_zone"])
    return agg.select(month_date("year", "month").alias("year_month"), "latitude_zone",
                      "avg_sla_m", "avg_sst_celsius")


def zone_partials(sla_keyed: DataFrame, sst_keyed: DataFrame, start=None, end=None,
                  step: float = 0.25) -> DataFrame:
    """One pass of the cell join reduced to sums and counts per (month, zone) — at
    most 5 rows per month. Both marts are exact re-aggregations of it
    (:func:`marts_from_partials`), so a build joins the cells once, not twice."""
    joined = _bounded_join(sla_keyed, sst_keyed, start, end).withColumn(
        "latitude_zone", latitude_zone(cell_coordinate("lat_idx", step)))
    sums = []
    for m in ("sea_level_anomaly_m", "sst_celsius", "sea_ice_fraction"):
        sums += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}")]
    return joined.groupBy("year", "month", "latitude_zone").agg(
        F.count(F.lit(1)).alias("grid_points"), *sums)


def _avgs(total):
    return [
        F.try_divide(total("sum_sea_level_anomaly_m"), total("n_sea_level_anomaly_m")).alias("avg_sla_m"),
        F.try_divide(total("sum_sst_celsius"), total("n_sst_celsius")).alias("avg_sst_celsius"),
        F.try_divide(total("sum_sea_ice_fraction"), total("n_sea_ice_fraction")).alias("avg_sea_ice_fraction"),
    ]


def marts_from_partials(partials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(monthly_global_trends, latitude_zone_stats)`` from :func:`zone_partials`
    (average = sum / count of non-NULL values; ``grid_points`` = joined cells)."""
    zones = partials.select(*_month_parts(), "latitude_zone", *_avgs(F.col),
                            F.col("grid_points"))
    monthly = (partials.groupBy("year", "month")
               .agg(*[F.sum(c).alias(c) for c in partials.columns
                      if c.startswith(("sum_", "n_")) or c == "grid_points"])
               .select(*_month_parts(), *_avgs(F.col), F.col("grid_points").cast("long")))
    return monthly, zones
