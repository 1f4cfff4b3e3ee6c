"""User-level outputs of the dashboard and of ad-hoc exploration (D1-D5), each one
lazy DataFrame built from the marts, staging or raw tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.cells import GRID_025, GridSpec
from tidemart.functions.units import metres_to_cm
from tidemart.functions.zones import symmetric_limit
from tidemart.operators.marts import decadal_means
from tidemart.operators.quantiles import percentile_limits
from tidemart.operators.reshape import dense_raster, pivot_grid, zone_series
from tidemart.operators.series import first_point_per_zone, slice_month

# fixed origin for day numbers inside the trend aggregate (any date works)
_EPOCH = _dt.date(1993, 1, 1)


def _order(df: DataFrame, ordered: bool, *cols: str) -> DataFrame:
    """The chart order (``ORDER BY``) on request; results are small (one row per month
    or decade), so the sort is cheap — but it is left to the consumer by default."""
    return df.orderBy(*cols) if ordered else df


def trends(monthly: DataFrame, year_min: int = 1993, year_max: int = 2023,
           show_trend: bool = True, ordered: bool = False) -> DataFrame:
    """Monthly SLA (cm) and SST for a year range, with fitted straight lines.

    ``x_days`` counts days from the first month *after* the year filter; the fit is
    least squares of each series on ``x_days`` (NULL with fewer than two points).

    Everything comes from ONE aggregate over the series, read as a scalar subquery:
    the slope does not depend on the x origin, and the intercept at the series start
    ``d0`` is ``mean(y) - slope * (mean(d) - d0)`` with ``d`` = days since a fixed
    epoch. The subquery reads the same columns as the main query, so the series is
    computed once (its shuffle stages are reused) — no join, no global window.
    """
    df = (monthly
          .where(F.year("year_month").between(F.lit(year_min), F.lit(year_max)))
          .select("year_month", metres_to_cm("avg_sla_m").alias("avg_sla_cm"), "avg_sst_celsius"))
    d = F.datediff(F.col("year_month"), F.lit(_EPOCH)).cast("double")
    fit = df.select(F.struct(
        F.min(d).alias("d0"),
        F.regr_slope("avg_sla_cm", d).alias("a_sla"),
        F.regr_avgx("avg_sla_cm", d).alias("dx_sla"),
        F.regr_avgy("avg_sla_cm", d).alias("y_sla"),
        F.regr_slope("avg_sst_celsius", d).alias("a_sst"),
        F.regr_avgx("avg_sst_celsius", d).alias("dx_sst"),
        F.regr_avgy("avg_sst_celsius", d).alias("y_sst")).alias("_fit")).scalar()
    f = F.col("_fit")  # the subquery is attached once; fields are read from the column
    out = df.withColumn("_fit", fit).withColumn("x_days", d - f.getField("d0"))
    if not show_trend:
        return _order(out.drop("_fit"), ordered, "year_month")

    def line(a, dx, y):
        slope = f.getField(a)
        intercept = f.getField(y) - slope * (f.getField(dx) - f.getField("d0"))
        return slope * F.col("x_days") + intercept
    return _order(out.withColumns({
        "trend_sla_cm": line("a_sla", "dx_sla", "y_sla"),
        "trend_sst_celsius": line("a_sst", "dx_sst", "y_sst"),
    }).drop("_fit"), ordered, "year_month")


def trend_line(monthly: DataFrame, value: str, year_min: int = 1993, year_max: int = 2023,
               scale: float = 1.0, prefix: str = "") -> DataFrame:
    """A10 over a D1 series: ``slope, intercept, n_points`` of ``value * scale`` on the days
    since the first month of the year range, from one aggregate over the mart (the slope does
    not depend on the x origin; the intercept is moved to the first month)."""
    d = F.datediff(F.col("year_month"), F.lit(_EPOCH)).cast("double")
    y = F.col(value) * F.lit(scale)
    s = (monthly.where(F.year("year_month").between(F.lit(year_min), F.lit(year_max)))
         .agg(F.min(d).alias("d0"), F.regr_slope(y, d).alias("a"), F.regr_avgx(y, d).alias("dx"),
              F.regr_avgy(y, d).alias("y"), F.count(value).alias("n")))
    return s.select(F.col("a").alias(f"{prefix}slope"),
                    (F.col("y") - F.col("a") * (F.col("dx") - F.col("d0"))).alias(f"{prefix}intercept"),
                    F.col("n").alias(f"{prefix}n_points"))


def decades(monthly: DataFrame, edges=None, ordered: bool = False) -> DataFrame:
    """Decade averages of the monthly means, SLA also in cm."""
    return _order(decadal_means(monthly, edges)
                  .withColumn("avg_sla_cm", metres_to_cm("avg_sla_m")), ordered, "decade")


def zones(zone_stats: DataFrame, ordered: bool = False) -> DataFrame:
    """D3: SST series per latitude zone (long form)."""
    return _order(zone_series(zone_stats, "avg_sst_celsius"), ordered, "year_month", "latitude_zone")


def zone_markers(zone_stats: DataFrame) -> DataFrame:
    """D3 legend markers: first month and value of each zone's series."""
    return first_point_per_zone(zone_stats, "avg_sst_celsius")


def sst_map(staged_sst: DataFrame, year: int, month: int, grid: GridSpec = GRID_025) -> DataFrame:
    """Dense raster rows of one month's staged SST (NaN where no data)."""
    one = slice_month(staged_sst, year, month)
    return dense_raster(one, "sst_celsius", grid)


def map_limits(month_slice: DataFrame, value: str, symmetric: bool) -> DataFrame:
    """D5 colour limits: 2nd/98th percentile (NaN skipped); for a diverging scale the
    symmetric half-width ``max(|p2|, |p98|)`` as well."""
    lim = percentile_limits(month_slice, value, 0.02, 0.98, names=("p02", "p98"))
    if symmetric:
        lim = lim.withColumn("abs_max", symmetric_limit("p02", "p98"))
    return lim


def latest_map(month_slice: DataFrame, value: str, col_values=None) -> DataFrame:
    """D5 grid: latitude x longitude pivot of the month (duplicates are an error)."""
    return pivot_grid(month_slice, value, "latitude", "longitude", col_values=col_values)
