"""DataFrame -> DataFrame operators (staging, joins, marts, trends, percentiles,
reshapes, series helpers and data-quality checks)."""

from tidemart.operators.joins import cell_join, key_filter, misaligned_join_count, raw_cell_join
from tidemart.operators.marts import (
    decadal_means, latitude_zone_stats, marts_from_partials, monthly_global_trends,
    raw_monthly_trends, raw_zone_stats, zone_partials,
)
from tidemart.operators.quality import (
    check_accepted_values, check_not_empty, check_not_null, check_positive, check_unique,
    mart_checks,
)
from tidemart.operators.quantiles import exact_percentiles, percentile_limits
from tidemart.operators.reshape import (
    dense_fill, dense_raster, pivot_grid, raster_cells, zone_series, zone_series_arrays,
)
from tidemart.operators.series import (
    distinct_values, first_point_per_zone, latest_month, latest_month_value, slice_latest_month,
    slice_month, sorted_axis,
)
from tidemart.operators.staging import keyed_cells, public_cells, regrid_sst, stage_sla
from tidemart.operators.trends import days_since_start, linear_trend, month_ordinal, with_fitted

__all__ = [
    "cell_join", "key_filter", "misaligned_join_count", "raw_cell_join",
    "decadal_means", "latitude_zone_stats", "marts_from_partials", "monthly_global_trends",
    "raw_monthly_trends", "raw_zone_stats", "zone_partials",
    "check_accepted_values", "check_not_empty", "check_not_null", "check_positive",
    "check_unique", "mart_checks",
    "exact_percentiles", "percentile_limits",
    "dense_fill", "dense_raster", "pivot_grid", "raster_cells", "zone_series", "zone_series_arrays",
    "distinct_values", "first_point_per_zone", "latest_month", "latest_month_value",
    "slice_latest_month", "slice_month", "sorted_axis",
    "keyed_cells", "public_cells", "regrid_sst", "stage_sla",
    "days_since_start", "linear_trend", "month_ordinal", "with_fitted",
]
