"""Column -> Column helpers, all built from ``pyspark.sql.functions``."""

from tidemart.functions.calendar import (
    month_date, month_label, month_label_to_year, month_label_to_month, month_spine,
    parse_date, parse_timestamp, year_of,
)
from tidemart.functions.cells import (
    GRID_025, GridSpec, cell_coordinate, cell_index, clip, snap, snap_index,
)
from tidemart.functions.cleaning import drop_missing, nan_to_null
from tidemart.functions.units import kelvin_to_celsius, metres_to_cm
from tidemart.functions.zones import (
    DEFAULT_DECADES, ZONE_NAMES, decade, latitude_zone, symmetric_limit,
)

__all__ = [
    "month_date", "month_label", "month_label_to_year", "month_label_to_month",
    "month_spine", "parse_date", "parse_timestamp", "year_of",
    "GRID_025", "GridSpec", "cell_coordinate", "cell_index", "clip", "snap", "snap_index",
    "drop_missing", "nan_to_null", "kelvin_to_celsius", "metres_to_cm",
    "DEFAULT_DECADES", "ZONE_NAMES", "decade", "latitude_zone", "symmetric_limit",
]
