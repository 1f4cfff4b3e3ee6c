"""Unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 0 degrees C in kelvin
KELVIN_OFFSET = 273.15


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kelvin_to_celsius(x) -> Column:
    return _col(x) - F.lit(KELVIN_OFFSET)


def metres_to_cm(x) -> Column:
    return _col(x) * F.lit(100.0)
