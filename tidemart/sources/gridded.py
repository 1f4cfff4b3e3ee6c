"""Gridded arrays -> long observation rows.

A gridded month is stored row-wise: one row per latitude with the longitude axis
(or its origin and step) and an ``array<double>`` of values, so a row's size is
bounded by the grid width. ``posexplode`` turns each row into one record per cell,
in parallel over rows. A small 2-D grid held in a single row (``array<array<double>>``
plus a latitude axis) can first be split with :func:`split_rows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source variable/coordinate names -> published column names
SOURCE_NAMES = {
    "lat": "latitude",
    "lon": "longitude",
    "sla": "sea_level_anomaly_m",
    "analysed_sst": "sst_celsius",
}


def rename_source_columns(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Source names -> published names (only the columns present are renamed)."""
    mapping = {k: v for k, v in (names or SOURCE_NAMES).items() if k in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def tag_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Add the month's ``year`` and ``month`` as INT literals."""
    return df.withColumns({"year": F.lit(int(year)).cast("int"), "month": F.lit(int(month)).cast("int")})


def split_rows(df: DataFrame, grid_col: str, lat_axis_col: str, keep: list[str]) -> DataFrame:
    """2-D grid row -> one row per latitude: ``(keep..., latitude, values)``."""
    return (df.select(*keep, lat_axis_col, F.posexplode(grid_col).alias("_i", "values"))
              .select(*keep, F.element_at(F.col(lat_axis_col), F.col("_i") + 1).alias("latitude"),
                      "values"))


def grid_flatten(df: DataFrame, values_col: str | list[str], value_name: str | list[str], *,
                 lon_axis_col: str | None = None, lon_min: float | None = None, step: float | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """One output row per array element: ``(keep..., longitude, value_name...)``.

    Several variables of one grid are given as lists; their arrays are zipped and exploded
    once, so no join brings them together again (a shorter array is filled with NULL). The
    longitude comes from ``lon_axis_col`` (an ``array<double>`` axis, looked up by position)
    or from ``lon_min + pos * step``. NaN values are kept, so the caller decides how to treat
    missing cells (see ``functions.cleaning.drop_missing``).
    """
    arrays = [values_col] if isinstance(values_col, str) else list(values_col)
    names = [value_name] if isinstance(value_name, str) else list(value_name)
    if len(arrays) != len(names):
        raise ValueError("grid_flatten: one name per variable")
    keep = list(keep or [])
    extra = [lon_axis_col] if lon_axis_col else []
    if len(arrays) == 1:
        exploded = df.select(*keep, *extra, F.posexplode(arrays[0]).alias("_pos", names[0]))
    else:
        zipped = F.arrays_zip(*[F.col(a).alias(f"_v{i}") for i, a in enumerate(arrays)])
        cells = df.select(*keep, *extra, F.posexplode(zipped).alias("_pos", "_cell"))
        fields = [f.name for f in cells.schema["_cell"].dataType.fields]
        exploded = cells.select(*keep, *extra, "_pos",
                                *[F.col("_cell").getField(f).alias(n) for f, n in zip(fields, names)])
    if lon_axis_col:
        lon = F.element_at(F.col(lon_axis_col), F.col("_pos") + 1)
    else:
        lon = F.lit(float(lon_min)) + F.col("_pos").cast("double") * F.lit(float(step))
    return exploded.select(*keep, lon.cast("double").alias("longitude"), *names)
