"""Reshapes of one month's cells: pivoted grid, dense raster rows, dense long grid,
and per-zone series.

The dense raster is built row by row: one row per (month, latitude index) holding
an ``array<double>`` of ``n_lon`` values (NaN where there is no observation). A
row's size is bounded by the grid width (1441 at 0.25 degrees), never by data
volume, and rows are spread over tasks by (month, latitude index).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.cells import GRID_025, GridSpec, lat_raster_index, lon_raster_index

NAN = float("nan")


def raster_cells(obs: DataFrame, value: str, grid: GridSpec = GRID_025,
                 month_col: str = "year_month") -> DataFrame:
    """Raster indices ``lat_i, lon_i`` (rint, clipped to the grid) and one
    value per raster cell. Cells are unique after staging; if clipping maps two
    observations to one cell, the one with the greatest (latitude, longitude) wins."""
    return (obs
            .select(month_col,
                    lat_raster_index("latitude", grid).alias("lat_i"),
                    lon_raster_index("longitude", grid).alias("lon_i"),
                    F.struct(F.col("latitude").cast("double"), F.col("longitude").cast("double")).alias("_pos"),
                    F.col(value).cast("double").alias(value))
            .groupBy(month_col, "lat_i", "lon_i")
            .agg(F.max_by(F.col(value), F.col("_pos")).alias(value)))


def dense_raster(obs: DataFrame, value: str, grid: GridSpec = GRID_025,
                 month_col: str = "year_month", months: DataFrame | None = None,
                 unique_cells: bool = False) -> DataFrame:
    """R2: ``n_lat`` rows per month of ``(month, lat_i, latitude, values array<double>)``
    with ``values[lon_i]`` = the cell's value or NaN.

    ``months`` (one column ``month_col``) selects which months get a full raster;
    by default every month present in ``obs``.

    Cells are reduced to one value each first (partial aggregation absorbs any
    number of duplicate copies before the shuffle), so every collected row holds at
    most ``n_lon`` entries whatever the input's duplication. ``unique_cells`` says that no
    two observations fall on one cell (staged input), which saves that aggregate; if two do,
    the query fails on the duplicate.
    """
    if unique_cells:
        cells = obs.select(month_col, lat_raster_index("latitude", grid).alias("lat_i"),
                           lon_raster_index("longitude", grid).alias("lon_i"), F.col(value).cast("double").alias(value))
    else:
        cells = raster_cells(obs, value, grid, month_col)
    # a cell without a coordinate has no place on the grid (and cannot be a map key)
    cells = cells.where(F.col("lat_i").isNotNull() & F.col("lon_i").isNotNull())
    rows = (cells.groupBy(month_col, "lat_i")
                 .agg(F.map_from_entries(F.collect_list(F.struct("lon_i", value))).alias("_cells")))
    if months is None:
        months = cells.select(month_col).distinct()
    spine = months.select(month_col,
                          F.explode(F.sequence(F.lit(0), F.lit(grid.n_lat - 1))).alias("lat_i"))
    lon_axis = F.sequence(F.lit(0), F.lit(grid.n_lon - 1))
    return (spine.join(rows, on=[month_col, "lat_i"], how="left")
                 .select(month_col, "lat_i",
                         (F.lit(grid.lat_min) + F.col("lat_i").cast("double") * F.lit(grid.step))
                         .alias("latitude"),
                         F.transform(lon_axis, lambda i: F.coalesce(
                             F.try_element_at(F.col("_cells"), i), F.lit(NAN))).alias("values")))


def dense_fill(obs: DataFrame, value: str, grid: GridSpec = GRID_025,
               month_col: str = "year_month", months: DataFrame | None = None,
               unique_cells: bool = False) -> DataFrame:
    """The full cell grid of each month as long rows, missing cells as NaN:
    ``(month, lat_i, lon_i, latitude, longitude, value)``.

    The rows of :func:`dense_raster`, exploded: what is shuffled is one row per month and
    latitude, not one per cell of the grid. A month of ``obs`` without any cell on the grid
    has no rows unless ``months`` names it."""
    rows = dense_raster(obs, value, grid, month_col, months, unique_cells)
    return rows.select(month_col, "lat_i", "latitude", F.posexplode("values").alias("lon_i", value)).select(
        month_col, "lat_i", "lon_i", "latitude",
        (F.lit(grid.lon_min) + F.col("lon_i").cast("double") * F.lit(grid.step)).alias("longitude"), value)


def pivot_grid(df: DataFrame, value: str, row: str = "latitude", col: str = "longitude",
               col_values=None, strict: bool = True) -> DataFrame:
    """``row`` x ``col`` matrix, one column per ``col`` value (named by its string
    form). A duplicated (row, col) pair is an error when ``strict``. Passing
    ``col_values`` (the grid axis) saves the extra job that discovers them; a cell off that
    axis, or without a column value, is an error, as the pivot would drop it."""
    cell = F.first(F.col(value))
    if strict:
        cell = F.when(F.count(F.lit(1)) > 1,
                      F.raise_error(F.lit("pivot_grid: duplicate cell"))).otherwise(F.first(F.col(value)))
    if col_values is not None:
        off = F.raise_error(F.concat(F.lit("pivot_grid: cell off the axis at "), F.coalesce(F.col(col).cast("string"), F.lit("NULL"))))
        df = df.withColumn(col, F.when(F.col(col).isin(list(col_values)), F.col(col)).otherwise(off.cast(df.schema[col].dataType)))
    grouped = df.groupBy(row)
    pivoted = grouped.pivot(col, list(col_values)) if col_values is not None else grouped.pivot(col)
    return pivoted.agg(cell)


def zone_series(zone_stats: DataFrame, value: str = "avg_sst_celsius") -> DataFrame:
    """R3 (long form): ``year_month, latitude_zone, value`` of the zone mart."""
    return zone_stats.select("year_month", "latitude_zone", value)


def zone_series_arrays(zone_stats: DataFrame, value: str = "avg_sst_celsius") -> DataFrame:
    """R3 (array form): one row per zone with its month-ordered series. A series holds
    one entry per month, so an array is bounded by the calendar."""
    return (zone_stats.groupBy("latitude_zone")
            .agg(F.array_sort(F.collect_list(F.struct("year_month", value))).alias("series")))
