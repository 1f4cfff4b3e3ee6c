"""Readers, writers and typed frames: the Parquet lake, catalog tables with
month-at-a-time replacement, gridded-array rows and the derived test views."""

from tidemart.sources.frames import concat_months, empty_typed, values_table
from tidemart.sources.gridded import grid_flatten, rename_source_columns, split_rows, tag_month
from tidemart.sources.lake import (
    MissingMonth, append_lake, ingest_grid, lake_months, newest_lake_month, scan_lake, scan_newest_month, scan_paths,
    scan_published, write_lake_month, write_published,
)
from tidemart.sources.scratch import drop_written, lifetime, written
from tidemart.sources.tables import (
    append_table, bulk_load_append, create_cell_table, create_staged_view, create_table, create_tables, create_view,
    ctas_temp, delete_insert, publish_lake, read_cells, read_published, read_table, write_cells,
)

__all__ = [
    "concat_months", "empty_typed", "values_table",
    "grid_flatten", "rename_source_columns", "split_rows", "tag_month",
    "MissingMonth", "append_lake", "ingest_grid", "lake_months", "newest_lake_month", "scan_lake", "scan_newest_month",
    "scan_paths", "scan_published", "write_lake_month", "write_published",
    "drop_written", "lifetime", "written",
    "append_table", "bulk_load_append", "create_cell_table", "create_staged_view", "create_table", "create_tables",
    "create_view", "ctas_temp", "delete_insert", "publish_lake", "read_cells", "read_published", "read_table", "write_cells",
]
