"""The batch build for a month range: raw lake -> staging -> marts.

1. scan both raw lakes, pruned to the months (partition filters);
2. regrid SST and replace those months of ``staging.sea_surface_temperature``;
3. read the staged months back (the written table cuts the lineage: a lost
   executor recomputes from the table, not from the raw lake), stage SLA as a view,
   join the cells ONCE into per-(month, zone) sums and counts, checkpoint that small
   table to the shared ``spark.checkpoint.dir``, and replace those months of both
   marts from it.

Every write is a dynamic partition overwrite keyed by ``year_month``, so re-running
a range is idempotent and other months are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemart.operators.marts import marts_from_partials, zone_partials
from tidemart.operators.staging import CELL_KEYS, filter_months, keyed_cells, month_floor, public_cells, regrid_sst, stage_sla
from tidemart.schemas import RAW_SLA, RAW_SST
from tidemart.sources.lake import scan_lake
from tidemart.session import ensure_checkpoint_dir
from tidemart.sources.tables import (
    create_cell_table, create_staged_view, create_tables, create_view, delete_insert, publish_lake, read_cells, write_cells,
)


@dataclass(frozen=True)
class Layout:
    """Where the layers live: two lake folders and a table-name prefix."""

    sla_lake: str
    sst_lake: str
    prefix: str = ""
    #: over 0: stage both variables into tables with so many buckets per month, which join without an exchange
    cell_buckets: int = 0
    #: make the staging view of sea level in the catalog, over an external table on the lake
    catalog_view: bool = False

    @property
    def staging_sst(self) -> str:
        return f"{self.prefix}staging.sea_surface_temperature"

    def cells(self, variable: str) -> str:
        return f"{self.prefix}staging.{variable}_cells"

    @property
    def staged_view(self) -> str:
        return f"{self.prefix}staging.sea_level_anomaly"

    @property
    def monthly(self) -> str:
        return f"{self.prefix}mart.monthly_global_trends"

    @property
    def zones(self) -> str:
        return f"{self.prefix}mart.latitude_zone_stats"


def build(spark: SparkSession, layout: Layout, start: str, end: str) -> None:
    """Rebuild staging SST for the months of ``start`` to ``end`` (both whole), and both marts
    for the months whose first day lies in ``[start, end]``."""
    create_tables(spark, layout.prefix)

    raw_sst = scan_lake(spark, layout.sst_lake, RAW_SST, start, end)
    delete_insert(spark, public_cells(regrid_sst(raw_sst)), layout.staging_sst)

    staged_sst = keyed_cells(filter_months(spark.table(layout.staging_sst), month_floor(start), month_floor(end),
                                           col="year_month"))  # partition-pruned read
    raw_sla = scan_lake(spark, layout.sla_lake, RAW_SLA, start, end)
    sla = stage_sla(raw_sla)
    # the published view covers the whole lake, whatever range is rebuilt
    if layout.catalog_view:
        raw_table = f"{layout.prefix}staging.sea_level_anomaly_lake"
        publish_lake(spark, layout.sla_lake, RAW_SLA, raw_table)
        create_staged_view(spark, layout.staged_view, raw_table)
    else:
        every_sla = stage_sla(scan_lake(spark, layout.sla_lake, RAW_SLA))
        create_view(public_cells(every_sla), f"{layout.prefix.replace('.', '_')}staging_sea_level_anomaly")
    if layout.cell_buckets:
        sla, staged_sst = (_in_buckets(spark, layout, keyed, name, start, end) for keyed, name in
                           ((sla, "sea_level_anomaly"), (staged_sst, "sea_surface_temperature")))

    ensure_checkpoint_dir(spark)
    partials = zone_partials(sla, staged_sst, start, end).checkpoint(eager=True)
    monthly, zones = marts_from_partials(partials)
    delete_insert(spark, monthly, layout.monthly)
    delete_insert(spark, zones, layout.zones)


def _in_buckets(spark: SparkSession, layout: Layout, keyed, variable: str, start, end):
    """The keyed frame written to its bucketed table and read back for the range."""
    table = layout.cells(variable)
    create_cell_table(spark, table, [c for c in keyed.columns if c not in CELL_KEYS], layout.cell_buckets)
    write_cells(spark, keyed, table)
    return read_cells(spark, table, start, end)


def ingest_month(spark: SparkSession, grid_rows, base: str, schema, measure: str,
                 primary: str, measures: list[str] | None = None,
                 kelvin: list[str] | None = None, range_partitions: int | None = None) -> None:
    """Gridded month rows (one row per latitude with a values array, already flattened
    by ``sources.gridded.grid_flatten``) -> cleaned observations -> the raw lake,
    replacing the months present."""
    from tidemart.sources.lake import ingest_grid, write_lake_month
    clean = ingest_grid(grid_rows, measure, primary, measures=measures, kelvin=kelvin)
    write_lake_month(clean, base, schema, range_partitions=range_partitions)


def main(argv=None) -> None:
    """``python -m tidemart.plans.pipeline --sla-lake P --sst-lake P --start D --end D``"""
    import argparse
    from tidemart.session import get_session
    ap = argparse.ArgumentParser(description="Rebuild staging and marts for a month range.")
    ap.add_argument("--sla-lake", required=True)
    ap.add_argument("--sst-lake", required=True)
    ap.add_argument("--start", default="1993-01-01")
    ap.add_argument("--end", default="2023-12-31")
    ap.add_argument("--prefix", default="")
    args = ap.parse_args(argv)
    spark = get_session()
    build(spark, Layout(args.sla_lake, args.sst_lake, args.prefix), args.start, args.end)


if __name__ == "__main__":
    main()
