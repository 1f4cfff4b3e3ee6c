"""User-level query plans: dashboard outputs and the batch build."""

from tidemart.plans.dashboard import (
    decades, latest_map, map_limits, sst_map, trends, zone_markers, zones,
)
from tidemart.plans.pipeline import Layout, build, ingest_month

__all__ = ["decades", "latest_map", "map_limits", "sst_map", "trends", "zone_markers", "zones",
           "Layout", "build", "ingest_month"]
