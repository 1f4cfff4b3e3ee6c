"""tidemart — monthly ocean-grid analytics on Spark DataFrames.

Layers:

* ``functions``  — Column -> Column helpers (snapping, zones, calendar, units, cleaning)
* ``sources``    — lake/table readers and writers, typed frames, gridded-array rows,
                   and the derived observation views used by the test data
* ``operators``  — DataFrame -> DataFrame building blocks (staging, joins, marts,
                   trends, exact percentiles, reshapes, data-quality checks)
* ``plans``      — user-level query plans (dashboard outputs, the batch build)
* ``streaming``  — incremental month-by-month build driven by Structured Streaming

Every operator is a plain function usable with ``DataFrame.transform``; nothing in
the hot path leaves the JVM (no Python UDFs).
"""

from tidemart.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
