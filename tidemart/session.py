"""SparkSession helpers.

``get_session`` only fills in settings that are still unset, so a cluster's own
configuration (shuffle partitions, checkpoint dir, ...) always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local run; a cluster session keeps whatever it already has (see
# README "Cluster settings" for the recommended cluster equivalents).
LOCAL_DEFAULTS = {
    # broadcast only what AQE has *measured* after a shuffle stage, never a plan-time
    # estimate derived from compressed file sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "tidemart",
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(LOCAL_DEFAULTS)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read here; if it is
    unset there, this raises, also when a ``fallback`` is given. In local mode (tests) the
    folder that the context already has is kept, or else ``fallback`` or a fresh folder is
    registered with it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is not set: point it at a shared folder "
                         "(a machine-local folder is not readable after executor loss)")
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    path = fallback or tempfile.mkdtemp(prefix="tidemart-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return path
