"""Written intermediate tables with a defined end of life.

:func:`written` writes a frame to the shared checkpoint folder and reads it back: it is
computed once, its lineage is cut, and a lost executor costs a reread. The files live until
the innermost open :func:`lifetime` of the session ends, or until :func:`drop_written`; without
either they stay, as checkpoints do. A frame that reads them must be consumed before that.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemart.session import ensure_checkpoint_dir

#: (kind, name) of folders, tables and views by open lifetime; the first list belongs to none
_OPEN: list[list[tuple[str, str]]] = [[]]


def ends(kind: str, name: str) -> None:
    """Let a ``folder``, ``table``, ``catalog view`` or temporary ``view`` end with the open lifetime."""
    _OPEN[-1].append((kind, name))


def scratch_path(spark: SparkSession, kind: str = "scratch") -> str:
    """A new folder name under the shared checkpoint folder, which ends with the open lifetime."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemart-{kind}-{uuid.uuid4().hex}"
    ends("folder", path)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, written and read back."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _drop(spark: SparkSession, made: list[tuple[str, str]]) -> int:
    n = len(made)
    while made:
        kind, name = made.pop()
        if kind == "folder":
            delete_folder(spark, name)
        elif kind == "view":
            spark.catalog.dropTempView(name)
        elif kind == "catalog view":
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return n


def drop_written(spark: SparkSession) -> int:
    """Delete what belongs to the innermost lifetime (to none, if none is open); how much that was."""
    return _drop(spark, _OPEN[-1])


@contextmanager
def lifetime(spark: SparkSession):
    """What is made inside the block is deleted at its end, also after an error."""
    _OPEN.append([])
    try:
        yield
    finally:
        _drop(spark, _OPEN.pop())
