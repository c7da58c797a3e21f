"""Session helpers: the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local sessions.

    A cluster names the folder in ``spark.checkpoint.dir``. A local session
    without that setting (tests, laptops) gets a fresh temporary folder; a
    cluster session without it is an error, since a machine-local folder would
    vanish with its host.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="nudgelab-checkpoint-"))
    else:
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so lost executors never recompute it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared checkpoint folder."""
    return posixpath.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    For wide or often-read frames: unlike a checkpoint it is compressed and each
    reader loads only its columns. The table stays until the folder is cleared.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slice_count(spark: SparkSession) -> int:
    """Number of range slices for globally ordered work."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def discard(df: DataFrame) -> None:
    """Remove the table that ``materialize`` wrote for ``df``, which nothing may read any more.

    Only folders below the shared checkpoint folder are removed.
    """
    spark = df.sparkSession
    folders = {posixpath.dirname(f) for f in df.inputFiles()}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(checkpoint_root(spark)).toUri().getPath()
    for folder in folders:
        if not path(folder).toUri().getPath().startswith(root.rstrip("/") + "/"):
            raise ValueError(f"{folder} is not a table of this library")
        path(folder).getFileSystem(hadoop).delete(path(folder), True)
