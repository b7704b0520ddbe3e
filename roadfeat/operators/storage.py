"""Cut a lineage by writing the frame to the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see; a temporary one stands in for it in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_CONF, None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="roadfeat-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back with a size that the planner knows."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that this driver has written to the shared folder so far; frames built on them can't be run again."""
    count = len(_made)
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return count


def materialize(df: DataFrame) -> DataFrame:
    """The same rows, read back from reliable storage, so lost executors cost no recomputation.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` (a session default here) Spark deletes the
    files when the frame is no longer used.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
