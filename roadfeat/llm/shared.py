"""Tables kept between jobs in the folder that the driver and all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 8 << 20
_fallback: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in plain local mode where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="roadfeat-llm-")
    return _fallback[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back: a cut lineage that survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``store``; only when nothing unfinished reads it."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(df: DataFrame) -> DataFrame:
    """``df`` itself; from here on its session hands rows to Python in batches of at most ``BATCH_BYTES``.

    Texts are of any length, so a batch is bounded by its bytes; a longer text is a batch of its own.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return freed memory to the system, which neither Arrow nor the C library does by itself."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library


def whole_groups(batches: Iterator, key: str) -> Iterator:
    """Arrow tables from batches sorted by ``key``, cut so that no key is spread over two tables."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = table[key][-1]
        n_last = pc.sum(pc.equal(table[key], last)).as_py()
        cut = table.num_rows - n_last
        if cut:
            yield pa.concat_tables([*held, table.slice(0, cut)])
            held = [table.slice(cut)]
        elif held and held[-1][key][-1] != last:
            yield pa.concat_tables(held)
            held = [table]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held)
