"""Small helpers on sessions and shared folders."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import forget_powers

BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def release_memory() -> None:
    """Give back to the system what a finished task has freed: a Python worker stays for the next task, beside a
    JVM that may need the memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def releasing(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A group function that gives memory back after its group."""
    def run(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            release_memory()

    return run


def map_texts(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` for rows with texts: batches of at most BATCH_ROWS rows, as ten thousand long texts in a batch weigh
    on the JVM and on Python, and memory goes back after a task.

    Spark takes the size of batches from the session when a plan is run, so the session's setting is lowered and stays so;
    it bounds batches only and changes no result."""
    conf = df.sparkSession.conf
    now = int(conf.get(_BATCH_SETTING, "10000") or 10000)
    if now <= 0 or now > BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            forget_powers()
            gc.collect()
            release_memory()

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below this application's folder in the one that ``spark.checkpoint.dir`` names, for files which
    executors share; ``session.remove_intermediates`` removes them all."""
    from towerlens.session import run_folder

    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: later steps start from the files, so a
    lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 48 << 20


def broadcast_if_small(found: DataFrame) -> DataFrame:
    """A stored frame, marked for broadcast only if its files hold at most ``BROADCAST_BYTES`` (counted four times,
    for what they take in memory).  Beyond that, joins shuffle; results are the same."""
    spark = found.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for f in found.inputFiles():
        where = jvm.org.apache.hadoop.fs.Path(f)
        size += where.getFileSystem(conf).getFileStatus(where).getLen()
    return F.broadcast(found) if 4 * size <= BROADCAST_BYTES else found


def joined_small(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of many rows with a stored frame of finds, see ``broadcast_if_small``."""
    return rows.join(broadcast_if_small(found), keys, how)
