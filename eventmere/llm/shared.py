"""Stored intermediate tables, and questions asked of all documents in blocks."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.sources import paths

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Text bytes one block of documents should hold: what one task has in memory.
BLOCK_BYTES = 6_000_000

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that goes to a Python worker, and of a group after which its memory is given back.
BATCH_BYTES, GROUP_BYTES = 8 << 20, 1 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the folder all executors share.

    It cuts lineage in a way that survives lost executors. The shuffle files of
    the job that wrote it are not needed any more and go at once.
    """
    spark = df.sparkSession
    folder = paths.fresh_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    collect(spark)
    return spark.read.schema(df.schema).parquet(folder)


def collect(spark: SparkSession) -> None:
    """Let the driver drop what ended jobs have left: plans, generated classes, broadcast tables.

    Spark lets go of a broadcast when the JVM finds that nothing refers to it any more. A
    driver of little live data seldom looks, and its heap grows to the limit meanwhile.
    """
    gc.collect()  # Python's frames hold the JVM's.
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(docs: DataFrame, text: str = "text", size: int = BLOCK_BYTES) -> int:
    """How many blocks of about ``size`` text bytes the documents make."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    return max(1, -(-int(total) // size))


def block_of(count: int, *keys: str) -> Column:
    """The block of a document, by all its keys, so that one repeated key does not fill a block."""
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lanes in which the matrices of all tasks are added first.
LANES = 16


def summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of a matrix each task makes of its batches.

    A task sends its matrix by rows. Rows of one number meet in two steps: in lanes, by
    task, and then over the lanes, so that no group holds a vector of every task.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            found = part(batch)
            total = found if total is None else total + found
        if total is not None:
            lane = pa.array([TaskContext.get().partitionId() % LANES] * len(total), pa.int32())
            values = pa.array([r.tobytes() for r in total], pa.binary())
            yield pa.RecordBatch.from_arrays([lane, pa.array(range(len(total)), pa.int32()), values], ["lane", "row", "v"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v) for v in table.column("v").to_pylist())
        return pa.table({"row": table.column("row")[:1], "v": pa.array([total.tobytes()], pa.binary())})

    in_lanes = rows.mapInArrow(given_back(partial), "lane int, row int, v binary").groupBy("lane", "row").applyInArrow(add, "row int, v binary")
    found = in_lanes.groupBy("row").applyInArrow(add, "row int, v binary").collect()
    out = np.zeros((max((r["row"] for r in found), default=-1) + 1, size))
    for r in found:
        out[r["row"]] = np.frombuffer(r["v"])
    return out


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, which returns its memory to the system when it ends.

    Python workers outlive their tasks; what one stage held would count beside the next one's.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return wrapped


def group_given_back(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same function of a group, which returns its memory after every larger one."""

    @functools.wraps(run)
    def wrapped(table: pa.Table) -> pa.Table:
        size, found = table.nbytes, run(table)
        del table
        if size > GROUP_BYTES:
            release_memory()
        return found

    return wrapped


def release_memory() -> None:
    """Return to the system what this Python process has free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on let tasks and their Python workers exchange about ``BATCH_BYTES`` at a time, unless the session has its own limit.

    Both sides hold a batch, the JVM's outside its heap and in buffers of up to twice its size.
    """
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a folder, and the folder's path on it."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
