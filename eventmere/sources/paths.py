"""Folder helpers that work on any file system Spark can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none when it is missing."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def filled_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path that hold a finished data file.

    Spark moves a file here only when its write has ended, so no marker is needed.
    """
    fs, hadoop_path = _file_system(spark, f"{path}/*/part-*")
    found = fs.globStatus(hadoop_path)
    return sorted({s.getPath().getParent().getName() for s in found or []})


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file fits a glob."""
    fs, hadoop_path = _file_system(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def first_lines(spark: SparkSession, files: list[str], at_once: int = 16) -> list[str]:
    """The first line of each file, read by Spark's own file systems; one short read per file."""

    def first(path: str) -> str:
        fs, hadoop_path = _file_system(spark, path)
        source = fs.open(hadoop_path)
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(source, "UTF-8"))
            return (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            source.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first, files))


def literal(path: str) -> str:
    """A path whose characters do not act as a glob."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a glob, in order."""
    fs, hadoop_path = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop_path) or [])


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local-mode session without the setting gets a folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="eventmere-")
        _local_folders[context.applicationId] = folder
        context.setCheckpointDir(folder)
    return _local_folders[context.applicationId]


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A name below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
