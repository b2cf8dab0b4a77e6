"""Batches that become visible all at once.

Files of a batch go to ``<root>/<table>/batch_id=<id>``; one row in
``<root>/manifest/batch_id=<id>`` is written last. Readers open only folders of
batches the manifest names, so a batch that failed half-way is never seen, and its
retry replaces the files. A committed batch is not written again, not even after it
was retired.

The manifest row's file is the commit, for readers and for streams that watch the
manifest alike. Success markers are not looked at; they may be switched off.

Small batches can be merged into one folder, and rows removed by key without touching
files; see :mod:`eventmere.sources.layout`. Readers follow both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.schemas import TABLES
from eventmere.sources import layout, paths
from eventmere.sources.layout import Layout
from eventmere.sources.tables import Tables, from_reader

#: Tables whose rows go with a retired batch. Users stay.
EVENT_TABLES = tuple(name for name in TABLES if name != "users")

#: Keys by which rows of the event tables are removed.
REMOVAL_KEYS = {name: "order_id" if name == "payment_tasks" else "event_id" for name in EVENT_TABLES}
REMOVED_KEYS = "event_id string, order_id string, batch_id string"

MANIFEST = T.StructType(
    [T.StructField("committed_at", T.TimestampType()), T.StructField("batch_id", T.StringType())]
)


def batch_folder(root: str, table: str, batch_id: str) -> str:
    return f"{root}/{table}/batch_id={batch_id}"


def is_committed(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Whether the batch was ever committed, retired ones included."""
    return any(
        paths.matches(spark, f"{batch_folder(root, state, batch_id)}/part-*") for state in ("manifest", "retired")
    )


def _write_marker(spark: SparkSession, root: str, state: str, batch_id: str) -> None:
    row = spark.range(1, numPartitions=1).select(F.current_timestamp().alias("committed_at"))
    row.write.mode("overwrite").parquet(batch_folder(root, state, batch_id))


def commit(spark: SparkSession, root: str, batch_id: str, write_files: Callable[[], None]) -> bool:
    """Write a batch's files, then name it in the manifest. False when it was there before."""
    if is_committed(spark, root, batch_id):
        return False
    write_files()
    _write_marker(spark, root, "manifest", batch_id)
    return True


def committed_ids(spark: SparkSession, root: str, state: str = "manifest") -> list[str]:
    """Ids of visible (or of ``retired``) batches, from folder names: one per run, whatever its size."""
    return layout.batch_names(paths.filled_folders(spark, f"{root}/{state}"))


def _chosen(spark: SparkSession, root: str, now: Layout, asked: list[str]) -> list[str]:
    unknown = set(asked) - set(now.ids) - set(committed_ids(spark, root, "retired"))
    if unknown:
        raise RuntimeError(f"batches asked for before they were committed: {sorted(unknown)[:5]}")
    return sorted(set(now.ids) & set(asked))


def open_ids(spark: SparkSession, root: str, asked: list[str]) -> list[str]:
    """The asked-for ids that are visible; retired ones are left out, unknown ones are an error."""
    return _chosen(spark, root, Layout(tuple(committed_ids(spark, root))), asked)


def visible(
    spark: SparkSession, root: str, table: str, schema: T.StructType, only: list[str] | None = None,
    now: Layout | None = None, with_removed: bool = False,
) -> DataFrame:
    """Rows of one table in committed batches; ``batch_id`` is the batch a row came with.

    Only these batches' folders are listed and opened. Sorting them out by a join
    with the manifest could send all rows of a large batch to one task. Batches that
    lost rows are read apart, so that only their rows go through the join with the
    removed keys; ``with_removed`` gives these rows too.
    """
    full = schema if "batch_id" in schema.fieldNames() else T.StructType(
        [*schema.fields, T.StructField("batch_id", T.StringType())]
    )
    now = now or layout.read_layout(spark, root)
    ids = list(now.ids) if only is None else _chosen(spark, root, now, only)
    # A batch need not have every table.
    held = set(layout.batch_names(paths.child_folders(spark, f"{root}/{table}")))
    ids = [i for i in ids if now.folder(i) in held]
    key = None if with_removed else REMOVAL_KEYS.get(table)
    touched = {i: now.purges_of(i) for i in ids if key and now.purges_of(i)}
    parts = []
    whole = [i for i in ids if i not in touched]
    if whole or not touched:
        parts.append(_read(spark, root, table, full, now, whole))
    if touched:
        gone = removed_keys(spark, root, touched).select("batch_id", key).filter(F.col(key).isNotNull()).distinct()
        rows = _read(spark, root, table, full, now, list(touched))
        # Removed keys grow with the tables: sent to all for each of them, they would pass the driver every time.
        parts.append(rows.join(gone.hint("merge"), ["batch_id", key], "left_anti"))
    return reduce(lambda a, b: a.unionByName(b), [p.select(*full.fieldNames()) for p in parts])


def _read(spark: SparkSession, root: str, table: str, full: T.StructType, now: Layout, ids: list[str]) -> DataFrame:
    if not ids:
        return spark.createDataFrame([], full)
    folders = sorted({now.folder(i) for i in ids})
    merged = {f for f in folders if f in set(now.merged.values())}
    own = T.StructType([*full.fields, T.StructField("from_batch", T.StringType())]) if merged else full
    reader = spark.read.schema(own).option("basePath", f"{root}/{table}")
    rows = reader.parquet(*[batch_folder(root, table, f) for f in folders])
    if merged:
        rows = rows.withColumn("batch_id", F.coalesce("from_batch", "batch_id"))
        if any(now.in_folder(f) - set(ids) for f in merged):
            rows = rows.filter(F.col("batch_id").isin(ids))
    return rows.select(*full.fieldNames())


def removed_keys(spark: SparkSession, root: str, touched: dict[str, list[str]]) -> DataFrame:
    """What some purges removed from some batches: ``event_id``, ``order_id``, ``batch_id``."""
    folders = [f"{root}/{layout.REMOVED}/purge_id={p}/batch_id={b}" for b, purges in touched.items() for p in purges]
    return spark.read.schema(REMOVED_KEYS).option("basePath", f"{root}/{layout.REMOVED}").parquet(*folders).select(
        "event_id", "order_id", "batch_id"
    )


def write_tables(frames: dict[str, DataFrame], root: str, batch_id: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(batch_folder(root, name, batch_id))


def commit_tables(spark: SparkSession, frames: dict[str, DataFrame], root: str, batch_id: str) -> bool:
    """All tables of a batch or none of them."""
    return commit(spark, root, batch_id, lambda: write_tables(frames, root, batch_id))


def read_tables(spark: SparkSession, root: str, only: list[str] | None = None, with_removed: bool = False) -> Tables:
    """The committed tables, or those of some batches."""
    now = layout.read_layout(spark, root)
    return from_reader(lambda name: _read_table(spark, root, name, only, now, with_removed))


def _read_table(spark: SparkSession, root: str, name: str, only: list[str] | None, now: Layout, with_removed: bool) -> DataFrame:
    if not paths.exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], TABLES[name].schema)
    return visible(spark, root, name, TABLES[name].schema, only, now, with_removed)


def remove_rows(spark: SparkSession, root: str, keys: DataFrame) -> str:
    """Remove rows of the event tables by key; files are not touched. Returns the purge's id.

    ``keys`` (``event_id``, ``order_id``, ``batch_id``) names events and, for payments, their
    orders, whose tasks go too. All of it is removed at once or, if this fails, nothing.
    """
    purge_id = uuid.uuid4().hex
    rows = keys.select("event_id", "order_id", "batch_id").hint("rebalance", F.col("batch_id"))
    rows.sortWithinPartitions("batch_id").write.partitionBy("batch_id").parquet(f"{root}/{layout.REMOVED}/purge_id={purge_id}")
    _write_marker(spark, root, layout.PURGES, purge_id)
    return purge_id


def merge(spark: SparkSession, root: str, ids: list[str], now: Layout, write: Callable[[str], None]) -> str:
    """Write rows of some batches to a new folder and, when that is done, let readers use it.

    ``write`` gets the folder's name. An interrupted merge leaves a folder nobody reads.
    """
    folder = f"merged-{uuid.uuid4().hex}"
    write(folder)
    layout.write_generation(spark, root, now, ids, folder)
    return folder


def merge_tables(spark: SparkSession, root: str, least: int = 2) -> str | None:
    """Merge the store's batches into one without their removed rows; None if there is nothing to do.

    Worth a run when many small batches or many removed rows have gathered. Batches
    keep their ids, so what is not archived yet is archived as it would have been.
    """
    now = layout.read_layout(spark, root)
    ids = sorted(now.ids)
    if len({now.folder(i) for i in ids}) < least and not any(now.purges_of(i) for i in ids):
        return None

    def write(folder: str) -> None:
        for name, spec in TABLES.items():
            if paths.exists(spark, f"{root}/{name}"):
                rows = visible(spark, root, name, spec.schema, ids, now)
                rows.withColumnRenamed("batch_id", "from_batch").hint("rebalance").write.parquet(batch_folder(root, name, folder))

    return merge(spark, root, ids, now, write)


def retire(spark: SparkSession, root: str, batch_ids: list[str]) -> None:
    """Drop whole batches: remembered as retired, then out of the manifest, then deleted.

    Each step can be repeated, and files an interrupted run left are deleted by the
    next. A query that already planned its scan of a dropped batch will fail. Users of
    a dropped batch are committed again as a batch of their own before it goes. A merged
    folder is deleted when the last of its batches goes.
    """
    now = layout.read_layout(spark, root)
    with_users = set(layout.batch_names(paths.child_folders(spark, f"{root}/users")))
    for batch_id in batch_ids:
        if now.folder(batch_id) in with_users and batch_id in now.ids:
            users = visible(spark, root, "users", TABLES["users"].schema, [batch_id], now).select(*TABLES["users"].columns)
            if batch_id not in now.merged or not users.isEmpty():
                commit_tables(spark, {"users": users}, root, f"{batch_id}-users")
        _write_marker(spark, root, "retired", batch_id)
        paths.delete_folder(spark, batch_folder(root, "manifest", batch_id))
    retired = set(committed_ids(spark, root, "retired"))
    gone = {b for b in retired if b not in now.merged} | {f for f in set(now.merged.values()) if now.in_folder(f) <= retired}
    for name in EVENT_TABLES:
        for folder in {f"batch_id={g}" for g in gone}.intersection(paths.child_folders(spark, f"{root}/{name}")):
            paths.delete_folder(spark, f"{root}/{name}/{folder}")
