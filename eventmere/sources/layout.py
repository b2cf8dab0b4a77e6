"""Which batches a root holds just now, and in which folders their rows are.

A batch is visible once its manifest row is there. Batches can be merged: their rows
then stand in one folder, and the newest *generation* says so. A generation is one
small table of its own, so readers see either all of a merge or nothing of it, and a
reader that has planned its scan keeps the old folders. Two merges at once make two
generations of one number; all readers take the same one, the first by name, and the
other is never looked at. Rows of a merged folder keep the id of the batch they came
with.

Removed rows are named in blocks of keys, per batch and purge; a purge counts once
its marker is there. A merge leaves out the rows removed so far and says which purges
these were, so that readers need not apply them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from eventmere.sources import paths

GENERATIONS = "generations"
PURGES = "purges"
REMOVED = "removed"

#: A row says where a batch's rows are now, or names a folder no reader needs any more.
GENERATION = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("purges", T.ArrayType(T.StringType())),
        T.StructField("old_folder", T.StringType()),
        T.StructField("since", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """Visible batches, folders of merged ones, purges already left out of these, and removals per batch."""

    ids: tuple[str, ...]
    merged: dict[str, str] = field(default_factory=dict)
    left_out: dict[str, frozenset[str]] = field(default_factory=dict)
    removed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    old: dict[str, datetime] = field(default_factory=dict)
    number: int = 0

    def folder(self, batch_id: str) -> str:
        return self.merged.get(batch_id, batch_id)

    def in_folder(self, folder: str) -> set[str]:
        """Batches that were ever put in a merged folder."""
        return {b for b, f in self.merged.items() if f == folder}

    def purges_of(self, batch_id: str) -> list[str]:
        """Purges that readers of a batch must still apply."""
        return [p for p in self.removed.get(batch_id, ()) if p not in self.left_out.get(batch_id, ())]


def batch_names(folders: Iterable[str]) -> list[str]:
    return [name.removeprefix("batch_id=") for name in folders if name.startswith("batch_id=")]


def newest_generation(spark: SparkSession, root: str) -> str | None:
    """Folder name of the generation that counts: the highest number, then the first name."""
    found = paths.filled_folders(spark, f"{root}/{GENERATIONS}")
    highest = max((name.split("-")[0] for name in found), default=None)
    return min((name for name in found if name.split("-")[0] == highest), default=None)


def read_layout(spark: SparkSession, root: str, ids: Iterable[str] | None = None, removals: bool = True) -> Layout:
    """The layout of a root. With ``ids`` these are taken as visible, and the manifest is not listed."""
    if ids is None:
        ids = batch_names(paths.filled_folders(spark, f"{root}/manifest"))
    purged = _removals(spark, root) if removals else {}
    name = newest_generation(spark, root)
    if name is None:
        return Layout(tuple(ids), removed=purged)
    rows = spark.read.schema(GENERATION).parquet(f"{root}/{GENERATIONS}/{name}").collect()
    placed = [r for r in rows if r["batch_id"] is not None]
    return Layout(
        tuple(ids),
        {r["batch_id"]: r["folder"] for r in placed},
        {r["batch_id"]: frozenset(r["purges"] or ()) for r in placed},
        purged,
        {r["old_folder"]: r["since"] for r in rows if r["old_folder"] is not None},
        int(name.split("-")[0].removeprefix("generation=")),
    )


def _removals(spark: SparkSession, root: str) -> dict[str, tuple[str, ...]]:
    """Purges of each batch that lost rows, from folder names."""
    found: dict[str, list[str]] = {}
    for purge in batch_names(paths.filled_folders(spark, f"{root}/{PURGES}")):
        for batch in batch_names(paths.child_folders(spark, f"{root}/{REMOVED}/purge_id={purge}")):
            found.setdefault(batch, []).append(purge)
    return {b: tuple(p) for b, p in found.items()}


def write_generation(spark: SparkSession, root: str, before: Layout, ids: Iterable[str], folder: str) -> str:
    """Say that some batches are in a merged folder from now on. The one file written is the commit.

    ``before`` is the whole layout the merge was made from. Dropped batches stay named
    as long as their rows are in a folder that others need.
    """
    now = datetime.now(UTC).replace(tzinfo=None)
    chosen = set(ids)
    needed = {before.folder(b) for b in before.ids if b not in chosen}
    rows = [(b, f, sorted(before.left_out.get(b, ())), None, None) for b, f in sorted(before.merged.items()) if f in needed and b not in chosen]
    rows += [(b, folder, sorted({*before.left_out.get(b, ()), *before.removed.get(b, ())}), None, None) for b in sorted(chosen)]
    old = before.old | {before.folder(b): now for b in chosen}
    rows += [(None, None, None, name, since) for name, since in sorted(old.items())]
    name = f"generation={before.number + 1:010d}-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, GENERATION).coalesce(1).write.parquet(f"{root}/{GENERATIONS}/{name}")
    return name


def drop_old_folders(spark: SparkSession, root: str, tables: Iterable[str], grace: timedelta) -> list[str]:
    """Delete the folders that merges replaced at least ``grace`` ago; can be repeated.

    ``grace`` must be longer than a query or another merge takes: queries planned
    before a merge read the old folders.
    """
    before = read_layout(spark, root, ids=(), removals=False)
    limit = datetime.now(UTC).replace(tzinfo=None) - grace
    used = set(before.merged.values())
    names = sorted(f for f, since in before.old.items() if since <= limit and f not in used)
    tables = list(tables)
    for table in tables:
        for folder in {f"batch_id={n}" for n in names}.intersection(paths.child_folders(spark, f"{root}/{table}")):
            paths.delete_folder(spark, f"{root}/{table}/{folder}")
    return names
