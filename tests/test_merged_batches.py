"""Merged batches, the batch directory of the lake, and rows removed by key."""

import os
import subprocess
import sys
from datetime import datetime, timedelta

import pytest
from fixtures import at, raw, values
from pyspark.sql import functions as F

from eventmere.operators import archive as records
from eventmere.operators import ingest
from eventmere.schemas import LAKE
from eventmere.sources import batches, lake, layout, paths
from eventmere.streaming import archive as archiving

NONE = timedelta(0)


def events(spark, name, days, n=6, kind="cart_add"):
    rows = [
        {"event_id": f"{name}-{i}", "event_type": kind, "lecture_id": 1, "created_at": at(f"2024-03-{days[i % len(days)]:02d}"),
         **({"order_id": f"o-{name}-{i}", "amount": 1, "status": "SUCCESS"} if kind == "payment" else {})}
        for i in range(n)
    ]
    return raw(spark, *rows)


def small_lake(spark, count, days=lambda n: [1 + n % 5]):
    target = paths.fresh_folder(spark, "lake")
    for n in range(count):
        routed = ingest.route(events(spark, f"b{n}", days(n)))
        root = paths.fresh_folder(spark, "store")
        batches.commit_tables(spark, routed, root, "x")
        lake.write_batch(spark, records.wide(batches.read_tables(spark, root)), target, f"b{n}")
    return target


def content(df):
    return values(df, "event_id", "kind", "dt", "batch_id")


def files(df):
    return df.inputFiles()


def test_many_small_batches_become_few_files(spark):
    target = small_lake(spark, 20)
    before, old_reader = content(lake.read(spark, target)), lake.read(spark, target)
    assert len(files(old_reader)) >= 20
    folder = lake.compact(spark, target)
    now = lake.read(spark, target)
    assert content(now) == before and all(folder in f for f in files(now))
    assert len(files(now)) <= 5  # one per kind and day
    assert content(old_reader) == before  # it planned its scan before
    assert lake.compact(spark, target) is None  # nothing left to merge
    assert set(batches.committed_ids(spark, target)) == {f"b{n}" for n in range(20)}
    assert not lake.write_batch(spark, lake.read(spark, target), target, "b3")  # still committed


def test_later_batches_join_and_old_folders_go(spark):
    target = small_lake(spark, 3)
    lake.compact(spark, target)
    extra = lake.read(spark, target).withColumn("event_id", F.concat(F.lit("n"), "event_id"))
    lake.write_batch(spark, extra, target, "late")
    before = content(lake.read(spark, target))
    first = set(paths.child_folders(spark, f"{target}/data"))
    second = lake.compact(spark, target)
    assert content(lake.read(spark, target)) == before
    assert lake.drop_old(spark, target, timedelta(days=1)) == []
    assert set(lake.drop_old(spark, target, NONE)) == {f.removeprefix("batch_id=") for f in first}
    assert paths.child_folders(spark, f"{target}/data") == [f"batch_id={second}"]
    assert content(lake.read(spark, target)) == before
    assert lake.read_range(spark, target, "2024-03-01", "2024-03-05").count() == len(before)


def test_an_interrupted_merge_is_not_seen(spark, monkeypatch):
    target = small_lake(spark, 3)
    before = content(lake.read(spark, target))
    with monkeypatch.context() as patched:
        patched.setattr(layout, "write_generation", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.compact(spark, target)
    assert len(paths.child_folders(spark, f"{target}/data")) == 4  # the rows were written
    assert content(lake.read(spark, target)) == before
    assert lake.read_range(spark, target, "2024-03-01", "2024-03-09").count() == len(before)
    lake.compact(spark, target)
    assert content(lake.read(spark, target)) == before


def test_of_two_merges_at_once_one_counts(spark):
    target = small_lake(spark, 3)
    before, now = content(lake.read(spark, target)), layout.read_layout(spark, target)
    for _ in range(2):
        batches.merge(spark, target, sorted(now.ids), now, lambda folder: lake._write_counts(
            spark, lake._write_data(spark, lake.read(spark, target).withColumnRenamed("batch_id", "from_batch"), target, folder), target, folder))
    assert len(paths.child_folders(spark, f"{target}/generations")) == 2
    assert content(lake.read(spark, target)) == before


def test_repeated_events_keep_their_batches(spark):
    target = small_lake(spark, 1)
    lake.write_batch(spark, lake.read(spark, target), target, "again")
    once = content(lake.read(spark, target, once=True))
    lake.compact(spark, target)
    assert lake.read(spark, target).count() == 12
    assert content(lake.read(spark, target, once=True)) == once and len(once) == 6


def test_a_range_asks_for_no_other_batch(spark, monkeypatch):
    target = small_lake(spark, 8, days=lambda n: [n + 1])
    asked = []
    real = paths._file_system
    monkeypatch.setattr(paths, "_file_system", lambda s, p: asked.append(p) or real(s, p))
    found = lake.read_range(spark, target, "2024-03-03", "2024-03-03")
    assert found.count() == 6
    assert not [p for p in asked if any(f"batch_id=b{n}" in p for n in (0, 1, 3, 4, 5, 6, 7))]
    assert not [p for p in asked if p.endswith(("/manifest", "/data", "/manifest/*/part-*"))]
    assert len(asked) <= 6
    assert all("batch_id=b2" in f for f in files(found))


def test_a_range_leaves_out_uncommitted_batches(spark):
    target = small_lake(spark, 2, days=lambda n: [1])
    paths.delete_folder(spark, f"{target}/manifest/batch_id=b1")
    assert lake.read_range(spark, target, "2024-03-01", "2024-03-01").count() == 6


def test_counts_come_from_the_write(spark):
    target = small_lake(spark, 1, days=lambda n: [1, 2])
    odd = lake.read(spark, target).select(*[F.col(c) for c in LAKE.fieldNames() if c not in ("kind", "dt", "batch_id")])
    odd = odd.withColumns({"event_type": F.when(F.col("event_id") == "b0-0", F.lit(None)).otherwise(F.lit('A "b"\t/')),
                           "created_at": F.when(F.col("event_id") != "b0-1", F.col("created_at"))})
    lake.write_batch(spark, odd, target, "odd")
    counted = lake.batch_counts(spark, target, ["odd"])
    written = lake.read(spark, target).filter("batch_id = 'odd'").groupBy("kind", "dt").agg(F.count("*").alias("row_count"))
    assert values(counted, "kind", "dt", "row_count") == values(written, "kind", "dt", "row_count")
    assert counted.select("first_at", "last_at").distinct().count() == 1


def test_more_folders_than_are_counted_while_writing(spark, monkeypatch):
    monkeypatch.setattr(lake, "MOST_FOLDERS", 3)
    target = small_lake(spark, 1, days=lambda n: [1, 2, 3, 4, 5])
    assert sorted(r["row_count"] for r in lake.batch_counts(spark, target, ["b0"]).collect()) == [1, 1, 1, 1, 2]


RETRY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from eventmere.schemas import WIDE
from eventmere.sources import lake
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
def failing(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise OSError("executor lost")
rows = spark.range(1000).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in WIDE.fields if f.name not in ("event_id", "event_type", "created_at")],
    F.col("id").cast("string").alias("event_id"), F.concat(F.lit("k"), F.col("id") % 3).alias("event_type"), F.timestamp_seconds("id").alias("created_at")).select(*WIDE.fieldNames())
# The failure comes after the last shuffle, in the tasks that write and have counted already.
observe = type(rows).observe
type(rows).observe = lambda self, *a: observe(self, *a).mapInArrow(failing, self.schema)
lake.write_batch(spark, rows, sys.argv[2] + "/lake", "one")
print(sorted((r["kind"], r["row_count"]) for r in lake.batch_counts(spark, sys.argv[2] + "/lake", ["one"]).collect()), lake.read(spark, sys.argv[2] + "/lake").count())
"""


def test_counts_survive_a_task_retry(tmp_path):
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", RETRY, top, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert "[('k0', 334), ('k1', 333), ('k2', 333)] 1000" in out.stdout, out.stdout + out.stderr[-3000:]


# -- removed rows -------------------------------------------------------------

CUTOFF = datetime(2024, 3, 2, 23, 0)


def store_and_lake(spark):
    root, target = paths.fresh_folder(spark, "store"), paths.fresh_folder(spark, "lake")
    for name in ("one", "two"):
        batches.commit_tables(spark, ingest.route(events(spark, name, [1, 5], 6, "payment")), root, name)
    archiving.archive_once(spark, root, target, paths.fresh_folder(spark, "cp"))
    batches.commit_tables(spark, ingest.route(events(spark, "late", [1], 4, "payment")), root, "late")
    return root, target


def left(spark, root):
    stored = batches.read_tables(spark, root)
    return (
        values(stored.master_event_logs, "event_id"), values(stored.payment_details, "event_id"), values(stored.payment_tasks, "order_id")
    )


def expected():
    ids = sorted([f"{name}-{i}" for name in ("one", "two") for i in (1, 3, 5)] + [f"late-{i}" for i in range(4)])
    return [(i,) for i in ids], [(i,) for i in ids], [(f"o-{i}",) for i in ids]


def test_half_of_a_batch_goes_and_late_rows_stay(spark):
    root, target = store_and_lake(spark)
    assert archiving.purge_until(spark, root, target, CUTOFF)
    assert left(spark, root) == expected()
    assert archiving.purge_until(spark, root, target, CUTOFF) is None  # nothing more to remove
    assert batches.read_tables(spark, root, with_removed=True).master_event_logs.count() == 16
    # The late batch is read without a join.
    plan = batches.read_tables(spark, root, ["late"]).master_event_logs._jdf.queryExecution().toString()
    assert "LeftAnti" not in plan


def test_a_failed_purge_changes_nothing_and_is_run_again(spark, monkeypatch):
    root, target = store_and_lake(spark)
    with monkeypatch.context() as patched:
        patched.setattr(batches, "_write_marker", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            archiving.purge_until(spark, root, target, CUTOFF)
    assert len(left(spark, root)[0]) == 16
    archiving.purge_until(spark, root, target, CUTOFF)
    assert left(spark, root) == expected()


def test_merging_leaves_removed_rows_out(spark):
    root, target = store_and_lake(spark)
    archiving.purge_until(spark, root, target, CUTOFF)
    folder = batches.merge_tables(spark, root)
    assert left(spark, root) == expected()
    plan = batches.read_tables(spark, root).master_event_logs._jdf.queryExecution().toString()
    assert "LeftAnti" not in plan and all(folder in f for f in files(batches.read_tables(spark, root).payment_tasks))
    later = datetime(2024, 3, 6)
    archiving.purge_until(spark, root, target, later)
    ids = [(f"late-{i}",) for i in range(4)]
    assert left(spark, root)[:2] == (ids, ids)


def test_batches_merged_before_they_are_archived(spark):
    root, target = store_and_lake(spark)
    checkpoint = paths.fresh_folder(spark, "cp")
    batches.merge_tables(spark, root)
    batches.commit_tables(spark, ingest.route(events(spark, "new", [2], 3)), root, "new")
    second = paths.fresh_folder(spark, "lake")
    archiving.archive_once(spark, root, second, checkpoint)
    assert lake.read(spark, second).count() == 19
    assert sorted(archiving.purge_archived(spark, root, second)) == ["late", "new", "one", "two"]
    assert left(spark, root) == ([], [], [])
    layout.drop_old_folders(spark, root, batches.TABLES, NONE)
    assert paths.child_folders(spark, f"{root}/master_event_logs") == []


def test_whole_batches_retire_after_some_of_their_rows(spark):
    root, target = store_and_lake(spark)
    archiving.purge_until(spark, root, target, CUTOFF)
    batches.merge_tables(spark, root)
    assert archiving.purge_archived(spark, root, target) == ["one", "two"]
    assert left(spark, root)[0] == [(f"late-{i}",) for i in range(4)]
    batches.commit_tables(spark, ingest.route(events(spark, "new", [2], 3)), root, "new")
    batches.merge_tables(spark, root)
    assert len(left(spark, root)[0]) == 7
    layout.drop_old_folders(spark, root, batches.TABLES, NONE)
    assert len(left(spark, root)[0]) == 7 and len(paths.child_folders(spark, f"{root}/master_event_logs")) == 1
