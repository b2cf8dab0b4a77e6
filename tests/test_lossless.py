"""No event is lost between capture, archive and purge."""

import pytest
from fixtures import Log, at, raw, values
from pyspark.sql import functions as F

from eventmere.operators import archive as records
from eventmere.operators import ingest
from eventmere.plans import facts, panels, reports
from eventmere.schemas import RAW_EVENT
from eventmere.sources import batches, lake, paths, tables
from eventmere.streaming import archive as archiving
from eventmere.streaming import capture as capturing

MARKERS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def store_with(spark, *names, prefix="e"):
    root = paths.fresh_folder(spark, "store")
    for name in names:
        events = raw(spark, *[{"event_id": f"{prefix}{name}{i}", "event_type": "cart_add", "lecture_id": 1} for i in range(5)])
        batches.commit_tables(spark, ingest.route(events), root, name)
    return root


def archive_and_purge(spark, root):
    target = paths.fresh_folder(spark, "lake")
    worked = archiving.archive_once(spark, root, target, paths.fresh_folder(spark, "cp"))
    return worked, target, archiving.purge_archived(spark, root, target)


def test_the_manifest_file_is_the_commit(spark):
    root = store_with(spark, "one")
    paths.delete_folder(spark, f"{root}/manifest/batch_id=one/_SUCCESS")
    assert batches.is_committed(spark, root, "one")
    worked, target, gone = archive_and_purge(spark, root)
    assert worked and gone == ["one"] and lake.read(spark, target).count() == 5


def test_without_success_markers(spark):
    conf = spark._jsc.hadoopConfiguration()
    conf.set(MARKERS, "false")
    try:
        root = store_with(spark, "one")
        assert batches.read_tables(spark, root).master_event_logs.count() == 5
        worked, target, gone = archive_and_purge(spark, root)
        assert worked and gone == ["one"] and lake.read(spark, target).count() == 5
    finally:
        conf.unset(MARKERS)


def test_an_uncommitted_batch_is_refused(spark):
    root = store_with(spark, "one")
    with pytest.raises(RuntimeError, match="before they were committed"):
        batches.read_tables(spark, root, ["one", "two"])


def test_users_only_batches_read_and_stay(spark):
    root = store_with(spark, "one")
    users = Log().event("x", 1, 1, "signup").tables(spark).users
    assert capturing.seed_users(spark, root, users, "people") and not capturing.seed_users(spark, root, users, "people")
    assert capturing.seed_users(spark, root, users, "again")
    assert batches.read_tables(spark, root).users.count() == users.count()
    archive_and_purge(spark, root)
    stored = batches.read_tables(spark, root)
    assert stored.users.count() == users.count() and stored.master_event_logs.count() == 0


def test_purge_refuses_when_counts_differ(spark):
    root = store_with(spark, "one", "two")
    target = paths.fresh_folder(spark, "lake")
    archiving.archive_once(spark, root, target, paths.fresh_folder(spark, "cp"))
    more = raw(spark, {"event_id": "late", "event_type": "cart_add", "lecture_id": 1}).select("event_id", "user_id", "creator_id", "event_type", "created_at")
    more.write.mode("append").parquet(batches.batch_folder(root, "master_event_logs", "two"))
    with pytest.raises(RuntimeError, match="differ"):
        archiving.purge_archived(spark, root, target)
    assert batches.read_tables(spark, root).master_event_logs.count() == 11


def test_idle_runs_are_recorded(spark):
    root, target, checkpoint = (paths.fresh_folder(spark, n) for n in ("store", "lake", "cp"))
    assert not archiving.archive_once(spark, root, target, checkpoint)
    assert values(lake.read_metrics(spark, target).filter("line = 'total'"), "row_count", "status") == [(0, "IDLE")]


def test_rejected_and_accepted_make_up_all(spark):
    rows = raw(
        spark,
        {"event_id": "a", "event_type": "cart_add", "lecture_id": 1},
        {"event_id": "a", "event_type": "cart_add", "lecture_id": 1},
        {"event_id": "a", "event_type": "cart_add", "lecture_id": 2},
        {"event_id": "b", "event_type": "cart_add"},
        {"event_id": "c", "event_type": "payment", "order_id": "o", "amount": 1, "status": "SUCCESS"},
        {"event_id": "d", "event_type": "payment", "order_id": "o", "amount": 1, "status": "SUCCESS"},
    ).select(*RAW_EVENT.fieldNames())
    inbox, root = paths.fresh_folder(spark, "inbox"), paths.fresh_folder(spark, "store")
    rows.write.parquet(inbox)
    stream = capturing.watch_parquet(spark, inbox, RAW_EVENT)
    capturing.capture(stream, root, paths.fresh_folder(spark, "cp")).awaitTermination()
    out = capturing.read_rejected(spark, root)
    assert values(out, "event_id", "reject_reason") == [
        ("a", "repeated event_id"), ("a", "repeated event_id"), ("b", "missing lecture_id"), ("d", "repeated order_id"),
    ]
    assert out.count() + batches.read_tables(spark, root).master_event_logs.count() == rows.count()


def test_live_tables_and_lake_agree_on_orphans(spark):
    log = Log().cart("c1", 1).view("v1", 1, "google").event("c2", 2, 1, "cart_add").event("v2", 2, 1, "page_view")
    live = log.tables(spark)
    archived = records.wide(live)
    for report in (reports.cart_dropout_by_lecture, reports.channel_buffering_quality):
        assert values(report(facts.from_tables(live))) == values(report(facts.from_records(archived)))
    rebuilt = tables.from_records(archived, live.users)
    assert rebuilt.cart_add_details.count() == live.cart_add_details.count() == 1


def test_panels_leave_out_records_without_a_creator(spark):
    archived = records.wide(Log().cart("c1", 1).tables(spark))
    spoiled = archived.unionByName(archived.withColumn("creator_id", F.lit(None).cast("bigint")))
    assert values(panels.cart_dropout_by_creator(spoiled)) == values(panels.cart_dropout_by_creator(archived))


def test_metrics_open_one_batch(spark):
    root, target = store_with(spark, "one"), paths.fresh_folder(spark, "lake")
    for name in ("a", "b"):
        lake.write_batch(spark, records.wide(batches.read_tables(spark, root)), target, name)
    opened = batches.visible(spark, target, lake.DATA, lake.LAKE, ["b"]).inputFiles()
    assert opened and all("batch_id=b" in f for f in opened)


def test_a_day_range_lists_only_its_days(spark):
    root, target = paths.fresh_folder(spark, "store"), paths.fresh_folder(spark, "lake")
    rows = [{"event_id": f"e{i}", "event_type": "cart_add", "lecture_id": 1, "created_at": at(f"2024-03-0{1 + i % 5}")} for i in range(20)]
    for n in range(2):
        batches.commit_tables(spark, ingest.route(raw(spark, *rows[n::2])), root, f"b{n}")
        lake.write_batch(spark, records.wide(batches.read_tables(spark, root, [f"b{n}"])), target, f"a{n}")
    found = lake.read_range(spark, target, "2024-03-02", "2024-03-02")
    assert found.count() == 4 and all("dt=2024-03-02" in f for f in found.inputFiles())
    assert lake.read_range(spark, target, "1999-01-01", "1999-01-02").count() == 0
