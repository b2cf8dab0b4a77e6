import os

import pytest
from fixtures import Log, raw, values
from pyspark.sql import functions as F

from eventmere.operators import ingest
from eventmere.schemas import RAW_EVENT, TABLES
from eventmere.sources import batches, driver_tables, lake, paths
from eventmere.streaming import archive as archiving
from eventmere.streaming import capture as capturing

EVENTS = "/root/testdata/sf0.001/events.parquet"


def folders(spark):
    names = ("inbox", "store", "lake", "capture-cp", "archive-cp")
    return [paths.fresh_folder(spark, n) for n in names]


def capture(spark, inbox, store, checkpoint, **kw):
    stream = capturing.watch_parquet(spark, inbox, RAW_EVENT, kw.pop("bytes_per_batch", None))
    capturing.capture(stream, store, checkpoint, **kw).awaitTermination()


def archive(spark, store, target, checkpoint, **kw):
    archiving.archive_stream(spark, store, target, checkpoint, **kw).awaitTermination()


def given(spark):
    return driver_tables.raw_events(spark.read.parquet(EVENTS))


def test_stream_equals_batch(spark):
    inbox, store, *_, checkpoint, _ = folders(spark)
    given(spark).repartition(5).write.parquet(inbox)
    capture(spark, inbox, store, checkpoint, bytes_per_batch=1)
    assert len(batches.committed_ids(spark, store)) == 5
    stored = batches.read_tables(spark, store)
    for name, df in ingest.route(given(spark)).items():
        assert values(stored[name]) == values(df), name


def test_runs_are_incremental_and_repeatable(spark):
    inbox, store, target, capture_cp, archive_cp = folders(spark)
    events = given(spark)
    events.filter("CAST(event_id AS INT) < 600").write.parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    first = lake.read(spark, target).count()
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    assert first == lake.read(spark, target).count() == 600
    events.filter("CAST(event_id AS INT) >= 600").write.mode("append").parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    archived = lake.read(spark, target)
    assert archived.count() == archived.select("event_id").distinct().count() == 1000
    assert archived.select("batch_id").distinct().count() == 2
    metrics = spark.read.parquet(f"{target}/metrics").filter("line = 'total'")
    assert sorted(r.row_count for r in metrics.collect()) == [400, 600]


def test_late_event_joins_its_own_day(spark):
    inbox, store, target, capture_cp, archive_cp = folders(spark)
    from fixtures import at

    raw(spark, {"event_type": "cart_add", "lecture_id": 1, "created_at": at("2024-03-05")}).write.parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    late = raw(spark, {"event_id": "late", "event_type": "cart_add", "lecture_id": 1, "created_at": at("2024-03-01")})
    late.write.mode("append").parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    rows = values(lake.read(spark, target).select("event_id", F.col("dt").cast("string")))
    assert rows == [("e0", "2024-03-05"), ("late", "2024-03-01")]


def test_a_repeated_event_is_stored_once_over_batches(spark):
    inbox, store, _, checkpoint, _ = folders(spark)
    events = given(spark)
    events.write.parquet(inbox)
    capture(spark, inbox, store, checkpoint)
    events.limit(50).write.mode("append").parquet(inbox)
    capture(spark, inbox, store, checkpoint)
    stored = batches.read_tables(spark, store)
    assert stored.master_event_logs.count() == 1000
    assert len(batches.committed_ids(spark, store)) == 2


def test_lost_checkpoint_repeats_batches_but_takes_no_old_name(spark):
    inbox, store, target, capture_cp, archive_cp = folders(spark)
    given(spark).write.parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    archive(spark, store, target, archive_cp)
    archive(spark, store, target, paths.fresh_folder(spark, "other-cp"))
    assert lake.read(spark, target).count() == 2000
    assert lake.read(spark, target, once=True).count() == 1000


def test_purge_after_archive(spark):
    inbox, store, target, capture_cp, archive_cp = folders(spark)
    events = given(spark)
    events.filter("CAST(event_id AS INT) < 600").write.parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    assert archiving.purge_archived(spark, store, target) == []
    archive(spark, store, target, archive_cp)
    # Committed after the archive run, before the purge.
    events.filter("CAST(event_id AS INT) >= 600").write.mode("append").parquet(inbox)
    capture(spark, inbox, store, capture_cp)
    gone = archiving.purge_archived(spark, store, target)
    assert len(gone) == 1 and archiving.purge_archived(spark, store, target) == []
    stored = batches.read_tables(spark, store)
    assert stored.master_event_logs.count() == 400
    assert not os.path.exists(batches.batch_folder(store, "master_event_logs", gone[0]))
    archive(spark, store, target, archive_cp)
    assert lake.read(spark, target).select("event_id").distinct().count() == lake.read(spark, target).count() == 1000
    # Files an interrupted purge left are deleted by the next one.
    batches.write_tables(ingest.route(events), store, gone[0])
    archiving.purge_archived(spark, store, target)
    assert not os.path.exists(batches.batch_folder(store, "payment_details", gone[0]))
    # A replay of the purged batch must not bring it back.
    assert not batches.commit_tables(spark, ingest.route(events), store, gone[0])


def test_users_are_checked(spark):
    inbox, store, _, checkpoint, _ = folders(spark)
    raw(
        spark,
        {"event_type": "cart_add", "lecture_id": 1},
        {"event_type": "cart_add", "lecture_id": 1, "user_id": 5},
    ).write.parquet(inbox)
    capture(spark, inbox, store, checkpoint, users=Log().event("x", 1, 1, "signup").tables(spark).users)
    assert values(batches.read_tables(spark, store).master_event_logs, "event_id") == [("e0",)]


def test_tables_commit_together(spark):
    store = paths.fresh_folder(spark, "store")
    frames = ingest.route(given(spark))
    batches.commit_tables(spark, frames, store, "one")
    full = batches.read_tables(spark, store).master_event_logs.count()
    half = dict(list(frames.items())[:2])
    bad = {**half, "payment_tasks": frames["payment_tasks"].withColumn("order_id", F.raise_error(F.lit("no")))}
    with pytest.raises(Exception, match="no"):
        batches.commit_tables(spark, bad, store, "two")
    assert os.path.exists(batches.batch_folder(store, "master_event_logs", "two"))
    assert batches.read_tables(spark, store).master_event_logs.count() == full
    assert batches.commit_tables(spark, frames, store, "two")
    assert batches.read_tables(spark, store).master_event_logs.count() == 2 * full
    assert set(TABLES) - {"users"} == set(frames)


def test_messages_without_an_event_are_kept_whole(spark):
    good = '{"event_id": "e1", "user_id": 1, "creator_id": 2, "event_type": "signup", "created_at": "2024-03-01T10:00:00Z"}'
    no_id = good.replace('"event_id": "e1", ', "")
    bad = ["", "{", "null", "5", f"[{good}]", good.replace("1, \"creator", '"x", "creator'), good[:-9], "not json \u00e9"]
    rows = [("t", 0, n, v.encode()) for n, v in enumerate([good, no_id, *bad])] + [("t", 1, 0, None), ("t", 1, 1, b"\xff{"), ("t", 2, 1, no_id.encode())]
    schema = "topic string, partition int, offset long, value binary"
    inbox, root = paths.fresh_folder(spark, "inbox"), paths.fresh_folder(spark, "store")
    messages = spark.createDataFrame(rows, schema)
    messages.write.parquet(inbox)
    stream = capturing.events_of(capturing.watch_parquet(spark, inbox, messages.schema))
    capturing.capture(stream, root, paths.fresh_folder(spark, "cp")).awaitTermination()
    ids = [r[0] for r in values(batches.read_tables(spark, root).master_event_logs, "event_id")]
    again = [r[0] for r in values(capturing.events_of(messages).filter("event_id is not null"), "event_id")]
    assert len(ids) == 3 and "e1" in ids and ids == again
    kept = {(r["topic"], r["partition"], r["offset"]): r["content"] for r in capturing.read_unreadable(spark, root).collect()}
    assert {k: None if v is None else bytes(v) for k, v in kept.items()} == {
        (t, p, o): v for t, p, o, v in rows if (p, o) not in ((0, 0), (0, 1), (2, 1))
    }
    assert capturing.read_rejected(spark, root).count() == 0


def test_events_are_grouped_by_id_once_per_batch(spark, monkeypatch):
    inbox, store, *_, checkpoint, _ = folders(spark)
    grouped, plain = [], ingest.earliest_row

    def counted(df, *keys, **kw):
        grouped.append(keys)
        return plain(df, *keys, **kw)

    monkeypatch.setattr(ingest, "earliest_row", counted)
    given(spark).write.parquet(inbox)
    capture(spark, inbox, store, checkpoint)
    assert grouped.count(("event_id",)) == 1 and capturing.read_rejected(spark, store).count() == 0
    # Now all are stored already, and one of them comes twice.
    given(spark).unionByName(given(spark).filter("event_id = '7'")).write.mode("append").parquet(inbox)
    capture(spark, inbox, store, checkpoint)
    assert grouped.count(("event_id",)) == 2
    again = capturing.read_rejected(spark, store)
    assert again.count() == 1001 and again.filter("event_id = '7'").count() == 2
    assert [r[0] for r in again.select("reject_reason").distinct().collect()] == ["repeated event_id"]
