import os

import pytest
from fixtures import Log, at, records, values

from eventmere.operators import archive
from eventmere.plans import panels
from eventmere.schemas import TABLES, WIDE, record_columns
from eventmere.sources import batches, driver_tables, lake, paths, tables

NAMES = WIDE.fieldNames()


def some(spark):
    return records(
        spark,
        {"event_type": "cart_add", "lecture_id": 1, "created_at": at("2024-03-01 23:59:59.999999")},
        {"event_type": "cart_add", "lecture_id": 2, "created_at": at("2024-03-02 00:00:00")},
        {"event_type": "Page_View", "lecture_id": 2, "referrer": 'say "hi", or\nbye', "created_at": at("2024-03-03")},
        {"event_type": "signup", "lecture_id": 7, "created_at": at("2024-03-02 12:00:00")},
        {"event_type": "payment", "order_id": "o", "lecture_id": 7, "created_at": at("2024-03-04")},
        {"event_type": None, "created_at": at("2024-03-04")},
    )


def test_round_trip_keeps_rows_and_clears_foreign_columns(spark):
    root = paths.fresh_folder(spark, "lake")
    assert lake.write_batch(spark, some(spark), root, "b1")
    got = {r.event_id: r for r in lake.read(spark, root).collect()}
    assert len(got) == 6
    assert got["e2"].event_type == "Page_View" and got["e2"].kind == "page_view"
    assert got["e2"].referrer == 'say "hi", or\nbye'
    assert got["e3"].lecture_id is None and got["e4"].lecture_id is None and got["e4"].order_id == "o"
    assert got["e5"].kind == "none" and got["e5"].event_type is None
    assert str(got["e0"].dt) == "2024-03-01" and got["e0"].created_at == at("2024-03-01 23:59:59.999999").replace(tzinfo=None)


def test_whole_given_log_round_trip(spark):
    source = archive.wide(driver_tables.tables(spark, "/root/testdata/sf0.001"))
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, source, root, "b1")
    assert values(lake.read(spark, root), *NAMES) == values(source, *NAMES)


def test_folders_are_kind_and_day(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark), root, "b1")
    kinds = [d for d in os.listdir(f"{root}/data/batch_id=b1") if d.startswith("kind=")]
    assert sorted(kinds) == ["kind=cart_add", "kind=none", "kind=page_view", "kind=payment", "kind=signup"]
    days = [d for d in os.listdir(f"{root}/data/batch_id=b1/kind=cart_add") if d.startswith("dt=")]
    assert sorted(days) == ["dt=2024-03-01", "dt=2024-03-02"]


def test_a_batch_is_archived_once(spark):
    root = paths.fresh_folder(spark, "lake")
    assert lake.write_batch(spark, some(spark), root, "b1")
    assert not lake.write_batch(spark, some(spark), root, "b1")
    assert lake.read(spark, root).count() == 6
    assert lake.write_batch(spark, some(spark), root, "b2")
    assert lake.read(spark, root).count() == 12
    assert lake.read(spark, root, once=True).count() == 6


def test_reading_once_keeps_equal_rows_of_a_batch(spark):
    """Two tasks of one payment may look the same in the archive."""
    root = paths.fresh_folder(spark, "lake")
    pair = records(spark, {"event_type": "payment", "order_id": "o", "task_status": "DONE"})
    for batch in ("b1", "b2"):
        lake.write_batch(spark, pair.unionByName(pair), root, batch)
    assert lake.read(spark, root, once=True).count() == 2


def test_half_written_batch_is_not_seen_and_its_retry_leaves_nothing_stale(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark).filter("event_id = 'e0'"), root, "b1")
    tagged = lake.with_folders(some(spark))
    tagged.write.partitionBy("kind", "dt").parquet(batches.batch_folder(root, "data", "b2"))
    assert lake.read(spark, root).count() == 1
    lake.write_batch(spark, some(spark).filter("event_id = 'e1'"), root, "b2")
    assert [r[0] for r in values(lake.read(spark, root), "event_id")] == ["e0", "e1"]


def test_ranges(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark), root, "b1")

    def ids(*limits):
        return [r[0] for r in values(lake.read_range(spark, root, *limits), "event_id")]

    assert ids("2024-03-01", "2024-03-01") == ["e0"]
    assert ids("2024-03-02", "2024-03-03") == ["e1", "e2", "e3"]
    assert ids("2024-04-01", "2024-04-30") == []
    assert len(ids()) == 6
    for limits in (("2024-03-02", "2024-03-01"), ("2024-03-02", None), (None, "2024-03-02")):
        with pytest.raises(ValueError):
            lake.read_range(spark, root, *limits)


def test_kind_has_its_columns(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark), root, "b1")
    rows = lake.read_kind(spark, root, "cart_add")
    assert rows.columns == [*record_columns("cart_add"), "batch_id", "dt"] and rows.count() == 2
    assert lake.read_kind(spark, root, "signup").columns == [*record_columns(""), "batch_id", "dt"]


def test_lake_without_batches_is_empty(spark):
    root = paths.fresh_folder(spark, "lake")
    rows = lake.read(spark, root)
    assert rows.count() == 0
    assert values(panels.buffering_by_first_referrer(rows)) == [("no_matched_referrer", 0)]
    assert values(lake.run_metrics(rows)) == [("total", None, None, 0, "IDLE")]


def test_empty_batch_is_idle(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark).limit(0), root, "b1")
    lake.write_metrics(spark, root, "b1")
    assert values(spark.read.parquet(f"{root}/metrics"), "line", "row_count", "status") == [("total", 0, "IDLE")]
    assert lake.read(spark, root).count() == 0


def test_metrics_of_one_batch(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, some(spark), root, "b1")
    lake.write_batch(spark, some(spark).filter("event_id = 'e0'"), root, "b2")
    lake.write_metrics(spark, root, "b2")
    rows = values(spark.read.parquet(f"{root}/metrics/batch_id=b2"), "line", "kind", "dt", "row_count", "status")
    assert rows == [("partition", "cart_add", "2024-03-01", 1, None), ("total", None, None, 1, "SUCCESS")]


def test_tables_rebuilt_from_records(spark):
    log = Log().view("v", 1, "google").cart("c", 1).stall("s", 2, 9).event("o", 3, 1, "signup")
    log.pay("p0", 1, "FAIL").pay("p1", 1, tasks=["DONE"]).pay("p2", 2, tasks=["PENDING", "DONE"])
    live = log.tables(spark)
    rebuilt = tables.from_records(archive.wide(live), live.users)
    for name, spec in TABLES.items():
        columns = [c for c in spec.columns if c not in ("task_id", "updated_at")]
        assert values(rebuilt[name], *columns) == values(live[name], *columns), name


def test_tables_from_parquet(spark):
    live = Log().view("v", 1, "google").pay("p", 1, tasks=["DONE"]).tables(spark)
    root = paths.fresh_folder(spark, "tables")
    for name, df in live.named().items():
        df.write.parquet(f"{root}/{name}")
    read = tables.from_parquet(spark, root)
    for name in TABLES:
        assert values(read[name]) == values(live[name])
    assert dict(values(tables.row_counts(read)))["payment_tasks"] == 1


def test_odd_kinds_and_missing_times_are_kept(spark):
    root = paths.fresh_folder(spark, "lake")
    kinds = ["a/b=c", "007", "", " x ", None, "Ünï", "%41"]
    rows = records(spark, *[{"event_type": k} for k in kinds], {"event_type": "cart_add", "created_at": None})
    lake.write_batch(spark, rows, root, "0001")
    got = {r.event_id: r for r in lake.read(spark, root).collect()}
    assert [got[f"e{i}"].event_type for i in range(7)] == kinds
    assert [got[f"e{i}"].kind for i in range(7)] == ["a/b=c", "007", "none", " x ", "none", "ünï", "%41"]
    assert got["e7"].dt is None and got["e7"].created_at is None and got["e7"].batch_id == "0001"
    assert lake.in_range(lake.read(spark, root), "2024-03-01", "2024-03-01").count() == 7
