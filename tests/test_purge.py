from fixtures import Log, at, values
from pyspark.sql import functions as F

from eventmere.operators import archive, purge
from eventmere.schemas import TABLES
from eventmere.sources import driver_tables, lake, paths


def log():
    log = Log()
    log.view("v1", 1, "google", when="2024-03-01").view("v2", 1, "google", when="2024-03-05")
    log.cart("c1", 1, when="2024-03-01").stall("s1", 2, 9, when="2024-03-01").stall("s2", 2, 9, when="2024-03-05")
    log.pay("p1", 1, tasks=["DONE", "PENDING"], when="2024-03-01").pay("p2", 1, tasks=["DONE"], when="2024-03-05")
    log.event("o1", 3, 1, "signup", when="2024-03-01")
    return log


CUTOFF = at("2024-03-02").replace(tzinfo=None)


def test_archived_events_go_with_details_and_tasks(spark):
    tables = log().tables(spark)
    gone = purge.event_keys(archive.wide(tables, CUTOFF))
    kept = purge.retained(tables, gone)
    assert [r[0] for r in values(kept.master_event_logs, "event_id")] == ["p2", "s2", "v2"]
    assert [r[0] for r in values(kept.page_view_details, "event_id")] == ["v2"]
    assert values(kept.cart_add_details) == []
    assert [r[0] for r in values(kept.payment_details, "event_id")] == ["p2"]
    assert values(kept.payment_tasks, "order_id", "status") == [("ORD-p2", "DONE")]
    assert kept.users.count() == tables.users.count()
    assert dict(values(purge.removed_counts(tables, gone))) == {
        "payment_tasks": 2, "payment_details": 1, "video_buffering_details": 1,
        "cart_add_details": 1, "page_view_details": 1, "master_event_logs": 5,
    }


def test_purge_order_is_children_first():
    seen = set()
    for name in purge.PURGED:
        for target, _ in TABLES[name].foreign_keys.values():
            assert target not in seen
        seen.add(name)
    assert "users" not in seen


def test_nothing_archived_nothing_purged(spark):
    tables = log().tables(spark)
    gone = purge.event_keys(archive.wide(tables).limit(0))
    kept = purge.retained(tables, gone)
    for name in TABLES:
        assert values(kept[name]) == values(tables[name])
    assert set(n for _, n in values(purge.removed_counts(tables, gone))) == {0}


def test_late_commit_survives(spark):
    before = log().tables(spark)
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, archive.wide(before, CUTOFF), root, "b1")
    later = log().cart("late", 9, when="2024-03-01").pay("latepay", 9, tasks=["PENDING"], when="2024-03-01")
    kept = purge.retained(later.tables(spark), purge.event_keys(lake.read(spark, root)))
    assert [r[0] for r in values(kept.master_event_logs, "event_id")] == ["late", "latepay", "p2", "s2", "v2"]
    assert [r[0] for r in values(kept.payment_tasks, "order_id")] == ["ORD-latepay", "ORD-p2"]


def test_removed_and_retained_are_all(spark):
    tables = driver_tables.tables(spark, "/root/testdata/sf0.01")
    gone = purge.event_keys(archive.up_to(tables.master_event_logs, at("2024-01-15").replace(tzinfo=None)))
    removed, kept = purge.removed(tables, gone), purge.retained(tables, gone)
    for name in purge.PURGED:
        keys = [TABLES[name].primary_key]
        both = removed[name].select(*keys).unionByName(kept[name].select(*keys))
        assert values(both) == values(tables[name].select(*keys)), name
    assert removed["payment_tasks"].agg(F.count("*")).first()[0] > 0
