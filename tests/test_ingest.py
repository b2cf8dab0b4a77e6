from fixtures import Log, at, raw, values
from pyspark.sql import functions as F

from eventmere.operators import dedupe, ingest, integrity
from eventmere.schemas import TABLES
from eventmere.sources import driver_tables

SF = "/root/testdata/sf0.001"


def test_events_are_routed_by_kind(spark):
    rows = raw(
        spark,
        {"event_type": "page_view", "lecture_id": 3, "referrer": "google"},
        {"event_type": "cart_add", "lecture_id": 4},
        {"event_type": "video_buffering", "lecture_id": 5, "buffering_duration": 7, "user_agent": "a"},
        {"event_type": "payment", "order_id": "o4", "amount": 10, "status": "SUCCESS"},
        {"event_type": "payment", "order_id": "o5", "amount": 10, "status": "FAIL", "error_code": "CARD_DENIED"},
        {"event_type": "signup"},
    )
    frames = ingest.route(rows)
    assert values(frames["page_view_details"]) == [("e0", 3, "google")]
    assert values(frames["cart_add_details"]) == [("e1", 4)]
    assert values(frames["video_buffering_details"]) == [("e2", 5, 7, "a")]
    assert [r[0] for r in values(frames["payment_details"], "event_id")] == ["e3", "e4"]
    assert values(frames["payment_tasks"], "order_id", "status", "retry_count") == [("o4", "PENDING", 0)]
    assert frames["master_event_logs"].count() == 6
    for name, df in frames.items():
        assert df.columns == TABLES[name].columns
        assert [d for _, d in df.dtypes] == [f.dataType.simpleString() for f in TABLES[name].schema], name


def test_task_ids_are_stable_and_distinct(spark):
    events = driver_tables.raw_events(driver_tables.read_events(spark, "/root/testdata/sf0.1"))
    tasks = ingest.follow_up_tasks(events)
    assert tasks.agg(F.count_distinct("task_id")).first()[0] == tasks.count() > 10000
    assert values(tasks.limit(0).unionByName(tasks.filter("order_id = 'ORD-3'"))) == values(tasks.filter("order_id = 'ORD-3'"))


def test_routed_events_keep_every_rule(spark):
    """Given events routed to tables break no declared rule."""
    events = driver_tables.raw_events(driver_tables.read_events(spark, SF))
    live = driver_tables.tables(spark, SF)
    routed = live.with_tables(**ingest.route(events))
    assert {r.violations for r in integrity.constraint_report(routed).collect()} == {0}


def test_missing_ids_are_made_and_stay_the_same(spark):
    rows = raw(spark, {"event_id": None, "event_type": "cart_add"}, {"event_id": None, "event_type": "x"}, {"event_type": "y"})
    once = values(ingest.with_ids(rows, "user_id", "event_type", "created_at"), "event_id")
    assert once == values(ingest.with_ids(rows, "user_id", "event_type", "created_at"), "event_id")
    assert len(set(once)) == 3 and ("e2",) in once


def broken(spark):
    cart = {"event_type": "cart_add", "lecture_id": 1}
    pay = {"event_type": "payment", "amount": 1, "status": "SUCCESS"}
    return raw(
        spark,
        cart,
        {**cart, "lecture_id": None},
        {**cart, "user_id": None},
        {**cart, "event_type": None},
        {**cart, "event_type": "k" * 51},
        {"event_type": "page_view", "lecture_id": 1, "referrer": "r" * 101},
        {"event_type": "page_view", "lecture_id": 1, "referrer": "r" * 100},
        {**pay, "order_id": "o1", "created_at": at("2024-03-02")},
        {**pay, "order_id": "o1", "created_at": at("2024-03-01")},
        {**pay, "order_id": "o1", "created_at": at("2024-03-03")},
        {**pay, "order_id": None},
        {**cart, "creator_id": 77},
        {**cart, "user_id": 78},
        {**cart, "event_id": "e0", "lecture_id": 9, "created_at": at("2024-02-01")},
        {"event_type": "signup"},
    )


USERS = Log().event("x", 1, 1, "signup")


def test_events_that_break_a_rule_are_kept_out_whole(spark):
    users = USERS.tables(spark).users
    accepted = ingest.accept(broken(spark), users)
    assert values(accepted, "event_id", "lecture_id") == [("e0", 9), ("e14", None), ("e6", 1), ("e8", None)]
    assert values(ingest.rejected_counts(broken(spark), users)) == [
        ("missing event_type", 1),
        ("missing lecture_id", 1),
        ("missing order_id", 1),
        ("missing user_id", 1),
        ("repeated event_id", 1),
        ("repeated order_id", 2),
        ("too long event_type", 1),
        ("too long referrer", 1),
        ("unknown creator", 1),
        ("unknown user", 1),
    ]


def test_accepted_and_rejected_are_all(spark):
    rows = broken(spark)
    rejected = sum(n for _, n in values(ingest.rejected_counts(rows)))
    assert ingest.accept(rows).count() + rejected == rows.count()


def test_stored_ids_and_orders_are_taken(spark):
    stored = Log().cart("e0", 1).pay("p", 1, order="o1").tables(spark)
    accepted = ingest.accept(broken(spark), None, stored)
    assert not {r[0] for r in values(accepted, "event_id")} & {"e0", "e7", "e8", "e9"}


def test_repeated_order_takes_nothing_from_the_rest(spark):
    """A payment dropped as a copy leaves no parent row behind."""
    accepted = ingest.accept(broken(spark))
    frames = ingest.route(accepted)
    parents = {r[0] for r in values(frames["master_event_logs"].filter("event_type = 'payment'"), "event_id")}
    assert parents == {r[0] for r in values(frames["payment_details"], "event_id")} == {"e8"}


def test_known_users_are_kept_as_they_are(spark):
    columns = "user_id long, name string"
    known = spark.createDataFrame([(1, "old"), (2, "two")], columns)
    more = spark.createDataFrame([(1, "new"), (3, "three"), (3, "third"), (4, "four")], columns)
    assert values(dedupe.add_absent(known, more, "user_id")) == [(1, "old"), (2, "two"), (3, "third"), (4, "four")]


def test_earliest_row_of_a_key_with_many_copies(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(20000) - F.col("id")).alias("t"),
        F.col("id"),
    )
    first = dedupe.earliest_row(rows, "k", order=("t",))
    assert first.count() == rows.select("k").distinct().count()
    assert values(first.filter("k = 'hot'"), "t", "id") == [(2, 19998)]


def test_copies_of_one_event_are_rejected_by_many_tasks(spark):
    rows = spark.range(4000).select(
        F.lit("hot").alias("event_id"), F.lit(1).cast("long").alias("user_id"), F.lit(2).cast("long").alias("creator_id"),
        F.lit("signup").alias("event_type"), F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("created_at"),
    )
    rows = raw(spark).unionByName(rows, allowMissingColumns=True)
    stored = Log().cart("e0", 1).tables(spark)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = ingest.rejected(rows, None, stored).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(r["count"] for r in left) == 3999
    assert max(r["count"] for r in left) < 2000


def test_rejected_rows_with_stored_ids_and_orders(spark):
    stored = Log().cart("e0", 1).pay("p", 1, order="o1").tables(spark)
    reasons = values(ingest.rejected(broken(spark), None, stored), "event_id", "reject_reason")
    repeated = [r for r in reasons if r[1].startswith("repeated")]
    assert repeated == [("e0", "repeated event_id")] * 2 + [(f"e{n}", "repeated order_id") for n in (7, 8, 9)]
    assert ingest.accept(broken(spark), None, stored).count() + len(reasons) == broken(spark).count()
