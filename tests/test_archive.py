import literal_forms
from fixtures import Log, at, values
from pyspark.sql import functions as F

from eventmere.operators import archive
from eventmere.schemas import WIDE, record_columns
from eventmere.sources import driver_tables


def mixed(spark):
    log = Log()
    log.view("v", 1, "google", lecture=3).cart("c", 1, lecture=4).stall("s", 2, 9, lecture=5)
    log.pay("p0", 1).pay("p1", 1, tasks=["DONE"]).pay("p3", 2, "FAIL", tasks=["PENDING", "DONE", "DONE"])
    log.event("o", 3, 1, "signup").event("odd", 3, 1, "Page_View").event("bare", 3, 1, "payment")
    # A payment that also has a cart detail, and a task of an unknown order.
    log.rows["cart_add_details"].append(("p1", 8))
    log.task("ORD-none", "PENDING")
    # An event without id next to details without one.
    log.event(None, 3, 1, "page_view").rows["page_view_details"].append((None, 2, "x"))
    return log.tables(spark)


def test_wide_equals_the_plain_chain_of_joins(spark):
    tables = mixed(spark)
    names = WIDE.fieldNames()
    got = values(archive.wide(tables), *names)
    assert got == values(literal_forms.wide(tables), *names)
    assert len(got) == 12


def test_wide_equals_the_plain_chain_on_given_tables(spark):
    tables = driver_tables.tables(spark, "/root/testdata/sf0.001")
    assert values(archive.wide(tables), *WIDE.fieldNames()) == values(literal_forms.wide(tables), *WIDE.fieldNames())


def test_kinds_are_the_wide_rows_with_their_own_columns(spark):
    tables = mixed(spark)
    wide = archive.wide(tables)
    for kind in ("page_view", "cart_add", "video_buffering", "payment"):
        expected = wide.filter(F.lower("event_type") == kind)
        assert values(archive.of_kind(tables, kind)) == values(expected, *record_columns(kind))
    assert [r[0] for r in values(archive.of_other_kinds(tables))] == ["o"]


def test_upper_case_kind_is_archived_with_its_kind(spark):
    rows = values(archive.of_kind(mixed(spark), "page_view"), "event_id", "event_type")
    assert rows == [(None, "page_view"), ("odd", "Page_View"), ("v", "page_view")]


def test_an_order_with_very_many_tasks(spark):
    log = Log().pay("hot", 1).pay("cold", 2, tasks=["DONE"])
    tables = log.tables(spark)
    many = spark.range(5000).select(
        (F.col("id") + 100).alias("task_id"),
        F.lit("ORD-hot").alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.lit("PENDING")).otherwise(F.lit("DONE")).alias("status"),
        (F.col("id") % 3).cast("int").alias("retry_count"),
        F.lit(at("2024-03-01")).alias("updated_at"),
    )
    tables = tables.with_tables(payment_tasks=tables.payment_tasks.unionByName(many))
    counts = archive.wide(tables).groupBy("order_id", "task_status").count()
    assert values(counts) == [("ORD-cold", "DONE", 1), ("ORD-hot", "DONE", 2500), ("ORD-hot", "PENDING", 2500)]


def test_cutoff_is_inclusive(spark):
    log = Log().cart("a", 1, when="2024-03-01 23:59:59.999999").cart("b", 1, when="2024-03-02 00:00:00")
    log.cart("c", 1, when="2024-03-02 00:00:00.000001")
    tables = log.tables(spark)
    cutoff = at("2024-03-02").replace(tzinfo=None)
    assert [r[0] for r in values(archive.wide(tables, cutoff), "event_id")] == ["a", "b"]
    assert [r[0] for r in values(archive.of_kind(tables, "cart_add", cutoff), "event_id")] == ["a", "b"]


def test_records_of_one_crowded_payment_are_made_by_many_tasks(spark):
    many = spark.range(40_000).select(
        F.col("id").alias("task_id"), F.lit("ORD-hot").alias("order_id"), F.lit("DONE").alias("status"),
        F.lit(1).alias("retry_count"), F.lit(at("2024-03-01")).alias("updated_at"),
    )
    records = archive.wide(Log().pay("hot", 1).tables(spark).with_tables(payment_tasks=many))
    made = [r["count"] for r in records.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 40_000
    assert max(made) < 32_000


def test_details_are_not_sent_to_all(spark):
    records = archive.wide(mixed(spark))
    records.collect()
    # Only what concerns payments of crowded orders may be.
    assert records._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= 3
