"""Physical plans stay as they must be for large data."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

from eventmere.operators import archive
from eventmere.plans import catalog, facts, reports
from eventmere.sources import driver_tables, lake, paths

SF = "/root/testdata/sf0.001"
QUERIES = sorted(contract.queries())
# Their plans only read back what they wrote.
WRITERS = ("stream_ingest_counts", "stream_archive_counts", "archive_partition_counts", "archive_run_metrics")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in WRITERS])
def test_no_cross_join_no_python_no_single_task_sort(spark, no_broadcast, name):
    text = plan(contract.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval", "MapInPandas", "Window [", "BroadcastHashJoin"):
        assert bad not in text, bad


def test_range_prunes_folders_and_columns(spark):
    root = paths.fresh_folder(spark, "lake")
    lake.write_batch(spark, archive.wide(driver_tables.tables(spark, SF)), root, "b")
    text = formatted(lake.in_range(lake.read(spark, root), "2024-01-10", "2024-01-12").select("user_id"))
    assert re.search(r"PartitionFilters: .*dt#\d+ >= 2024-01-10.*dt#\d+ <= 2024-01-12", text)
    assert re.search(r"PushedFilters: .*created_at", text)
    assert re.search(r"ReadSchema: struct<user_id:bigint,created_at:timestamp>", text)
    text = formatted(facts.from_records(lake.read(spark, root)).carts)
    assert re.search(r"PartitionFilters: .*kind#\d+ = cart_add", text)
    assert "Exchange" not in text


def test_reports_shuffle_the_parent_log_once(spark, no_broadcast):
    live = facts.from_tables(driver_tables.tables(spark, SF))
    for report in (reports.cart_dropout_by_lecture, reports.channel_buffering_quality):
        df = report(live)
        df.collect()
        assert "ReusedExchange" in plan(df)


def test_kinds_are_chosen_in_the_scan(spark):
    text = formatted(driver_tables.tables(spark, SF).cart_add_details)
    assert "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_top_creators_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(catalog.queries()["dash_top_creators_by_buffering"](spark, SF))


def below(text: str, pattern: str) -> list[str]:
    """Subtrees of a printed plan whose first line fits."""
    lines = text.splitlines()
    trees = []
    for i, line in enumerate(lines):
        if re.search(pattern, line):
            depth = re.search(r"\w|\*", line).start()
            end = next((j for j in range(i + 1, len(lines)) if re.search(r"\w|\*", lines[j]).start() <= depth), len(lines))
            trees.append("\n".join(lines[i:end]))
    return trees


def final(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_events_without_order_are_not_shuffled_by_order(spark, no_broadcast):
    """Otherwise all events but payments would meet in the task of the NULL order."""
    trees = below(final(archive.wide(driver_tables.tables(spark, SF))), r"Exchange hashpartitioning\(order_id")
    assert len(trees) == 2
    for tree in trees:
        scans = [line for line in tree.splitlines() if "FileScan" in line]
        assert scans and all("EqualTo(event_type,purchase)" in line for line in scans)


def test_orders_with_several_tasks_share_the_shuffles(spark, no_broadcast):
    live = driver_tables.tables(spark, SF)
    more = live.payment_tasks.filter("task_id % 10 = 0").withColumn("task_id", F.col("task_id") + 10**6)
    df = archive.wide(live.with_tables(payment_tasks=live.payment_tasks.unionByName(more)))
    text = final(df)
    assert df.count() == live.master_event_logs.count() + more.count()
    reused = [line for line in text.splitlines() if "ReusedExchange" in line and "hashpartitioning(event_id" in line]
    assert len(reused) >= 4  # the parent log and three details


def test_write_spreads_hot_folders(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lake, "spread", lambda rows, real=lake.spread: seen.append(real(rows)) or seen[0])
    lake.write_batch(spark, archive.wide(driver_tables.tables(spark, SF)), paths.fresh_folder(spark, "lake"), "b")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(seen[0])
