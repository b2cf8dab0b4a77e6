"""Archive records: every event with its details and follow-up tasks.

Detail tables hold at most one row per event, so all joins on the event id keep
one row per event and share one partitioning. Only the join with tasks can
multiply rows. It is done on order ids of payments alone: joined last, on the
whole log, every event without an order would meet in the task of the NULL key.
Equal tasks of an order are counted, and records are repeated after all joins.
Tables that grow with the log are joined by merging: sent to all, each would pass the driver.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.schemas import COMMON_COLUMNS, KINDS, WIDE, record_columns
from eventmere.sources.tables import Tables

#: Records that one row of an order with many tasks becomes at once.
RUN = 4096


def up_to(events: DataFrame, cutoff: datetime | Column | None) -> DataFrame:
    """Events at or before one fixed moment; all when there is none."""
    if cutoff is None:
        return events
    moment = cutoff if isinstance(cutoff, Column) else F.lit(cutoff.isoformat(sep=" ")).cast("timestamp")
    return events.filter(F.col("created_at") <= moment)


def _with_lecture(events: DataFrame, tables: Tables) -> DataFrame:
    """Add the lecture from whichever detail exists, and the view and buffering details."""
    views = tables.page_view_details.select("event_id", F.col("lecture_id").alias("_view"), "referrer")
    carts = tables.cart_add_details.select("event_id", F.col("lecture_id").alias("_cart"))
    stalls = tables.video_buffering_details.select(
        "event_id", F.col("lecture_id").alias("_stall"), "buffering_duration", "user_agent"
    )
    joined = events
    for details in (views, carts, stalls):
        joined = joined.join(details.hint("merge"), "event_id", "left")
    return joined.withColumn("lecture_id", F.coalesce("_view", "_cart", "_stall")).drop("_view", "_cart", "_stall")


def _with_payment(events: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Events with payment and task columns: those with one task at most, and those to be given ``_tasks`` more.

    Tasks are first counted per order. Orders with one task, nearly all of them,
    take it straight from that count row. The few payments of orders with more
    begin the second frame: the log is only looked up for them. It has a row per
    payment and distinct task columns, which :func:`_spread_tasks` repeats as the last step.
    """
    tasks = tables.payment_tasks.select("order_id", F.col("status").alias("task_status"), "retry_count")
    equal = tasks.groupBy("order_id", "task_status", "retry_count").agg(F.count("*").alias("_tasks"))
    per_order = equal.groupBy("order_id").agg(
        F.sum("_tasks").alias("_tasks"),
        F.min("task_status").alias("task_status"),
        F.min("retry_count").alias("retry_count"),
    )
    paid = tables.payment_details.select(
        "event_id", "order_id", "amount", F.col("status").alias("payment_status"), "error_code"
    )
    joined = events.join(paid.join(per_order.hint("merge"), "order_id", "left").hint("merge"), "event_id", "left")
    single = joined.filter(F.coalesce(F.col("_tasks") <= 1, F.lit(True))).drop("_tasks")
    crowded = paid.join(per_order.filter("_tasks > 1").select("order_id"), "order_id", "left_semi")
    return single, events.join(crowded, "event_id").join(equal, "order_id")


def _spread_tasks(rows: DataFrame) -> DataFrame:
    """Every row ``_tasks`` times; what one row becomes is made by many tasks, ``RUN`` rows at once."""
    runs = rows.withColumn("_run", F.explode(F.expr(f"sequence(0, (_tasks - 1) div {RUN})")))
    runs = runs.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "event_id", "task_status", "retry_count", "_run")
    size = F.least(F.lit(RUN), F.col("_tasks") - F.col("_run") * RUN).cast("int")
    return runs.withColumn("_one", F.explode(F.array_repeat(F.lit(0), size))).drop("_tasks", "_run", "_one")


def wide(tables: Tables, cutoff: datetime | Column | None = None) -> DataFrame:
    """All events up to the cutoff with every archive column."""
    return _records(up_to(tables.master_event_logs, cutoff), tables, WIDE.fieldNames())


def of_kind(tables: Tables, kind: str, cutoff: datetime | Column | None = None) -> DataFrame:
    """Records of one kind with that kind's columns; only the joins they need are made."""
    label = labels.kind_of(F.col("event_type"))
    events = up_to(tables.master_event_logs, cutoff).filter(label == kind)
    return _records(events, tables, record_columns(kind))


def of_other_kinds(tables: Tables, cutoff: datetime | Column | None = None) -> DataFrame:
    """Records of unlisted kinds: the common columns, no join."""
    label = labels.kind_of(F.col("event_type"))
    return up_to(tables.master_event_logs, cutoff).filter(~label.isin(*KINDS)).select(*COMMON_COLUMNS)


def _records(events: DataFrame, tables: Tables, columns: list[str]) -> DataFrame:
    joined = events.filter(F.col("event_id").isNotNull())
    parts = [joined]
    if "order_id" in columns:
        parts = list(_with_payment(joined, tables))
    if "lecture_id" in columns:
        parts = [_with_lecture(part, tables) for part in parts]
    if len(parts) > 1:
        # After all joins, as orders with many payments and many tasks make very many records.
        parts[1] = _spread_tasks(parts[1])
    joined = reduce(lambda a, b: a.unionByName(b), [part.select(*columns) for part in parts])
    return joined.unionByName(events.filter(F.col("event_id").isNull()), allowMissingColumns=True)
