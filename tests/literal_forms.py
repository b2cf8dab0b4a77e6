"""The reports as full joins: slow, many rows per user, and the measure of the fast forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.sources.tables import Tables


def _with_parent(detail: DataFrame, tables: Tables) -> DataFrame:
    return detail.join(tables.master_event_logs.drop("event_type"), "event_id")


def _hundredths(x):
    return F.round(x, 2).cast("double")


def cart_dropout_by_lecture(tables: Tables) -> DataFrame:
    carts = _with_parent(tables.cart_add_details, tables).select("user_id", "lecture_id")
    payments = _with_parent(tables.payment_details, tables).select("user_id", "order_id", "status")
    paid = F.col("status") == "SUCCESS"
    grouped = carts.join(payments, "user_id", "left").groupBy("lecture_id").agg(
        F.count_distinct("user_id").alias("cart_user_count"),
        F.count_distinct(F.when(paid, F.col("order_id"))).alias("actual_payment_count"),
        F.count_distinct(F.when(paid, F.col("user_id"))).alias("payers"),
    )
    lost = (F.col("cart_user_count") - F.col("payers")).cast("decimal(20,0)") * 100
    return grouped.withColumn("dropout_rate", _hundredths(lost / F.col("cart_user_count"))).drop("payers")


def channel_buffering_quality(tables: Tables) -> DataFrame:
    views = _with_parent(tables.page_view_details, tables).select(
        "user_id", F.col("event_id").alias("view_id"), F.col("referrer").alias("marketing_channel")
    )
    stalls = _with_parent(tables.video_buffering_details, tables).select(
        "user_id", F.col("event_id").alias("stall_id"), "buffering_duration"
    )
    total = F.sum("buffering_duration").cast("decimal(20,0)")
    mean = F.try_divide(total, F.count("buffering_duration"))
    return views.join(stalls, "user_id", "left").groupBy("marketing_channel").agg(
        F.count_distinct("view_id").alias("total_page_views"),
        F.count_distinct("stall_id").alias("buffering_incident_count"),
        F.coalesce(_hundredths(mean), F.lit(0.0)).alias("avg_buffering_seconds"),
    )


def outbox_stuck_rate(tables: Tables) -> DataFrame:
    tasks = tables.payment_tasks.select("order_id", F.col("status").alias("task_status"))
    joined = tables.payment_details.join(tasks, "order_id", "left")
    totals = joined.agg(
        F.count_if(F.col("status") == "SUCCESS").alias("total_success_payments"),
        F.count_if(F.col("task_status") == "PENDING").alias("pending_outbox_tasks"),
    )
    rate = F.col("pending_outbox_tasks").cast("decimal(20,0)") * 100 / F.nullif(F.col("total_success_payments"), F.lit(0))
    return totals.withColumn("outbox_stuck_rate", _hundredths(rate))


def creator_buffering_risk(tables: Tables) -> DataFrame:
    joined = _with_parent(tables.video_buffering_details, tables)
    mean = F.sum("buffering_duration").cast("decimal(20,0)") / F.count("buffering_duration")
    return joined.groupBy("creator_id").agg(
        F.count_distinct("event_id").alias("total_creator_events"),
        F.count_distinct("event_id").alias("total_buffering_incidents"),
        _hundredths(mean).alias("avg_buffering_duration_secs"),
    )


def wide(tables: Tables) -> DataFrame:
    """All joins in one chain, tasks last."""
    views = tables.page_view_details.withColumnRenamed("lecture_id", "l1")
    carts = tables.cart_add_details.withColumnRenamed("lecture_id", "l2")
    stalls = tables.video_buffering_details.withColumnRenamed("lecture_id", "l3")
    payments = tables.payment_details.withColumnRenamed("status", "payment_status")
    tasks = tables.payment_tasks.select("order_id", F.col("status").alias("task_status"), "retry_count")
    joined = tables.master_event_logs
    for detail in (views, carts, stalls, payments):
        joined = joined.join(detail, "event_id", "left")
    joined = joined.join(tasks, "order_id", "left")
    return joined.withColumn("lecture_id", F.coalesce("l1", "l2", "l3"))


REPORTS = (cart_dropout_by_lecture, channel_buffering_quality, outbox_stuck_rate, creator_buffering_risk)
