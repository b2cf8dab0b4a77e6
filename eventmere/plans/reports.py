"""The four business reports.

Joins between a user's events are many to many. Both sides are reduced to one row
per user first, so nothing is multiplied out and a busy user costs one row; the
results are the same as those of the full joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.functions.exact import WIDE_INT, percent_2dp, ratio_2dp
from eventmere.plans.facts import Facts


def cart_dropout_by_lecture(facts: Facts) -> DataFrame:
    """Share of a lecture's cart users with no successful payment at all.

    A payment counts for every lecture its user put in the cart.
    """
    cart_users = facts.carts.select("user_id", "lecture_id").distinct()
    orders = facts.paid_orders.groupBy("user_id").agg(F.count("*").alias("_orders"))
    per_lecture = (
        cart_users.join(orders, "user_id", "left")
        .groupBy("lecture_id")
        .agg(
            F.count("*").alias("cart_user_count"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("actual_payment_count"),
            F.count("_orders").alias("_payers"),
        )
    )
    dropped = F.col("cart_user_count") - F.col("_payers")
    return per_lecture.select(
        "lecture_id",
        "cart_user_count",
        "actual_payment_count",
        percent_2dp(dropped, F.col("cart_user_count")).alias("dropout_rate"),
    ).orderBy(F.desc_nulls_first("dropout_rate"), F.asc("lecture_id"))


def channel_buffering_quality(facts: Facts) -> DataFrame:
    """Buffering met by the users of each channel.

    A user seen on two channels counts for both, and each stall weighs once per view
    of its user on the channel.
    """
    views = facts.views.groupBy(F.col("referrer").alias("marketing_channel"), "user_id").agg(
        F.count("*").alias("_views")
    )
    stalls = facts.stalls.groupBy("user_id").agg(
        F.count("*").alias("_stalls"),
        F.count("buffering_duration").alias("_timed"),
        F.sum(F.col("buffering_duration").cast("bigint")).alias("_seconds"),
    )
    weight = F.col("_views").cast("decimal(19,0)")

    def weighted(column: str):
        return F.sum((weight * F.col(column).cast("decimal(19,0)")).cast(WIDE_INT))

    per_channel = (
        views.join(stalls, "user_id", "left")
        .groupBy("marketing_channel")
        .agg(
            F.sum("_views").alias("total_page_views"),
            F.coalesce(F.sum("_stalls"), F.lit(0)).alias("buffering_incident_count"),
            weighted("_seconds").alias("_weighted_seconds"),
            weighted("_timed").alias("_weighted_stalls"),
        )
    )
    mean = ratio_2dp(F.col("_weighted_seconds"), F.col("_weighted_stalls"))
    return per_channel.select(
        "marketing_channel",
        "total_page_views",
        "buffering_incident_count",
        F.coalesce(mean, F.lit(0.0)).alias("avg_buffering_seconds"),
    ).orderBy(F.desc_nulls_first("buffering_incident_count"), F.asc("marketing_channel"))


def outbox_stuck_rate(facts: Facts) -> DataFrame:
    """Waiting tasks against successful payments; always one row.

    Waiting tasks count whatever their payment's status, and a payment counts once
    per task. The rate is NULL without a successful payment.
    """
    zero = F.lit(0).cast("bigint")
    totals = facts.outbox.agg(
        F.coalesce(F.sum("success_rows"), zero).alias("total_success_payments"),
        F.coalesce(F.sum("waiting_rows"), zero).alias("pending_outbox_tasks"),
    )
    return totals.withColumn(
        "outbox_stuck_rate", percent_2dp(F.col("pending_outbox_tasks"), F.col("total_success_payments"))
    )


def creator_buffering_risk(facts: Facts) -> DataFrame:
    """Buffering by creator, longest mean first.

    Only buffering events are looked at, so both counts are equal.
    """
    per_creator = facts.stalls.groupBy("creator_id").agg(
        F.count("*").alias("total_creator_events"),
        F.count("buffering_duration").alias("_timed"),
        F.sum(F.col("buffering_duration").cast("bigint")).alias("_seconds"),
    )
    mean = ratio_2dp(F.col("_seconds"), F.col("_timed"))
    return per_creator.select(
        "creator_id",
        "total_creator_events",
        F.col("total_creator_events").alias("total_buffering_incidents"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_buffering_duration_secs"),
    ).orderBy(F.desc_nulls_first("avg_buffering_duration_secs"), F.asc("creator_id"))
