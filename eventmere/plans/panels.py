"""The four dashboard panels, computed on archived records.

Records without a creator are left out, wherever they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.operators.dedupe import earliest_value
from eventmere.operators.fallback import grouped_sums_or_default
from eventmere.plans.facts import of_kind
from eventmere.schemas import NO_REFERRER_LABEL, PAID, PAID_METRIC_LABEL, WAITING, WAITING_METRIC_LABEL

# Fixed value: the pattern events are matched with.
STALL_PATTERN = "buffering|video"
TOP_CREATORS = 5


def cart_dropout_by_creator(records: DataFrame) -> DataFrame:
    """Cart events without a payment, by creator, never below zero.

    Rows are counted, not users. A missing payment status counts as paid here.
    """
    pair = F.col("event_type").isin("cart_add", "payment")
    rows = records.filter(pair & F.col("creator_id").isNotNull())
    if "kind" in records.columns:
        rows = rows.filter(F.col("kind").isin("cart_add", "payment"))
    is_cart = F.col("event_type") == "cart_add"
    is_paid = (F.col("event_type") == "payment") & (F.coalesce("payment_status", F.lit(PAID)) == PAID)
    counts = rows.groupBy("creator_id").agg(
        F.count_if(is_cart).alias("cart_count"), F.count_if(is_paid).alias("payment_count")
    )
    lost = F.greatest(F.col("cart_count") - F.col("payment_count"), F.lit(0))
    return counts.filter("cart_count > 0").withColumn(
        "dropout_rate", lost.cast("double") / F.col("cart_count").cast("double") * F.lit(100.0)
    )


def first_referrer_per_user(records: DataFrame) -> DataFrame:
    """Referrer of each user's earliest page view that has one."""
    named = F.col("referrer").isNotNull() & F.col("user_id").isNotNull() & F.col("creator_id").isNotNull()
    views = of_kind(records, "page_view").filter(named)
    return earliest_value(views, "user_id", "referrer", [F.col("created_at"), F.col("event_id")])


def _stalls(records: DataFrame) -> DataFrame:
    matches = F.coalesce(F.col("event_type").rlike(f"(?i){STALL_PATTERN}"), F.lit(False))
    rows = records.filter(matches & F.col("creator_id").isNotNull())
    # The folder kind is the lower-case event type, so the same pattern prunes folders.
    return rows.filter(F.col("kind").rlike(STALL_PATTERN)) if "kind" in records.columns else rows


def buffering_by_first_referrer(records: DataFrame) -> DataFrame:
    """Buffering events by the channel that first brought the user.

    Users without a page view are left out.
    """
    per_user = _stalls(records).groupBy("user_id").agg(F.count("*").alias("buffering_count"))
    matched = per_user.join(first_referrer_per_user(records), "user_id")
    return grouped_sums_or_default(matched, "referrer", ["buffering_count"], NO_REFERRER_LABEL)


def outbox_volumes(records: DataFrame) -> DataFrame:
    """Successful payments and, among them, those with a waiting task."""
    success = of_kind(records, "payment").filter((F.col("payment_status") == PAID) & F.col("creator_id").isNotNull())
    totals = success.agg(
        F.count("*").alias("paid"), F.count_if(F.col("task_status") == WAITING).alias("waiting")
    )
    return totals.select(
        F.expr(f"stack(2, '{PAID_METRIC_LABEL}', paid, '{WAITING_METRIC_LABEL}', waiting)").alias("metric", "volume")
    )


def top_creators_by_buffering(records: DataFrame) -> DataFrame:
    """Five creators with the longest mean buffering, ties by creator id.

    Like the channel panel, only users with a page view are looked at.
    """
    timed = _stalls(records).filter(F.col("buffering_duration").isNotNull())
    per_user = timed.groupBy("user_id", "creator_id").agg(
        F.count("*").alias("_stalls"), F.sum("buffering_duration").alias("_seconds")
    )
    matched = per_user.join(first_referrer_per_user(records), "user_id", "left_semi")
    per_creator = grouped_sums_or_default(matched, "creator_id", ["_stalls", "_seconds"], 0)
    mean = F.col("_seconds").cast("double") / F.col("_stalls").cast("double")
    # Only the stand-in row has no stalls.
    ranked = per_creator.select(
        "creator_id", F.when(F.col("_stalls") > 0, mean).otherwise(F.lit(0.0)).alias("avg_buffering_duration")
    )
    top = ranked.orderBy(F.desc("avg_buffering_duration"), F.asc("creator_id")).limit(TOP_CREATORS)
    return top.withColumn("creator", labels.creator_label(F.col("creator_id")))
