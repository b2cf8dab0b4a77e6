"""The few columns reports need, from the live tables or from the archive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.schemas import PAID, WAITING
from eventmere.sources.tables import Tables


@dataclass(frozen=True)
class Facts:
    """One frame per report input.

    carts: user_id, lecture_id.
    views: user_id, referrer; one row per event.
    stalls: user_id, creator_id, buffering_duration; one row per event.
    paid_orders: user_id, order_id; one row per order.
    outbox: success_rows, waiting_rows; to be summed.
    """

    carts: DataFrame
    views: DataFrame
    stalls: DataFrame
    paid_orders: DataFrame
    outbox: DataFrame


def from_tables(tables: Tables) -> Facts:
    """Join details with their parent rows, one to one on the event id.

    The parent's columns are declared NOT NULL. Saying so here gives every report
    branch the same parent scan, which is then shuffled once and reused.
    """
    parent = tables.master_event_logs.filter(F.col("event_id").isNotNull() & F.col("user_id").isNotNull())
    actor = parent.select("event_id", "user_id", "creator_id")
    paid = tables.payment_details.filter(F.col("status") == PAID)
    return Facts(
        carts=tables.cart_add_details.join(actor, "event_id").select("user_id", "lecture_id"),
        views=tables.page_view_details.join(actor, "event_id").select("user_id", "referrer"),
        stalls=tables.video_buffering_details.join(actor, "event_id").select(
            "user_id", "creator_id", "buffering_duration"
        ),
        paid_orders=paid.join(actor, "event_id").select("user_id", "order_id"),
        outbox=_outbox(tables),
    )


def _outbox(tables: Tables) -> DataFrame:
    """Per payment the rows a left join with its tasks would give, without making them."""
    per_order = tables.payment_tasks.groupBy("order_id").agg(
        F.count("*").alias("_tasks"), F.count_if(F.col("status") == WAITING).alias("_waiting")
    )
    joined = tables.payment_details.select("order_id", "status").join(per_order, "order_id", "left")
    return joined.select(
        F.when(F.col("status") == PAID, F.coalesce("_tasks", F.lit(1))).otherwise(0).alias("success_rows"),
        F.coalesce("_waiting", F.lit(0)).alias("waiting_rows"),
    )


def of_kind(records: DataFrame, kind: str) -> DataFrame:
    """Archived records of exactly this event type; the folder filter prunes the scan."""
    rows = records.filter(F.col("event_type") == kind)
    return rows.filter(F.col("kind") == kind) if "kind" in records.columns else rows


def from_records(records: DataFrame) -> Facts:
    """Archived records hold all columns already: no join with a parent is needed.

    A payment has one record per task, so paid orders are made distinct, and the
    outbox is the payment records as they are. A record without the column its
    detail must have is an event without a detail, and left out as in the tables.
    """
    payments = of_kind(records, "payment").filter(F.col("order_id").isNotNull())
    detailed = lambda kind: of_kind(records, kind).filter(F.col("lecture_id").isNotNull())
    success = F.col("payment_status") == PAID
    return Facts(
        carts=detailed("cart_add").select("user_id", "lecture_id"),
        views=detailed("page_view").select("user_id", "referrer"),
        stalls=detailed("video_buffering").select("user_id", "creator_id", "buffering_duration"),
        paid_orders=payments.filter(success).select("user_id", "order_id").distinct(),
        outbox=payments.select(
            F.when(success, F.lit(1)).otherwise(0).alias("success_rows"),
            F.when(F.col("task_status") == WAITING, F.lit(1)).otherwise(0).alias("waiting_rows"),
        ),
    )
