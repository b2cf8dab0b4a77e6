"""Split incoming events over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.operators.dedupe import earliest_row
from eventmere.schemas import DETAIL_OF_KIND, PAID, RAW_EVENT, TABLES, WAITING
from eventmere.sources.tables import Tables


def with_ids(raw: DataFrame, *natural_key: str) -> DataFrame:
    """Fill missing event ids from columns that tell events apart; a retry gives the same ids."""
    made = labels.stable_uuid(*[F.col(c) for c in natural_key])
    return raw.withColumn("event_id", F.coalesce("event_id", made))


def route(raw: DataFrame) -> dict[str, DataFrame]:
    """Each event as a parent row and, for a listed kind, one row of its detail table.

    A paid payment also opens one waiting follow-up task.
    """
    frames = {"master_event_logs": raw.select(*TABLES["master_event_logs"].columns)}
    for kind, table in DETAIL_OF_KIND.items():
        frames[table] = raw.filter(F.col("event_type") == kind).select(*TABLES[table].columns)
    frames["payment_tasks"] = follow_up_tasks(raw)
    return frames


def follow_up_tasks(raw: DataFrame) -> DataFrame:
    paid = raw.filter((F.col("event_type") == "payment") & (F.col("status") == PAID))
    return paid.select(
        labels.task_key(F.col("order_id")).alias("task_id"),
        "order_id",
        F.lit(WAITING).alias("status"),
        F.lit(0).alias("retry_count"),
        F.col("created_at").alias("updated_at"),
    )


def _broken_rule() -> Column:
    """First declared rule of its tables an event breaks on its own, else NULL."""
    cases = []
    for kind, table in [(None, "master_event_logs"), *DETAIL_OF_KIND.items()]:
        applies = "" if kind is None else f"event_type = '{kind}' AND "
        spec = TABLES[table]
        cases += [f"WHEN {applies}{column} IS NULL THEN 'missing {column}'" for column in spec.required]
        cases += [
            f"WHEN {applies}length({column}) > {limit} THEN 'too long {column}'"
            for column, limit in spec.max_length.items()
        ]
    return F.expr(f"CASE {' '.join(cases)} END")


def judge(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Add ``reject_reason``: why an event cannot be stored, NULL when it can.

    With ``users`` both the acting user and the creator must be known. The ids that are
    not, each once and mostly few, are what events are joined with: known creators, whose
    events pile up, then meet in no task, as AQE sends a small table to all.
    """
    judged = raw.withColumn("reject_reason", _broken_rule())
    if users is not None:
        for column, text in (("user_id", "unknown user"), ("creator_id", "unknown creator")):
            ids = raw.select(column).distinct().join(users.select(F.col("user_id").alias(column)), column, "left_anti")
            unknown = ids.withColumn("_unknown", F.lit(True))
            judged = judged.join(unknown, column, "left").withColumn(
                "reject_reason",
                F.coalesce("reject_reason", F.when(F.col(column).isNull() | F.col("_unknown").isNotNull(), F.lit(text))),
            ).drop("_unknown")
    return judged.select(*raw.columns, "reject_reason")


def unknown_people(raw: DataFrame, users: DataFrame) -> DataFrame:
    """Ids of acting users and creators that are not known, each once."""
    ids = raw.select("user_id").unionByName(raw.select(F.col("creator_id").alias("user_id"))).distinct()
    return ids.filter(F.col("user_id").isNotNull()).join(users.select("user_id"), "user_id", "left_anti")


def fit_events(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Events that break no rule, repeated ones as often as they came."""
    return judge(raw, users).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def first_events(raw: DataFrame, users: DataFrame | None = None, stored: Tables | None = None) -> DataFrame:
    """Of the fit events with one id the earliest; ids already in ``stored`` are taken."""
    # Copies are combined before ids are looked up, so that a key with very many rows never meets in one task.
    events = earliest_row(fit_events(raw, users), "event_id", order=("created_at",))
    if stored is not None:
        events = events.join(stored.master_event_logs.select("event_id").hint("merge"), "event_id", "left_anti")
    return events


def first_payments(events: DataFrame, stored: Tables | None = None) -> DataFrame:
    """Of the payments among :func:`first_events` with one order the earliest; orders already in ``stored`` are taken."""
    payments = earliest_row(events.filter(F.col("event_type") == "payment"), "order_id", order=("created_at", "event_id"))
    if stored is not None:
        payments = payments.join(stored.payment_details.select("order_id").hint("merge"), "order_id", "left_anti")
    return payments


def with_payments(events: DataFrame, payments: DataFrame) -> DataFrame:
    """:func:`first_events` with :func:`first_payments` in place of their payments: what can be stored."""
    names = RAW_EVENT.fieldNames()
    return events.filter(F.col("event_type") != "payment").select(*names).unionByName(payments.select(*names))


def accept(raw: DataFrame, users: DataFrame | None = None, stored: Tables | None = None) -> DataFrame:
    """Events that can be stored whole: an event that breaks a rule goes with all its parts.

    Of several events with one id, or payments with one order, the earliest stays.
    Ids and orders already in ``stored`` are taken.
    """
    events = first_events(raw, users, stored)
    return with_payments(events, first_payments(events, stored))


def rejected(
    raw: DataFrame, users: DataFrame | None = None, stored: Tables | None = None, events: DataFrame | None = None,
    payments: DataFrame | None = None, repeats: bool = True,
) -> DataFrame:
    """One row per event that :func:`accept` leaves out, with its ``reject_reason``.

    Repeats are kept as often as they came: accepted and rejected make up all events.
    No join gathers the rows of a repeated event or order; they are counted by all columns.
    ``events`` and ``payments`` are :func:`first_events` and :func:`first_payments`, if they are
    there already; ``repeats`` is False if there are as many first events as fit ones.
    """
    names = RAW_EVENT.fieldNames()
    raw = raw.select(*names)
    parts = [judge(raw, users).filter(F.col("reject_reason").isNotNull())]
    first = first_events(raw, users, stored) if events is None else events
    if repeats:
        # All copies but the one that stays: each row counts one, the first of its id takes one off.
        fit = fit_events(raw, users)
        counted = fit.select(*names, F.lit(1).alias("_one")).unionByName(first.select(*names, F.lit(-1).alias("_one")))
        left = counted.groupBy(*names).agg(F.sum("_one").alias("_left")).filter("_left > 0")
        again = left.withColumn("_one", F.explode(F.array_repeat(F.lit(0), F.col("_left").cast("int"))))
        parts.append(again.select(*names, F.lit("repeated event_id").alias("reject_reason")))
    winners = first_payments(first, stored) if payments is None else payments
    # Event ids are unique here, order ids are not.
    losers = first.filter(F.col("event_type") == "payment").join(winners.select("event_id").hint("merge"), "event_id", "left_anti")
    parts.append(losers.select(*names, F.lit("repeated order_id").alias("reject_reason")))
    return reduce(lambda a, b: a.unionByName(b), [p.select(*names, "reject_reason") for p in parts])


def rejected_counts(raw: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Rejected events per reason, copies of an event or order included.

    One grouping by event id gives copies and the event that stays, a second one
    by order what is repeated there; both are combined before their shuffles.
    """
    judged = judge(raw, users)
    rest = ["created_at", "event_type", "order_id"]
    per_event = judged.groupBy("reject_reason", "event_id").agg(
        F.count("*").alias("_rows"), F.min(F.struct(*rest)).alias("_first")
    )
    paid = F.col("reject_reason").isNull() & (F.col("_first.event_type") == "payment")
    order = F.when(paid, F.col("_first.order_id")).alias("_order")
    per_order = per_event.groupBy("reject_reason", order).agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_events"))
    per_reason = per_order.groupBy("reject_reason").agg(
        F.sum("_rows").alias("_rows"),
        F.sum("_events").alias("_events"),
        F.sum(F.when(F.col("_order").isNotNull(), F.col("_events") - 1).otherwise(0)).alias("_orders"),
    )
    line = lambda reason, count: F.struct(reason.alias("reject_reason"), count.cast("bigint").alias("event_count"))
    repeats = F.array(
        line(F.lit("repeated event_id"), F.col("_rows") - F.col("_events")), line(F.lit("repeated order_id"), F.col("_orders"))
    )
    alone = F.array(line(F.col("reject_reason"), F.col("_rows")))
    lines = F.when(F.col("reject_reason").isNull(), repeats).otherwise(alone)
    return per_reason.select(F.inline(lines)).filter("event_count > 0")
