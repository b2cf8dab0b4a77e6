"""Event-log tables derived from a generic ``events`` table.

The generic table has (event_id, ts, user_id, event_type, value, props). Every
target column is a plain function of one row, so all derived tables stay
filters and projections that the scan can prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.schemas import RAW_EVENT, TABLES
from eventmere.sources.tables import Tables

# --------------------------------------------------------------------------
# How generic values map to the event log.
KIND_NAMES = {
    "view": "page_view",
    "click": "cart_add",
    "error": "video_buffering",
    "purchase": "payment",
}
REFERRERS = ("instagram", "naver_ad", "google", "direct")
AMOUNTS = (50000, 99000, 150000)
AGENTS = ("Mozilla/5.0 (Macintosh)", "Mobile_Safari", "Mozilla/5.0 (Windows NT 10.0)")
CREATORS = 4
LECTURES = 9
USERS_FROM = 1000
EVENTS_PER_USER = 5
# --------------------------------------------------------------------------


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values: tuple, index: str) -> str:
    """SQL for the value at an index."""
    listed = " ".join(f"WHEN {i} THEN {value!r}" for i, value in enumerate(values))
    return f"CASE {index} {listed} END"


_KIND = "CASE event_type {} ELSE event_type END".format(
    " ".join(f"WHEN '{source}' THEN '{target}'" for source, target in KIND_NAMES.items())
)
_PAYMENT = "event_type = 'purchase'"
_STALL = "event_type = 'error'"
_FAILED = "floor(value) % 5 = 0"

# SQL text, as each Column call costs a round trip to the JVM and there are many.
_RAW_COLUMNS = {
    "event_id": "event_id",
    "user_id": f"{USERS_FROM} + event_id - event_id % {EVENTS_PER_USER}",
    "creator_id": f"1 + event_id % {CREATORS}",
    "event_type": _KIND,
    "created_at": "ts",
    "lecture_id": f"CASE WHEN event_type IN ('view', 'click', 'error') THEN 1 + event_id % {LECTURES} END",
    "referrer": f"CASE WHEN event_type = 'view' THEN {_pick(REFERRERS, f'(floor(value) + event_id) % {len(REFERRERS)}')} END",
    "buffering_duration": f"CASE WHEN {_STALL} THEN 3 + floor(value) % 28 END",
    "user_agent": f"CASE WHEN {_STALL} THEN {_pick(AGENTS, f'event_id % {len(AGENTS)}')} END",
    "order_id": f"CASE WHEN {_PAYMENT} THEN 'ORD-' || event_id END",
    "amount": f"CASE WHEN {_PAYMENT} THEN {_pick(AMOUNTS, f'event_id % {len(AMOUNTS)}')} END",
    "status": f"CASE WHEN {_PAYMENT} THEN CASE WHEN {_FAILED} THEN 'FAIL' ELSE 'SUCCESS' END END",
    "error_code": f"CASE WHEN {_PAYMENT} AND {_FAILED} THEN "
    "CASE WHEN event_id % 2 = 0 THEN 'PG_TIMEOUT' ELSE 'CARD_DENIED' END END",
}


def raw_events(events: DataFrame) -> DataFrame:
    """One incoming event per source row; columns a kind does not have are NULL."""
    return events.selectExpr(
        *[f"CAST({_RAW_COLUMNS[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_EVENT.fields]
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    events = read_events(spark, sf_dir)
    raw = raw_events(events)
    # Kinds are chosen by the source's own name for them, which the scan can skip by.
    names = {target: source for source, target in KIND_NAMES.items()}

    def of_kind(kind: str) -> DataFrame:
        return raw_events(events.filter(F.col("event_type") == names[kind]))

    def detail(name: str, kind: str) -> DataFrame:
        return of_kind(kind).select(*TABLES[name].columns)

    return Tables(
        users=users(raw),
        master_event_logs=raw.select(*TABLES["master_event_logs"].columns),
        page_view_details=detail("page_view_details", "page_view"),
        cart_add_details=detail("cart_add_details", "cart_add"),
        video_buffering_details=detail("video_buffering_details", "video_buffering"),
        payment_details=detail("payment_details", "payment"),
        payment_tasks=_tasks(of_kind("payment")),
    )


def _tasks(payments: DataFrame) -> DataFrame:
    return payments.filter("status = 'SUCCESS'").selectExpr(
        "CAST(event_id AS BIGINT) AS task_id",
        "order_id",
        "CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'PENDING' ELSE 'DONE' END AS status",
        "CAST(CAST(event_id AS BIGINT) % 4 AS INT) AS retry_count",
        "created_at AS updated_at",
    )


def users(raw: DataFrame) -> DataFrame:
    """Everyone who acts or is acted on, joined at their earliest event."""

    def people(key: str, role: str) -> DataFrame:
        person, who = F.col("user_id"), F.lit(role)
        return raw.groupBy(F.col(key).alias("user_id")).agg(F.min("created_at").alias("joined_at")).select(
            person,
            labels.role_email(who, person).alias("email"),
            labels.role_name(who, person).alias("name"),
            who.alias("role"),
            "joined_at",
        )

    return people("user_id", "STUDENT").unionByName(people("creator_id", "CREATOR"))
