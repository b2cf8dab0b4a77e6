"""Tables, event kinds and lake records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Names and limits that must stay as they are, because stored
# data and reports use them.

COMMON_COLUMNS = ("event_id", "user_id", "creator_id", "event_type", "created_at")

KIND_COLUMNS = {
    "page_view": ("lecture_id", "referrer"),
    "cart_add": ("lecture_id",),
    "video_buffering": ("lecture_id", "buffering_duration", "user_agent"),
    "payment": (
        "order_id",
        "amount",
        "payment_status",
        "error_code",
        "task_status",
        "retry_count",
    ),
}

PAID = "SUCCESS"
WAITING = "PENDING"

NO_REFERRER_LABEL = "no_matched_referrer"
PAID_METRIC_LABEL = "Success Payments"
WAITING_METRIC_LABEL = "Pending Outbox Tasks"
# --------------------------------------------------------------------------

KINDS = tuple(KIND_COLUMNS)

# Kind label of rows whose event type is missing or empty.
NO_KIND = "none"


@dataclass(frozen=True)
class TableSpec:
    """Declared shape and rules of one logical table."""

    schema: T.StructType
    primary_key: str
    unique: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_LONG, _INT, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType()

# Ids are 64-bit: 32 bits are too few for users and lectures of a large log.
# Event ids are UUID text.
TABLES: dict[str, TableSpec] = {
    "users": TableSpec(
        _table(
            ("user_id", _LONG, False),
            ("email", _TEXT, False),
            ("name", _TEXT, False),
            ("role", _TEXT, False),
            ("joined_at", _TIME, False),
        ),
        primary_key="user_id",
        unique=("email",),
        max_length={"email": 100, "name": 50, "role": 20},
    ),
    "master_event_logs": TableSpec(
        _table(
            ("event_id", _TEXT, False),
            ("user_id", _LONG, False),
            ("creator_id", _LONG, False),
            ("event_type", _TEXT, False),
            ("created_at", _TIME, False),
        ),
        primary_key="event_id",
        foreign_keys={"user_id": ("users", "user_id"), "creator_id": ("users", "user_id")},
        max_length={"event_type": 50},
    ),
    "page_view_details": TableSpec(
        _table(
            ("event_id", _TEXT, False),
            ("lecture_id", _LONG, False),
            ("referrer", _TEXT, False),
        ),
        primary_key="event_id",
        foreign_keys={"event_id": ("master_event_logs", "event_id")},
        max_length={"referrer": 100},
    ),
    "cart_add_details": TableSpec(
        _table(("event_id", _TEXT, False), ("lecture_id", _LONG, False)),
        primary_key="event_id",
        foreign_keys={"event_id": ("master_event_logs", "event_id")},
    ),
    "video_buffering_details": TableSpec(
        _table(
            ("event_id", _TEXT, False),
            ("lecture_id", _LONG, False),
            ("buffering_duration", _INT, False),
            ("user_agent", _TEXT, False),
        ),
        primary_key="event_id",
        foreign_keys={"event_id": ("master_event_logs", "event_id")},
        max_length={"user_agent": 255},
    ),
    "payment_details": TableSpec(
        _table(
            ("event_id", _TEXT, False),
            ("order_id", _TEXT, False),
            ("amount", _INT, False),
            ("status", _TEXT, False),
            ("error_code", _TEXT, True),
        ),
        primary_key="event_id",
        unique=("order_id",),
        foreign_keys={"event_id": ("master_event_logs", "event_id")},
        max_length={"order_id": 100, "status": 20, "error_code": 50},
    ),
    "payment_tasks": TableSpec(
        _table(
            ("task_id", _LONG, False),
            ("order_id", _TEXT, False),
            ("status", _TEXT, False),
            ("retry_count", _INT, False),
            ("updated_at", _TIME, False),
        ),
        primary_key="task_id",
        foreign_keys={"order_id": ("payment_details", "order_id")},
        max_length={"order_id": 100, "status": 20},
    ),
}

# Which detail table takes the events of a kind.
DETAIL_OF_KIND = {
    "page_view": "page_view_details",
    "cart_add": "cart_add_details",
    "video_buffering": "video_buffering_details",
    "payment": "payment_details",
}

# One incoming event before it is split over the tables.
RAW_EVENT = T.StructType(
    [
        T.StructField("event_id", _TEXT),
        T.StructField("user_id", _LONG),
        T.StructField("creator_id", _LONG),
        T.StructField("event_type", _TEXT),
        T.StructField("created_at", _TIME),
        T.StructField("lecture_id", _LONG),
        T.StructField("referrer", _TEXT),
        T.StructField("buffering_duration", _INT),
        T.StructField("user_agent", _TEXT),
        T.StructField("order_id", _TEXT),
        T.StructField("amount", _INT),
        T.StructField("status", _TEXT),
        T.StructField("error_code", _TEXT),
    ]
)

# One archived event: every column any kind may carry.
WIDE = T.StructType(
    [
        T.StructField("event_id", _TEXT),
        T.StructField("user_id", _LONG),
        T.StructField("creator_id", _LONG),
        T.StructField("event_type", _TEXT),
        T.StructField("created_at", _TIME),
        T.StructField("lecture_id", _LONG),
        T.StructField("referrer", _TEXT),
        T.StructField("buffering_duration", _INT),
        T.StructField("user_agent", _TEXT),
        T.StructField("order_id", _TEXT),
        T.StructField("amount", _INT),
        T.StructField("payment_status", _TEXT),
        T.StructField("error_code", _TEXT),
        T.StructField("task_status", _TEXT),
        T.StructField("retry_count", _INT),
    ]
)

# Folder columns of the lake, outermost first.
LAKE_FOLDERS = T.StructType(
    [
        T.StructField("batch_id", _TEXT),
        T.StructField("kind", _TEXT),
        T.StructField("dt", T.DateType()),
    ]
)
LAKE = T.StructType(WIDE.fields + LAKE_FOLDERS.fields)

# The same record before any repair, as text files hold it.
TEXT_RECORD = T.StructType([T.StructField(name, _TEXT) for name in WIDE.fieldNames()])


def record_columns(kind: str) -> list[str]:
    """Columns an archived record of this kind holds; unlisted kinds hold the common ones."""
    return [*COMMON_COLUMNS, *KIND_COLUMNS.get(kind, ())]
