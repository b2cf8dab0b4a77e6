"""Small hand-made event logs."""

from __future__ import annotations

from datetime import datetime

from eventmere.schemas import RAW_EVENT, TABLES, TEXT_RECORD, WIDE
from eventmere.sources.tables import Tables

DAY = "2024-03-01 10:00:00"


def at(text: str) -> datetime:
    from datetime import timezone

    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


class Log:
    """Collects rows of all tables and makes frames of them."""

    def __init__(self) -> None:
        self.rows: dict[str, list[tuple]] = {name: [] for name in TABLES}
        self.people: set[int] = set()

    def event(self, event_id, user, creator, kind, when=DAY):
        for person in (user, creator):
            if person not in self.people:
                self.people.add(person)
                self.rows["users"].append((person, f"p{person}@example.com", f"p{person}", "STUDENT", at(DAY)))
        self.rows["master_event_logs"].append((event_id, user, creator, kind, at(when)))
        return self

    def view(self, event_id, user, referrer, creator=1, lecture=1, when=DAY):
        self.rows["page_view_details"].append((event_id, lecture, referrer))
        return self.event(event_id, user, creator, "page_view", when)

    def cart(self, event_id, user, lecture=1, creator=1, when=DAY):
        self.rows["cart_add_details"].append((event_id, lecture))
        return self.event(event_id, user, creator, "cart_add", when)

    def stall(self, event_id, user, seconds, creator=1, lecture=1, when=DAY):
        self.rows["video_buffering_details"].append((event_id, lecture, seconds, "agent"))
        return self.event(event_id, user, creator, "video_buffering", when)

    def pay(self, event_id, user, status="SUCCESS", tasks=(), creator=1, when=DAY, order=None):
        order = order or f"ORD-{event_id}"
        error = None if status == "SUCCESS" else "CARD_DENIED"
        self.rows["payment_details"].append((event_id, order, 50000, status, error))
        for task in tasks:
            self.task(order, task, when)
        return self.event(event_id, user, creator, "payment", when)

    def task(self, order, status, when=DAY):
        number = len(self.rows["payment_tasks"])
        self.rows["payment_tasks"].append((number, order, status, number % 3, at(when)))
        return self

    def tables(self, spark) -> Tables:
        return Tables(
            **{name: spark.createDataFrame(rows, _loose(TABLES[name].schema)) for name, rows in self.rows.items()}
        )


def _loose(schema):
    """Same columns, NULL allowed, as files give them."""
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def records(spark, *rows: dict):
    """Archived records from partial rows."""
    base = {"user_id": 1, "creator_id": 1, "created_at": at(DAY)}
    return _frame(spark, WIDE, [{"event_id": f"e{i}", **base, **row} for i, row in enumerate(rows)])


def text_records(spark, *rows: dict):
    base = {"user_id": "1", "creator_id": "1", "event_type": "cart_add", "created_at": DAY}
    return _frame(spark, TEXT_RECORD, [{"event_id": f"e{i}", **base, **row} for i, row in enumerate(rows)])


def raw(spark, *rows: dict):
    base = {"user_id": 1, "creator_id": 1, "created_at": at(DAY)}
    return _frame(spark, RAW_EVENT, [{"event_id": f"e{i}", **base, **row} for i, row in enumerate(rows)])


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
