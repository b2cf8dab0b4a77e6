"""The seven logical tables as one set, and where they can come from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.functions import labels
from eventmere.operators.dedupe import earliest_row
from eventmere.schemas import COMMON_COLUMNS, TABLES


@dataclass(frozen=True)
class Tables:
    users: DataFrame
    master_event_logs: DataFrame
    page_view_details: DataFrame
    cart_add_details: DataFrame
    video_buffering_details: DataFrame
    payment_details: DataFrame
    payment_tasks: DataFrame

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def named(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}

    def with_tables(self, **changed: DataFrame) -> Tables:
        return replace(self, **changed)


def from_reader(read: Callable[[str], DataFrame]) -> Tables:
    """Tables from any function that finds one by name; columns are put in declared order."""
    return Tables(**{name: read(name).select(*spec.columns) for name, spec in TABLES.items()})


def from_parquet(spark: SparkSession, root: str) -> Tables:
    """One parquet folder per table, read with the declared schema (no inference)."""
    return from_reader(lambda name: spark.read.schema(TABLES[name].schema).parquet(f"{root}/{name}"))


def empty(spark: SparkSession) -> Tables:
    return from_reader(lambda name: spark.createDataFrame([], TABLES[name].schema))


def from_records(records: DataFrame, users: DataFrame) -> Tables:
    """Rebuild the tables from archived records (one row per payment and task).

    Task ids and task times are not archived; they come back as NULL.
    """
    event = earliest_row(records.drop("task_status", "retry_count"), "event_id")

    def detail(kind: str, *columns: str) -> DataFrame:
        # The first column is one the detail must have; without it there was no detail.
        rows = event.filter(labels.kind_of(F.col("event_type")) == kind)
        return rows.filter(F.col(columns[0]).isNotNull()).select("event_id", *columns)

    payments = detail("payment", "order_id", "amount", F.col("payment_status").alias("status"), "error_code")
    tasks = (
        records.filter(labels.kind_of(F.col("event_type")) == "payment")
        .filter(F.col("task_status").isNotNull())
        .select(
            F.lit(None).cast("bigint").alias("task_id"),
            "order_id",
            F.col("task_status").alias("status"),
            "retry_count",
            F.lit(None).cast("timestamp").alias("updated_at"),
        )
    )
    return Tables(
        users=users,
        master_event_logs=event.select(*COMMON_COLUMNS),
        page_view_details=detail("page_view", "lecture_id", "referrer"),
        cart_add_details=detail("cart_add", "lecture_id"),
        video_buffering_details=detail(
            "video_buffering", "lecture_id", "buffering_duration", "user_agent"
        ),
        payment_details=payments,
        payment_tasks=tasks,
    )


def row_counts(tables: Tables) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.named().items()
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total
