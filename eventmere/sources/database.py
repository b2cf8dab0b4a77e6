"""Tables read in parallel from a relational database over JDBC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from eventmere.schemas import TABLES
from eventmere.sources.tables import Tables, from_reader


def uuid_slices(column: str, slices: int) -> list[str]:
    """Disjoint predicates that together cover every UUID, about equal in rows.

    UUIDs are even over their leading digits, so a table keyed by one can be
    read by ranges of it: no number or time column is needed. The first slice
    has no lower and the last no upper bound.
    """
    if not 1 <= slices <= 65536:
        raise ValueError("between 1 and 65536 slices")
    edges = [f"{65536 * i // slices:04x}0000-0000-0000-0000-000000000000" for i in range(1, slices)]
    if not edges:
        return [f"{column} IS NOT NULL"]
    inner = [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(edges, edges[1:])]
    return [f"{column} < '{edges[0]}'", *inner, f"{column} >= '{edges[-1]}'"]


def range_options(column: str, lower: int | datetime, upper: int | datetime, slices: int) -> dict[str, str]:
    """Options for a read split by a number or time column; bounds only place the cuts."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(slices),
    }


def from_database(
    spark: SparkSession,
    url: str,
    options: dict[str, str],
    *,
    users_up_to: int,
    tasks_up_to: int,
    slices: int = 64,
    fetch_size: int = 20000,
) -> Tables:
    """Read all tables with ``slices`` connections each.

    Each connection sees its own moment. Apply one cutoff to the parent log and
    purge by archived ids, and rows that arrive meanwhile are left for the next run.
    """
    common = {**options, "fetchsize": str(fetch_size)}

    def read(name: str) -> DataFrame:
        key = TABLES[name].primary_key
        if key == "event_id":
            return spark.read.jdbc(url, name, predicates=uuid_slices(key, slices), properties=common)
        upper = users_up_to if name == "users" else tasks_up_to
        return (
            spark.read.format("jdbc")
            .options(url=url, dbtable=name, **common, **range_options(key, 1, upper, slices))
            .load()
        )

    def typed(name: str) -> DataFrame:
        df = read(name)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in TABLES[name].schema])

    return from_reader(typed)
