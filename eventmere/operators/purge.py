"""Remove archived events from the live tables.

What goes is decided by the archived event ids, not by time: an event committed
after the archive read the tables, but stamped before the cutoff, stays. With
nothing archived nothing is removed. Files are not changed; the kept rows are
written as a new set of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.schemas import TABLES
from eventmere.sources.tables import Tables

# Children before parents; users are never purged.
PURGED = tuple(reversed([name for name in TABLES if name != "users"]))


def event_keys(records: DataFrame) -> DataFrame:
    """Ids of archived records, one row each although a payment may have several."""
    return records.select("event_id").distinct()


def _order_keys(tables: Tables, gone: DataFrame) -> DataFrame:
    return tables.payment_details.join(gone, "event_id", "left_semi").select("order_id").distinct()


def removed(tables: Tables, gone: DataFrame) -> dict[str, DataFrame]:
    """Rows that go, per table. ``gone`` holds event ids, each once."""
    orders = _order_keys(tables, gone)
    return {
        name: tables[name].join(orders, "order_id", "left_semi")
        if name == "payment_tasks"
        else tables[name].join(gone, "event_id", "left_semi")
        for name in PURGED
    }


def retained(tables: Tables, gone: DataFrame) -> Tables:
    """The tables without the rows of ``gone``; rows with no matching key stay."""
    orders = _order_keys(tables, gone)
    kept = {
        name: tables[name].join(orders, "order_id", "left_anti")
        if name == "payment_tasks"
        else tables[name].join(gone, "event_id", "left_anti")
        for name in PURGED
    }
    return tables.with_tables(**{name: df.select(*TABLES[name].columns) for name, df in kept.items()})


def removed_counts(tables: Tables, gone: DataFrame) -> DataFrame:
    """How many rows of each table go."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in removed(tables, gone).items()
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total
