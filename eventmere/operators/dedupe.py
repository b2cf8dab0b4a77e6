"""Keep one row per key without gathering a key's rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def earliest_row(df: DataFrame, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Per key the first row by ``order``, then by all other columns in turn.

    A minimum over a struct is combined on the map side, so a key with very many
    copies leaves each task as one row; a window would sort them all in one task.
    Ties are broken by every column, so a recomputed task picks the same row.
    """
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def earliest_value(df: DataFrame, key: str, value: str, order: list[Column]) -> DataFrame:
    """Per key the value of the first row by ``order``, NULL order values last."""
    rank = [part for column in order for part in (column.isNull(), column)]
    return df.groupBy(key).agg(F.min_by(value, F.struct(*rank)).alias(value))


def add_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows as they are, plus incoming rows whose key is new."""
    new = earliest_row(incoming.select(*existing.columns), key)
    return existing.unionByName(new.join(existing.select(key), key, "left_anti").select(*existing.columns))
