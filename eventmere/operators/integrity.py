"""Check the declared rules and report how many rows break each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.schemas import TABLES
from eventmere.sources.tables import Tables


def _rows(counts: DataFrame, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """Turn one row of counts, with columns v0, v1, ..., into one row per rule."""
    lines = ", ".join(f"'{t}', '{r}', '{c}', {source}" for t, r, c, source in rules)
    stacked = F.expr(f"stack({len(rules)}, {lines})").alias("table_name", "rule", "column_name", "violations")
    return counts.select(stacked)


def _row_rules(name: str, df: DataFrame) -> DataFrame | None:
    """NOT NULL and length rules of a table, all in one pass."""
    spec = TABLES[name]
    checks = [("not_null", c, f"{c} IS NULL") for c in spec.required]
    checks += [("max_length", c, f"length({c}) > {limit}") for c, limit in spec.max_length.items()]
    counts = df.agg(*[F.expr(f"count_if({broken}) AS v{i}") for i, (_, _, broken) in enumerate(checks)])
    return _rows(counts, [(name, rule, column, f"v{i}") for i, (rule, column, _) in enumerate(checks)])


def _key_rules(tables: Tables, target: tuple[str, str]) -> DataFrame:
    """Uniqueness of one key, all references to it, and their own uniqueness, from a single grouping.

    A detail's primary key is also its reference to the event, so its copies are
    counted here as well.

    The key's rows and the referring rows are counted per value and source. Counts
    are combined before the shuffle, so a value most rows refer to arrives as a few
    partial rows.
    """
    table, column = target
    sources = [target]
    for name, spec in TABLES.items():
        sources += [(name, c) for c, referred in spec.foreign_keys.items() if referred == target]
    tagged = [
        tables[name].select(F.col(c).alias("_value"), F.lit(i).alias("_source"))
        for i, (name, c) in enumerate(sources)
    ]
    values = reduce(lambda a, b: a.unionByName(b), tagged).filter(F.col("_value").isNotNull())
    numbered = range(len(sources))
    per_value = values.groupBy("_value").agg(*[F.expr(f"count_if(_source = {i}) AS n{i}") for i in numbered])
    sums = ["greatest(n0 - 1, 0)", *[f"CASE WHEN n0 = 0 THEN n{i} ELSE 0 END" for i in numbered[1:]]]
    own = [i for i, (name, c) in enumerate(sources) if i > 0 and TABLES[name].primary_key == c]
    sums += [f"greatest(n{i} - 1, 0)" for i in own]
    counts = per_value.agg(*[F.expr(f"coalesce(sum({broken}), 0L) AS v{i}") for i, broken in enumerate(sums)])
    unique_rule = "primary_key" if TABLES[table].primary_key == column else "unique"
    rules = [(table, unique_rule, column, "v0")]
    rules += [(name, "foreign_key", c, f"v{i}") for i, (name, c) in enumerate(sources) if i > 0]
    rules += [(sources[i][0], "primary_key", sources[i][1], f"v{len(sources) + k}") for k, i in enumerate(own)]
    return _rows(counts, rules)


def constraint_report(tables: Tables) -> DataFrame:
    """One row per rule with the number of rows that break it.

    For keys, the rows beyond the first of each value count as breaking.
    """
    parts = [_row_rules(name, df) for name, df in tables.named().items()]
    parts += [
        _key_rules(tables, (name, column))
        for name, spec in TABLES.items()
        for column in (spec.primary_key, *spec.unique)
        if not (column == "event_id" and spec.foreign_keys.get("event_id"))
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
