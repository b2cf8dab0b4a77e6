"""Quality rules learned from labelled documents as a readable decision list.

Sequential covering: a rule is grown one threshold at a time on two thirds of
the labelled statistics (by information gain), pruned on the other third, and
kept if it is precise enough there; what it covers is taken out and the next
rule is grown. The list becomes one ordered ``CASE WHEN`` over the statistics,
so applying it to a corpus needs no shuffle and no Python beyond the counting.

The list is fitted on about ``FIT_ROWS`` labelled documents, those whose id's hash is
below a bound that follows from the number of labels, by one task. Documents are
judged by the fixed base rule as well.

Cases: null and empty texts have no words and fail the base rule; labels that
are null or belong to no document are not used; of several labels of one document
the lowest counts, once for each row of the document; without labels, or with one
class only, there are no learned rules; repeated rows are judged alike; an empty
table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import shared
from eventmere.llm.statistics import NAMES, with_statistics

#: Labelled documents the list is fitted on, about.
FIT_ROWS = 30_000
MAX_RULES = 8
MAX_CONDITIONS = 4
#: A rule must be this precise on rows it was not grown on, and cover so many of them.
MIN_PRECISION = 0.97
MIN_COVER = 8
STATS = "__statistics"

#: What the rules may test: a count, or one count per so many of another.
RATIOS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_line_share": ("n_dup_lines", "n_lines"),
    "repeated_word_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "stops_per_word": ("n_stops", "n_words"),
    "exclaims_per_word": ("n_exclaims", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = feature_column(self.feature, stats)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        value = rows[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def feature_column(feature: str, stats: str) -> Column:
    count, per = RATIOS[feature]
    value = F.col(f"{stats}.{count}").cast("double")
    return value / F.greatest(F.col(f"{stats}.{per}"), F.lit(1)) if per else value


def base_failed(stats: str) -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 20) | (100 * repeated > 30 * words)


def _holds(rule: Rule, rows: dict[str, np.ndarray], size: int) -> np.ndarray:
    held = np.ones(size, bool)
    for condition in rule:
        held &= condition.holds(rows)
    return held


def _best_condition(rows: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the highest information gain for the covered rows."""
    positives, total = bad[inside].sum(), inside.sum()
    now = np.log2(positives / total)
    best, chosen = 1e-9, None
    for feature, values in rows.items():
        order = np.argsort(values[inside], kind="stable")
        v, b = values[inside][order], bad[inside][order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        below_bad, below = np.cumsum(b)[cuts], cuts + 1
        for above in (False, True):
            p = positives - below_bad if above else below_bad
            n = total - below if above else below
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - now), 0.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best = float(gain[at])
                middle = (v[cuts[at]] + v[cuts[at] + 1]) / 2
                chosen = Condition(feature, above, float(middle if middle < v[cuts[at] + 1] else v[cuts[at]]))
    return best, chosen


def _precision(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, int]:
    held = _holds(rule, rows, len(bad)) & inside
    covered = int(held.sum())
    return (float(bad[held].sum() + 1) / (covered + 2) if covered else 0.0), covered


def fit(rows: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """The ordered list of rules for rejecting; rows are columns of equal length."""
    size = len(bad)
    grow = np.arange(size) % 3 != 2
    left, rules = np.ones(size, bool), []
    while len(rules) < MAX_RULES and bad[left & grow].sum() >= MIN_COVER:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            inside = left & grow & _holds(rule, rows, size)
            if bad[inside].all():
                break
            _, condition = _best_condition(rows, bad, inside)
            if condition is None:
                break
            rule = (*rule, condition)
        # Drop conditions from the end while that is no worse on the other rows.
        check = left & ~grow
        while len(rule) > 1 and _precision(rule[:-1], rows, bad, check)[0] >= _precision(rule, rows, bad, check)[0]:
            rule = rule[:-1]
        precision, covered = _precision(rule, rows, bad, check)
        if not rule or covered < MIN_COVER or precision < MIN_PRECISION * (covered + 1) / (covered + 2):
            break
        rules.append(rule)
        left &= ~_holds(rule, rows, size)
    return rules


def labelled(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """About ``FIT_ROWS`` labelled ids, by a bound on their hash, each once with its lowest label."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.min(F.col(label).cast("int")).alias("_label"))
    share = FIT_ROWS / max(known.count(), 1)
    return known if share >= 1 else known.filter(F.shiftrightunsigned(F.xxhash64("_key"), 1) < int(share * 2**63))


def learn(measured: DataFrame, sample: DataFrame, key: str = "doc_id") -> list[Rule]:
    """Rules from the documents of ``measured`` (``key`` and the statistics) that ``labelled`` gave.

    One task fits the list to this bounded sample; only the rules reach the driver.
    """
    columns = [feature_column(f, STATS).alias(f) for f in RATIOS]
    # The sample is FIT_ROWS ids and labels, some 16 bytes each.
    rows = measured.select(F.col(key).alias("_key"), STATS).join(F.broadcast(sample), "_key")
    rows = rows.select(F.xxhash64("_key").alias("_lot"), "_label", *columns)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.to_pandas() for b in batches]
        found: list[Rule] = []
        if parts:
            table = pd.concat(parts).sort_values(["_lot", "_label", *RATIOS], ignore_index=True)
            bad = (table["_label"] == 0).to_numpy()
            if bad.any() and not bad.all():
                found = fit({f: table[f].to_numpy() for f in RATIOS}, bad)
        lines = [(n, c.feature, c.above, c.threshold) for n, rule in enumerate(found) for c in rule]
        types = (pa.int32(), pa.string(), pa.bool_(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in lines], t) for i, t in enumerate(types)], ["n", "feature", "above", "threshold"])

    lines = rows.repartition(1).mapInArrow(train, "n int, feature string, above boolean, threshold double").collect()
    rules: list[Rule] = []
    for line in lines:
        if line["n"] == len(rules):
            rules.append(())
        rules[line["n"]] += (Condition(line["feature"], line["above"], line["threshold"]),)
    return rules


def keep_column(rules: list[Rule], stats: str = STATS) -> Column:
    """The whole list as one ordered conditional: base rule first, then each learned rule."""
    verdict = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column(stats)
        verdict = verdict.when(held, F.lit(False))
    return verdict.otherwise(F.lit(True))


def judge(measured: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every row of measured documents."""
    rules = learn(measured, labelled(labels, key), key)
    return measured.withColumns({"base_failed": base_failed(STATS), "kept": keep_column(rules)})


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents the list keeps, with their own columns."""
    sample = shared.stored(labelled(labels, key), "labelled")
    # FIT_ROWS ids, some 12 bytes each, whatever the corpus.
    chosen = docs.select(key, text).join(F.broadcast(sample.select(F.col("_key").alias(key))), key, "left_semi")
    rules = learn(with_statistics(chosen, STATS, text, keep_text=False), sample, key)
    return with_statistics(docs, STATS, text).filter(keep_column(rules)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = shared.stored(with_statistics(docs, STATS, keep_text=False), "statistics")
    judged = judge(measured, shared.table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *[F.col(f"{STATS}.{n}") for n in NAMES[:5]], "base_failed", "kept")
