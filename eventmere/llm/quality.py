"""A quality score from random Fourier features of document statistics.

Statistics of the whole text are scaled and sent through random cosines, whose
products approximate a Gaussian kernel. A ridge regression on these features
needs only the sums of their products: every task adds up its own rows, the
partial sums are added row by row of the matrix in a shuffle of fixed width, and
the driver solves one system of ``FEATURES`` unknowns. An isotonic step function,
fitted by pooling neighbours over at most ``BINS`` score bins of other labelled
rows, turns raw scores into shares of good documents.

All labelled rows that may be learned from are used; nothing is sampled. Their
number does not change what the driver holds.

Cases: a null or empty text has zero statistics and gets a score like any other;
null labels and labels without a document are not used; without usable labels
every score is 0.5; repeated rows get equal scores; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.llm import shared
from eventmere.llm.rules import RATIOS
from eventmere.llm.statistics import STRUCT, with_statistics

FEATURES = 160
SEED = 20_240_611
RIDGE = 1.0
BINS = 1000
THRESHOLD = 0.7
STATS = "__statistics"
_INPUTS = len(RATIOS)


def fold(key: str = "doc_id") -> Column:
    """0 to 3 by the checksum of the id as text; fold 2 is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(4)).cast("int")


def inputs(stats: pa.Array) -> np.ndarray:
    """One row of numbers per document, counts on a log scale."""
    counts = {f.name: np.asarray(stats.field(f.name), np.float64) for f in STRUCT.fields}
    columns = []
    for count, per in RATIOS.values():
        value = counts[count] / np.maximum(counts[per], 1) if per else counts[count]
        columns.append(np.log1p(value * (100 if per else 1)))
    return np.column_stack(columns) if len(stats) else np.zeros((0, _INPUTS))


def waves(x: np.ndarray) -> np.ndarray:
    """Random cosines of scaled inputs, and a constant."""
    random = np.random.default_rng(SEED)
    weights = random.normal(0, 1 / np.sqrt(_INPUTS), (_INPUTS, FEATURES))
    shifts = random.uniform(0, 2 * np.pi, FEATURES)
    return np.column_stack((np.sqrt(2 / FEATURES) * np.cos(x @ weights + shifts), np.ones(len(x))))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: pa.Array) -> np.ndarray:
        return waves((inputs(stats) - self.mean) / self.scale) @ self.weights

    def score(self, stats: pa.Array) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def pooled(scores: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic shares by pooling neighbours that are out of order; scores ascend."""
    blocks: list[list[float]] = []  # first score, last score, good, count
    for s, g, c in zip(scores, good, count):
        blocks.append([s, s, g, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots, levels = [], []
    for first, last, g, c in blocks:
        for knot in dict.fromkeys((first, last)):
            knots.append(knot)
            levels.append(g / c)
    return np.array(knots), np.array(levels)


def fit(labelled: DataFrame) -> Model:
    """From rows of statistics, ``_label`` (0 or 1) and ``_fold``; folds 0 and 1 fit, fold 3 calibrates."""
    training = labelled.filter(F.col("_fold").isin(0, 1)).select(STATS, "_label")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = inputs(batch.column(STATS))
        return np.vstack((np.full(_INPUTS, len(x)), x.sum(0), (x * x).sum(0)))

    sums = shared.summed(training, moments, _INPUTS)
    if not len(sums):
        return Model(np.zeros(_INPUTS), np.ones(_INPUTS), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    mean = sums[1] / sums[0]
    scale = np.sqrt(np.maximum(sums[2] / sums[0] - mean**2, 1e-6))

    def products(batch: pa.RecordBatch) -> np.ndarray:
        z = waves((inputs(batch.column(STATS)) - mean) / scale)
        y = np.asarray(batch.column("_label"), np.float64)
        return np.column_stack((z.T @ z, z.T @ y))

    normal = shared.summed(training, products, FEATURES + 2)
    weights = np.linalg.solve(normal[:, :-1] + RIDGE * np.eye(FEATURES + 1), normal[:, -1])
    model = Model(mean, scale, weights, np.zeros(1), np.full(1, 0.5))

    def bins(batch: pa.RecordBatch) -> np.ndarray:
        at = np.clip(np.floor((model.raw(batch.column(STATS)) + 1) / 3 * BINS), 0, BINS - 1).astype(int)
        y = np.asarray(batch.column("_label"), np.float64)
        return np.vstack((np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)))

    counts = shared.summed(labelled.filter(F.col("_fold") == 3).select(STATS, "_label"), bins, BINS)
    if len(counts):
        used = np.flatnonzero(counts[0])
        model.knots, model.levels = pooled((used + 0.5) / BINS * 3 - 1, counts[1][used], counts[0][used])
    else:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(measured: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """Add a score column to rows of statistics."""
    kept = [f for f in measured.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType())])
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(model.score(batch.column(STATS)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values], [*names, into])

    return measured.mapInArrow(add, schema)


def with_labels(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Labelled rows that may be learned from."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_label"))
    rows = measured.select(F.col(key).alias("_key"), STATS, fold(key).alias("_fold")).filter(F.col("_fold") != 2)
    return rows.join(known, "_key").drop("_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = shared.stored(with_statistics(docs, STATS, keep_text=False), "statistics")
    model = fit(with_labels(measured, shared.table(spark, sf_dir, "labels")))
    return score(measured, model).select(
        "doc_id",
        (fold() == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
