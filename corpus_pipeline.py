"""Training-data pipeline: rules, near duplicates, benchmark leaks, personal data, segmentation.

Every stage takes all documents its predecessor kept and returns a frame, which is
written and read again before the next stage. All but the last return the columns
they were given.

Cases: null, empty and very short texts fail the base rule and go in the first stage; of
repeated rows, and of rows with the same id that are near duplicates, one stays; rows
without an id are linked with nothing; empty tables give an empty result; extra columns
are carried along, but for names the last stage uses for its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmere.llm import leaks, near, personal, rules, segments, shared

#: Least similarity, in percent, of what counts as near duplicates here; op8 has its own.
NEAR_PERCENT = 80
#: Some stages train or search, which SQL cannot express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return rules.keep_good(docs, shared.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    return near.keep_one(docs, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.keep_clean(docs, shared.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    return personal.mask_personal(docs, size="n_chars")


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their sampled segmentations, piece ids and scores, in place of the text."""
    found = segments.sample_segments(docs, into="segments", keep_text=False)
    kept = [c for c in docs.columns if c not in segments.DIGESTS and c not in ("text", "segments")]
    return found.select(*kept, "segments", *segments.digest_columns())


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The same stage, whose tasks share an executor's memory with their Python workers."""

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shared.small_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


STAGES = [
    ("quality_rules", in_small_batches(quality_rules)),
    ("minhash_near_dedup", in_small_batches(near_dedup)),
    ("benchmark_decontamination", in_small_batches(decontamination)),
    ("personal_data", in_small_batches(personal_data)),
    ("sampled_segments", in_small_batches(segmentation)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
