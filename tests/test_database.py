"""The database reader's cuts; no database is run for it."""

import uuid

import pytest
from pyspark.sql import functions as F

from eventmere.sources import database


@pytest.mark.parametrize("slices", [1, 2, 7, 64, 1000])
def test_slices_cover_every_id_once(spark, slices):
    edge = [f"{i:04x}0000-0000-0000-0000-000000000000" for i in range(0, 65536, 4096)]
    ids = [str(uuid.UUID(int=i * 7919 * 2**100 % 2**128)) for i in range(300)] + edge
    ids += ["ffffffff-ffff-ffff-ffff-ffffffffffff"]
    df = spark.createDataFrame([(i,) for i in ids], "event_id string")
    predicates = database.uuid_slices("event_id", slices)
    assert len(predicates) == slices
    hits = df.select(sum((F.expr(f"int({p})") for p in predicates[:200]), F.lit(0)).alias("n")).collect()
    if slices <= 200:
        assert {r.n for r in hits} == {1}


def test_slices_are_about_equal(spark):
    df = spark.range(20000).select(F.expr("uuid(7)").alias("event_id"))
    counts = [df.filter(p).count() for p in database.uuid_slices("event_id", 4)]
    assert min(counts) > 4500 and max(counts) < 5500


def test_slice_limits():
    for bad in (0, 65537):
        with pytest.raises(ValueError):
            database.uuid_slices("event_id", bad)


def test_range_options():
    assert database.range_options("task_id", 1, 900, 8) == {
        "partitionColumn": "task_id",
        "lowerBound": "1",
        "upperBound": "900",
        "numPartitions": "8",
    }
