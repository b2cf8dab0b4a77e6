import zlib

import numpy as np

from cases import frame, prose, texts
from eventmere.llm import quality
from eventmere.llm.statistics import with_statistics


def rows():
    good = [(100 + i, " ".join(prose(i, 80)) + ".") for i in range(150)]
    return good + [(400 + i, " ".join(x.upper() + "!!" for x in prose(i, 80))) for i in range(150)]


def test_held_out_accuracy_and_odd_cases(spark):
    labels = spark.createDataFrame(
        [(i, int(i < 400), "x") for i, _ in rows()] + [(7, None, "x"), (None, 1, "x"), (999_999, 1, "x")],
        "doc_id long, quality int, score string",
    )
    measured = with_statistics(frame(spark, rows() + texts()), quality.STATS, keep_text=False)
    model = quality.fit(quality.with_labels(measured, labels))
    got = quality.score(measured, model).select("doc_id", "score", (quality.fold() == 2).alias("out")).collect()
    assert len(got) == len(rows()) + len(texts()) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["out"] and r["doc_id"] is not None and r["doc_id"] >= 100]
    assert len(held) > 40
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] < 400) for r in held]) > 0.95
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)


def test_without_labels_and_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    measured = with_statistics(frame(spark), quality.STATS, keep_text=False)
    model = quality.fit(quality.with_labels(measured, labels))
    assert {r["score"] for r in quality.score(measured, model).collect()} == {0.5}
    empty = with_statistics(frame(spark, []), quality.STATS, keep_text=False)
    assert quality.score(empty, model).count() == 0


def test_sums_equal_the_normal_equations(spark):
    from eventmere.llm import shared

    frame_ = spark.createDataFrame([(float(i), float(i * i)) for i in range(50)], "a double, b double").repartition(5)

    def part(batch):
        x = np.column_stack([np.asarray(batch.column(c)) for c in ("a", "b")])
        return x.T @ x

    x = np.array([(i, i * i) for i in range(50)], float)
    assert np.allclose(shared.summed(frame_, part, 2), x.T @ x)


def test_pooling_is_isotonic():
    knots, levels = quality.pooled(np.arange(6.0), np.array([1, 0, 3, 2, 5, 5.0]), np.full(6, 5.0))
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) > 0).all()
