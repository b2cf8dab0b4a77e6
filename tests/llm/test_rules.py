from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cases import WORDS, frame, prose, texts, words
from eventmere.llm import rules, statistics
from eventmere.llm.statistics import with_statistics


def brute(text):
    text = text or ""
    w = words(text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = {r for r, c in Counter(runs).items() if c > 1}
    repeated = {i + j for i, r in enumerate(runs) if r in twice for j in range(8)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(repeated)]


def test_statistics_against_brute_force(spark):
    for row in with_statistics(frame(spark), "s").collect():
        assert list(row["s"])[:5] == brute(row["text"])
    assert with_statistics(frame(spark, []), "s").count() == 0


def test_judging_and_odd_cases(spark):
    rows = texts() + [(100 + i, " ".join(prose(100 + i, 60))) for i in range(60)]
    rows += [(200 + i, " ".join(x + "%%%" for x in prose(300 + i, 60))) for i in range(60)]
    labels = [(i, 1, "x") for i in range(100, 160)] + [(i, 0, "x") for i in range(200, 260)] + [(100, None, "x"), (None, 0, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    measured = with_statistics(frame(spark, rows), rules.STATS, keep_text=False)
    got = {r["doc_id"]: r for r in rules.judge(measured, labels).collect()}
    assert all(got[i]["kept"] for i in range(100, 160)) and not any(got[i]["kept"] for i in range(200, 260))
    assert not any(got[i]["kept"] for i in (1, 2, 3, 4, 11)) and all(got[i]["base_failed"] for i in (1, 2, 3, 4, 11))
    kept = rules.keep_good(frame(spark, rows), labels)
    assert kept.columns == frame(spark).columns and 1 not in [r["doc_id"] for r in kept.collect()]
    none = labels.filter("quality > 5")
    assert rules.judge(measured, none).filter(F.col("kept") == F.col("base_failed")).count() == 0


def test_learned_list_is_precise_and_ordered():
    rng = np.random.default_rng(0)
    rows = {f: rng.random(6000) for f in rules.RATIOS}
    bad = (rows["upper_share"] > 0.9) | ((rows["words"] < 0.3) & (rows["digit_share"] > 0.7))
    found = rules.fit(rows, bad)
    verdict = np.zeros(6000, bool)
    for rule in found:
        verdict |= rules._holds(rule, rows, 6000)
    assert (verdict & ~bad).sum() <= 0.03 * verdict.sum() and (verdict & bad).sum() > 0.9 * bad.sum()
    assert all(len(r) <= rules.MAX_CONDITIONS for r in found)


def test_statistics_names_are_fixed():
    assert statistics.NAMES[:5] == ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
