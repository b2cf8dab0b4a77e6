import random

import numpy as np

import corpus_pipeline
from cases import LOWER, frame, prose, texts, words
from eventmere.llm import near
from eventmere.llm.components import components


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if same or (rows[i][0] is not None and rows[j][0] is not None and either and sets[i] and sets[j] and 100 * both >= 85 * either):
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[find(i)] = min((k for k in (low.get(find(i)), key) if k is not None), default=None)
    return sorted([(k, len(s), low[find(i)]) for i, ((k, _), s) in enumerate(zip(rows, sets))], key=str)


def check(spark, rows):
    got = near.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_odd_cases(spark):
    check(spark, texts())
    assert near.near_duplicates(frame(spark, [])).count() == 0


def test_edited_copies_chains_and_a_common_passage(spark):
    rng, rows, passage = random.Random(7), [], prose(99, 70)
    for group in range(4):
        origin = prose(group, rng.choice([30, 120, 400]))
        for _ in range(12):
            copy = list(origin)
            for _ in range(rng.randint(0, len(copy) // 50 + 1)):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(10**6)
            rows.append((len(rows), " ".join(copy)))
            origin = copy if rng.random() < 0.3 else origin  # copies of copies drift away
    for _ in range(25):
        rows.append((len(rows), " ".join(passage + prose(1000 + len(rows), rng.randint(5, 60)))))
    check(spark, rows)


def test_union_sketch_never_rejects_a_similar_pair():
    rng = np.random.default_rng(1)
    for size in (5, 100, 1000, 5000):
        for _ in range(50):
            base = rng.permutation(np.unique(rng.integers(0, 2**63, size).astype(np.uint64)))
            a, b = np.sort(base[: -max(1, size // 14)]), np.sort(base[max(1, size // 14) :])
            exact = 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
            assert near.similar(a, b) == exact


def test_pipeline_links_pairs_from_80_percent(spark):
    rows = []
    for group, size in enumerate((44, 204, 1004)):
        origin = prose(700 + group, size)
        for parts in (8, 9, 10):  # a part of the shingles differs in each of the two
            copy = ["g%d%s" % (parts, w) for w in origin]
            fresh = ["new%d" % i for i in range((size - 4) // parts)]
            rows += [(len(rows), " ".join(copy)), (len(rows) + 1, " ".join(copy[: size - len(fresh)] + fresh))]
    near_by = []
    for i in range(0, len(rows), 2):
        a, b = shingles(rows[i][1]), shingles(rows[i + 1][1])
        near_by.append(100 * len(a & b) / len(a | b))
    assert any(80 <= x < 85 for x in near_by) and any(x < 80 for x in near_by)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect()}
    assert kept == {i for i in range(0, len(rows), 2)} | {2 * n + 1 for n, x in enumerate(near_by) if x < 80}


def test_least_shared_follows_the_percent():
    assert near.least_shared(85) == 84 and near.least_shared(80) == 76
    assert near.prefix_length(np.array([500]), percent=80) == 53 and near.prefix_length(np.array([100]), percent=80) == 21


def test_keep_one_keeps_columns_and_one_of_each(spark):
    kept = near.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and 13 not in ids and 5 not in ids and None in ids


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(i, 0) for i in range(21)} | {(i, 100) for i in range(100, 120)}
