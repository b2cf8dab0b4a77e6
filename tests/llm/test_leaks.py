import random

import numpy as np
import pyarrow as pa

from cases import LOWER, frame, prose, texts
from eventmere.llm import leaks


UPPER = {low: up for up, low in LOWER.items()}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = max(row[j], row[j + 1]) if x != y else last + 1, row[j + 1]
    return row[-1]


def test_common_subsequence_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
        assert leaks.common_length(a, b) == lcs(a.tolist(), b.tolist())


def test_recall_of_exact_and_edited_items(spark):
    rng = random.Random(5)
    items = [(i, " ".join(prose(500 + i, rng.randint(15, 150)))) for i in range(30)]
    docs, want = list(texts()), {}
    for i in range(120):
        body, item = prose(1000 + i, rng.randint(20, 300)), i % 30
        held = items[item][1].split()
        if i % 3 == 1:  # a paraphrase: some words replaced
            held = [w if rng.random() > 0.15 else "otherword" for w in held]
        at = rng.randrange(len(body))
        text = " ".join(body[:at] + (held if i % 3 < 2 else []) + body[at:])
        docs.append((1000 + i, text.translate(UPPER) if i % 2 else text))
        want[1000 + i] = {item} if i % 3 < 2 else set()
    benchmark = spark.createDataFrame([*[(*x, "y") for x in items], (77, None, "y"), (78, " ", "y")], "item_id long, text string, doc_id string")
    found = {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in leaks.find_leaks(frame(spark, docs), benchmark).collect()}
    hits = sum(bool(found[k] & v) for k, v in want.items() if v)
    assert hits >= 0.9 * sum(map(bool, want.values()))
    assert not any(found[k] for k, v in want.items() if not v) and not found[1] and not found[2]
    kept = leaks.keep_clean(frame(spark, docs), benchmark)
    assert kept.columns == frame(spark).columns and kept.count() >= len(docs) - 80


#: A space without words keeps nothing of a passage, so the exact bound chooses the candidates.
NO_SPACE = (np.zeros(0, np.uint64), np.zeros((0, 1), np.float32))


def test_exact_bound_finds_short_and_edited_items():
    rng = np.random.default_rng(11)
    mixed = lambda n: np.where(rng.random(n) < 0.4, np.minimum(rng.zipf(1.2, n), 20_000), rng.integers(0, 20_000, n))
    words = lambda n: ["w%d" % w for w in mixed(n)]
    items = [words(int(rng.integers(15, 60))) for _ in range(960)]
    docs, want = [], []
    for n in range(20):
        item = items[n * 13]
        held = [w if n % 2 or rng.random() > 0.25 else "other" for w in item]
        docs.append(" ".join(words(int(rng.integers(20, 100))) + held + words(40)))
        want.append(100 * lcs(item, held) >= leaks.LEAK_SHARE * len(item))
    rows = pa.table({"item_id": list(range(len(items))), "text": [" ".join(x) for x in items]})
    block = leaks.read_block(rows, *NO_SPACE, np.ones(leaks.TERMS))
    found = leaks.search(pa.array(docs), block, np.ones(leaks.TERMS))
    assert sum(want) > 12
    assert all(n * 13 in {x["item_id"] for x in found[n]} for n in range(20) if want[n])


def test_candidates_lose_no_place_that_is_accepted():
    rng = np.random.default_rng(12)
    words = lambda n, kinds=40: ["w%d" % w for w in rng.integers(0, kinds, n)]
    numbers = lambda ws: np.array([int(w[1:]) for w in ws], np.uint64)
    items = [words(n) for n in (1, 2, 3, 4, 5, 8, 15, 33, 64, 65, 100, 150)]
    texts_ = [" ".join(words(60, 400) + [w for w in items[i % 12] if rng.random() > 0.3] + words(i, 400)) for i in range(24)]
    rows = pa.table({"item_id": list(range(12)), "text": [" ".join(x) for x in items]})
    block = leaks.read_block(rows, *NO_SPACE, np.ones(leaks.TERMS))
    found = leaks.search(pa.array(texts_), block, np.ones(leaks.TERMS))
    for text, leaked in zip(texts_, found):
        held, got = text.split(), {x["item_id"]: x["common_words"] for x in leaked}
        for n, item in enumerate(items):
            regions = [held[max(0, s - 32) : s + max(96, len(item) + 32)] for s in range(0, len(held), 32)]
            common = [leaks.common_length(numbers(item), numbers(r)) for r in regions]
            answered = [" ".join(item[-5:]) in [" ".join(r[i : i + len(item[-5:])]) for i in range(len(r))] for r in regions]
            good = [c for c, a in zip(common, answered) if 10 * c >= 7 * len(item) or a and 2 * c >= len(item)]
            assert got.get(n) == max(good, default=None), (n, text)


def test_cosine_recall_on_a_benchmark_of_many_times_the_rank(spark, monkeypatch):
    rng = np.random.default_rng(21)
    mixed = lambda n: np.where(rng.random(n) < 0.4, np.minimum(rng.zipf(1.2, n), 20_000), rng.integers(0, 20_000, n))
    words = lambda n: ["w%d" % w for w in mixed(n)]
    items = [words(int(rng.integers(15, 60))) for _ in range(6000)]
    docs, want = [], {}
    for n in range(150):
        item = items[n * 37]
        held = [w if n % 3 == 0 or rng.random() > 0.25 else "other%d" % rng.integers(1000) for w in item] if n % 3 < 2 else []
        docs.append((n, " ".join(words(int(rng.integers(20, 100))) + held + words(40))))
        if held and 100 * lcs(item, held) >= leaks.LEAK_SHARE * len(item):
            want[n] = n * 37
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    monkeypatch.setattr(leaks, "index_words", lambda items, weights, real=leaks.index_words: real([x[:0] for x in items], weights))
    found = {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in leaks.find_leaks(frame(spark, docs), benchmark).collect()}
    hits = [want[n] in found[n] for n in want]
    assert len(found) == 150 and len(hits) > 80 and sum(hits) >= 0.9 * len(hits)
    assert sum(want[n] in found[n] for n in want if n % 3 == 0) >= 0.98 * sum(n % 3 == 0 for n in want)
    assert not any(found[n] for n in range(2, 150, 3))


def test_several_rounds_find_what_one_finds(spark, monkeypatch):
    items = [(i, " ".join(prose(500 + i, 12 + i))) for i in range(40)]
    docs = list(texts()) + [(2000 + i, " ".join(prose(3000 + i, 50)) + " " + items[i][1] + " " + items[(7 * i) % 40][1]) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    told = lambda: sorted(((r["doc_id"], r["text"], [x["item_id"] for x in r["leaks"]]) for r in leaks.find_leaks(frame(spark, docs), benchmark).collect()), key=str)
    once = told()
    monkeypatch.setattr(leaks, "PASSAGES", 8)
    monkeypatch.setattr(leaks, "ROUND_BLOCKS", 2)
    assert told() == once and len(once) == len(docs)
    assert all({i, (7 * i) % 40} <= set(x[2]) for i in range(40) for x in once if x[0] == 2000 + i)


def test_a_very_long_item_is_found(spark):
    item = prose(77, 4000)
    docs = [(1, " ".join(prose(5, 500) + item + prose(6, 300))), (2, " ".join(item[:1500])), (3, " ".join(prose(8, 5000)))]
    benchmark = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in leaks.find_leaks(frame(spark, docs), benchmark).collect()}
    assert found == {1: [9], 2: [], 3: []}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, " ".join(prose(9, 20)))], "item_id long, text string")
    assert leaks.find_leaks(frame(spark), none).filter("size(leaks) > 0").count() == 0
    assert leaks.find_leaks(frame(spark, []), some).count() == 0


def test_rows_of_each_owner_are_added_up():
    rng = np.random.default_rng(8)
    table = rng.normal(size=(50, 6)).astype(np.float32)
    sizes = rng.integers(0, 9, 300)
    owner, rows = np.repeat(np.arange(300), sizes), rng.integers(0, 50, sizes.sum())
    got = leaks._row_sums(table, rows, owner, 300)
    for n in range(300):
        np.testing.assert_allclose(got[n], table[rows[owner == n]].sum(0), atol=1e-5)
    assert not leaks._row_sums(table, rows[:0], owner[:0], 2).any()
