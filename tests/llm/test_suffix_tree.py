import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from cases import LOWER, frame, prose, texts, words
from eventmere.llm import shared, suffix_tree
from eventmere.llm.texts import read_words


def test_base_scores_against_brute_force(spark):
    rows = texts()
    got = suffix_tree.score_documents(frame(spark)).collect()
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    tokens = [(k, held(k), words((t or "").translate(LOWER))) for k, t in rows]
    counts, ends = Counter(), 0
    for _, out, w in tokens:
        if not out:
            counts.update(w)
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    want = []
    for key, out, w in tokens:
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((ends + 1) / (total + kinds + 1))
        want.append((str(key), out, len(w) + 1, sum(x in counts for x in w) + 1, total, round(base, 6)))
    found = [(str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got]
    assert sorted(found) == sorted(want)
    assert all(r["score"] < 0 for r in got)


def symbols(text):
    out = []
    for word in words((text or "").translate(LOWER)):
        out += [*(b + 2 for b in word.encode()), 0]
    return [*out, 1]


def brute_chance(trained, least, gain, depth, prior=16.0):
    """A function of a context (oldest first) and a symbol, by the definition, from plain counts."""
    counts = [Counter() for _ in range(depth + 1)]
    for text in trained:
        line = [0] * depth + symbols(text)
        for at in range(depth, len(line)):
            for level in range(depth + 1):
                counts[level][tuple(line[at - level : at]), line[at]] += 1
    after = [{} for _ in counts]
    for level, own in enumerate(counts):
        for (context, symbol), n in own.items():
            after[level].setdefault(context, {})[symbol] = n
    total = sum(counts[0].values())

    def chance(context, symbol):
        if not context:
            return (counts[0][(), symbol] + 1) / (total + 258)
        below = chance(context[1:], symbol)
        own = after[len(context)].get(context, {})
        seen = sum(own.values())
        if seen < least or sum(n * math.log(n / seen / chance(context[1:], s)) for s, n in own.items()) < gain:
            return below
        return (own.get(symbol, 0) + prior * below) / (seen + prior)

    return chance


def test_scores_against_a_plain_tree(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "LEAST_COUNT", 20)
    monkeypatch.setattr(suffix_tree, "LEAST_GAIN", 10.0)
    monkeypatch.setattr(shared, "block_count", lambda *a: 5)
    rows = [(i, " ".join(prose(i % 4, 25) + prose(100 + i, 5))) for i in range(30)] + [(50, None), (51, "Zz \u65e5\u672c x"), (None, "no id")]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    trained = [t for k, t in rows if not held(k)]
    chance = brute_chance(trained, 20, 10.0, suffix_tree.DEPTH)
    seen = Counter(w for t in trained for w in words((t or "").translate(LOWER)))
    tokens, kinds = sum(seen.values()) + len(trained), len(seen) + 1
    want = {}
    for key, text in rows:
        line, at, score = [0] * suffix_tree.DEPTH + symbols(text), suffix_tree.DEPTH, 0.0
        for word in [*words((text or "").translate(LOWER)), None]:
            size = 1 if word is None else len(word.encode()) + 1
            spelling = sum(math.log(chance(tuple(line[i - suffix_tree.DEPTH : i]), line[i])) for i in range(at, at + size))
            n = len(trained) if word is None else seen[word]
            score += math.log10((n + kinds * math.exp(spelling)) / (tokens + kinds))
            at += size
        want[key] = score
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_documents(frame(spark, rows)).collect()}
    assert set(got) == set(want)
    for key, score in want.items():
        assert math.isclose(got[key], score, rel_tol=1e-4), key


def test_states_help_and_are_distributions(spark):
    rows = [" ".join(prose(i % 3, 60)) for i in range(60)]
    read = read_words(pa.array(rows), lower=True)
    grams = Counter(suffix_tree.grams_of(*suffix_tree.symbols_of(read)).tolist())
    asked = {c << 9 | s for c in {g >> 9 for g in list(grams)[:5]} for s in range(258)} - set(grams)
    table = spark.createDataFrame([(g, n, 0) for g, n in grams.items()] + [(g, 0, 0) for g in asked], "gram long, n long, bucket int")
    found = {r["gram"]: r["chance"] for r in suffix_tree.chances(table).collect()}
    for context in {g >> 9 for g in list(grams)[:5]}:
        assert math.isclose(sum(10.0 ** found[context << 9 | s] for s in range(258)), 1, abs_tol=1e-6)
    flat = Counter(g & 511 for g in grams.elements())
    total = sum(flat.values())
    assert sum(n * found[g] for g, n in grams.items()) > sum(n * math.log10((n + 1) / (total + 258)) for n in flat.values())


def test_very_unlikely_words_keep_their_score():
    far = suffix_tree.blended(np.array([0, 0, 5]), np.array([-400.0, -900.0, -900.0]), 100, 10)
    assert np.allclose(far, [-400 + 1 - math.log10(110), -900 + 1 - math.log10(110), math.log10(5 / 110)])


def test_contexts_stop_at_the_start_of_a_text():
    one = suffix_tree.symbols_of(read_words(pa.array(["e"])))
    two = suffix_tree.symbols_of(read_words(pa.array(["ab cd", "e", ""])))
    tail = suffix_tree.grams_of(*two)[two[1][1] : two[1][2]]
    assert tail.tolist() == suffix_tree.grams_of(*one).tolist()


def test_empty_table(spark):
    assert suffix_tree.score_documents(frame(spark, [])).count() == 0


def test_only_distinct_grams_are_sorted(monkeypatch):
    column = pa.array([" ".join(prose(n % 5, 300)) for n in range(40)] + [None, ""] + [t for _, t in texts()])
    held = np.arange(len(column)) % 3 == 0
    sorted_lengths, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *args, **named: sorted_lengths.append(len(a)) or argsort(a, *args, **named))
    parts, (keys, _, counts) = suffix_tree._block_grams(column, held)
    symbols, begins = suffix_tree.symbols_of(read_words(column, lower=True))
    spread = suffix_tree.grams_of(symbols, begins) * suffix_tree.SPREAD
    assert max(sorted_lengths) < len(symbols) / 2
    ((own, place, _),) = parts
    assert np.array_equal(own[place], spread) and np.array_equal(own, np.unique(spread)) and np.array_equal(keys, own)
    learned = Counter(spread[np.repeat(~held, np.diff(begins))].tolist())
    assert [learned[k] for k in keys.tolist()] == counts.tolist()
    parts, (keys, _, counts) = suffix_tree._block_grams(column[:0], held[:0])
    assert not parts and not len(keys) and not len(counts)
    parts, (keys, _, counts) = suffix_tree._block_grams(pa.array([None, ""]), np.array([False, True]))
    assert len(keys) == 1 and counts.tolist() == [1]
