import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cases import frame, texts
from eventmere.llm import segments
from eventmere.llm.texts import mix

pytestmark = pytest.mark.skipif(not os.path.exists(segments.MODEL_FILE), reason="no vocabulary file")


def all_segmentations(text, words, pieces):
    data = (" " + text).encode()
    of = {p: i for i, p in enumerate(pieces) if p is not None and i not in set(words.byte_ids.tolist())}
    weight = dict(zip(words.ids.tolist(), words.weights.tolist()))
    found = []

    def go(at, ids, total):
        if at == len(data):
            found.append((tuple(ids), total))
        for end in range(at + 1, min(len(data), at + 25) + 1):
            if data[at:end] in of:
                i = of[data[at:end]]
                go(end, ids + [i], total + weight[i])

    go(0, [], 0.0)
    z = math.log(sum(math.exp(t) for _, t in found))
    return {ids: t - z for ids, t in found}


def test_samples_follow_the_distribution():
    words, pieces = segments.read_vocabulary(), segments.piece_bytes()
    exact = all_segmentations("hello the", words, pieces)
    n, k = 3000, 3
    column, keys = pa.array(["hello the"] * n), mix(np.arange(n, dtype=np.uint64))
    first, estimate = Counter(), Counter()
    for samples in segments.sample_texts(column, keys, words, k):
        ids = [tuple(s[0].tolist()) for s in samples]
        assert len(set(ids)) == k
        first[ids[0]] += 1
        for i, (_, total, inclusion) in zip(ids, samples):
            assert total == pytest.approx(exact[i], abs=1e-6)
            estimate[i] += 1 / inclusion / n
    for ids in sorted(exact, key=lambda i: -exact[i])[:4]:
        assert first[ids] / n == pytest.approx(math.exp(exact[ids]), abs=0.03)
        assert estimate[ids] == pytest.approx(1, abs=0.15)
    # Weighted by inclusion, the samples of a row estimate sums over all segmentations.
    assert sum(math.exp(exact[i]) * c for i, c in estimate.items()) == pytest.approx(1, abs=0.02)


def test_few_segmentations_are_all_given():
    words = segments.read_vocabulary()
    [samples] = segments.sample_texts(pa.array(["q"]), np.array([5], np.uint64), words, 50)
    assert len(samples) == len(all_segmentations("q", words, segments.piece_bytes()))
    assert all(s[2] == 1.0 for s in samples)


def test_round_trip_and_odd_cases(spark):
    rows = texts() + [(50, " two  spaces ▁ mark \x00 漢字 😀\r\n "), (51, "   "), (52, "<s> [UNK] <0x41>")]
    got = segments.sample_segments(frame(spark, rows), k=3)
    decoded = got.select("*", got["segments"][0]["ids"].alias("ids"))
    for row in segments.decode_segments(decoded, into="again").collect():
        assert row["round_trip"] and row["again"] == (row["text"] or "")
        assert len({s["ids_sha256"] for s in row["segments"]}) == len(row["segments"]) and row["n_words"] == "clash"
    assert segments.sample_segments(frame(spark, [])).count() == 0


def test_draws_do_not_depend_on_neighbours(spark):
    whole = segments.sample_segments(frame(spark)).select("doc_id", "text", "segments").collect()
    alone = segments.sample_segments(frame(spark).repartition(7, "text")).select("doc_id", "text", "segments").collect()
    assert sorted(map(str, whole)) == sorted(map(str, alone))


def test_tree_of_pieces():
    pieces = [b" a", b"ab", b"a", b"abc", b"b\xc3\xa9", b" "]
    column, child, piece = segments._tree(pieces)
    for n, own in enumerate(pieces):
        node = 0
        for byte in own:
            assert node < len(child)
            node = child[node, column[byte]]
        assert piece[node] == n
    assert child[0, column[ord("c")]] == 0 and column[ord("x")] == 0 and not child[:, 0].any()


def test_vocabulary_is_read_once_by_a_process():
    assert segments.read_vocabulary() is segments.read_vocabulary()
