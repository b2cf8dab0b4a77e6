import hashlib
import zlib

import pytest

from cases import LOWER, SCHEMA, texts
from eventmere.llm import merkle
from pyspark.sql import functions as F
from tools.compare import differences

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and for each node its siblings and the fold of another value, by plain recursion."""
    if len(nodes) == 1:
        return nodes[0], [("", lambda v: v)]
    runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
    root, above = tree([sha("".join(r)) for r in runs])
    out = []
    for run, (proof, up) in zip(runs, above):
        for i in range(len(run)):
            left, right = "".join(run[:i]), "".join(run[i + 1 :])
            out.append((left + right + proof, lambda v, a=left, b=right, u=up: u(sha(a + v + b))))
    return root, out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in sources[name]])
    root, above = tree([trees[n][0] for n in names]) if names else (None, [])
    out = []
    for name, (high, up) in zip(names, above):
        for (_, _, own, r), (proof, fold) in zip(sources[name], trees[name][1]):
            used = own
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                used = leaf((*r[:4], r[4].translate(LOWER)))
            folded = up(fold(used))
            out.append((r[0], own, trees[name][0], root, sha(proof + high), folded, folded == root))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "clash") for r in rows], SCHEMA.replace("n_words string", "pos string"))
    got = merkle.manifest(docs, changed={"text": merkle.tampered_text()})
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_odd_rows(spark):
    rows = [(i, [None, "", "é", "s"][n % 4], None if n % 3 else "en", n if n % 5 else None, t) for n, (i, t) in enumerate(texts())]
    check(spark, rows + rows[:3])


def test_hot_source_many_sources_and_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SUPERBLOCK", 16)
    monkeypatch.setattr(merkle, "TASK_LEAVES", 64)
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(700)]
    rows += [(10_000 + i, f"s{i}", "en", 1, "A" * (i % 3)) for i in range(300)]
    rows += [(20_000 + i, "t", None, None, None) for i in range(17)] + [(5, "hot", "en", 5, "Text 5")] * 40
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, [(5, "s", "en", 1, "A")])
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(empty).count() == 0


def test_tampering_is_found_and_only_there(spark):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    other = F.when(F.col("doc_id") == 77, F.lit("forged")).otherwise(F.col("text"))
    found = merkle.manifest(docs, changed={"text": other}).collect()
    assert [r["doc_id"] for r in found if not r["verified"]] == [77]
    assert len({r["root"] for r in found}) == 1


@pytest.mark.parametrize("name", ["op11_merkle_manifest"])
def test_query_is_same_as_sql(spark, name):
    assert differences(spark, "/root/testdata/sf0.001", name) == ""
