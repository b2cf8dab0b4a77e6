"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct five-word shingles; its sketch
is the ``SKETCH`` smallest of them. Two sets of high similarity share most of
the smallest hashes of their union, and every shared one of these lies in both
sketches. So inverted lists of sketch values find all similar pairs:

- Equal word sequences are one class first; only the class's smallest document
  goes on. Thousands of copies are one row from there.
- Similar sketches share so many values that they must meet in one of their
  rarest ones. Only these prefixes of each sketch, ordered by how many documents
  hold a value, are listed. Values of a common passage are rarely among them.
- A list is joined with one pivot, not with itself: its member with the commonest
  values, which is the origin of many edited copies. Each document is compared with
  the pivot it meets most often, and similar documents become one component.
- Only documents that share a list but are still in different components go on, as
  a link inside one component can change nothing. They are listed anew by their
  whole sets, whose prefixes are exact, compared with pivots again, and what is then
  still apart is compared with each other where the places of a shared value allow it.
- A pair is dropped if the union sketch says it cannot be similar, otherwise
  confirmed on the full sets.

The shared values of two sketches are a random sample of their sets: for a pair at
the threshold fewer than ``least_shared`` of the 128 smallest values are common
with a probability below 1e-7; at 85 percent, documents of up to 108 shingles are
compared by complete sets, which is exact.

Cases: texts without words and null texts have an empty set and are linked with
nothing; a text of one to four words is one shingle; rows with the same id are
one node; rows without an id are linked with nothing; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import shared
from eventmere.llm.components import components
from eventmere.llm.texts import Words, read_words, run_hashes, sequence_hashes, slices, text_column, whole_runs, word_hashes

SHINGLE = 5
SKETCH = 128
PERCENT = 85
#: Chance that two documents at the threshold share fewer sketch values than are asked for.
LEAST_CHANCE = 1e-7
#: A sketch that is the whole set, of any size.
WHOLE = 1 << 40


@cache
def least_shared(percent: int) -> int:
    """Shared sketch values of two documents at the threshold, at the very least; a union sketch with fewer is not similar."""
    share, below = percent / 100, 0.0
    for k in range(SKETCH + 1):
        below += math.comb(SKETCH, k) * share**k * (1 - share) ** (SKETCH - k)
        if below >= LEAST_CHANCE:
            break
    if k < 2:
        raise ValueError(f"sketches of {SKETCH} values are too short for a similarity of {percent} percent")
    return k - 1


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in ascending order."""
    hashes = word_hashes(words)
    whole = whole_runs(words, SHINGLE)
    runs = run_hashes(hashes, SHINGLE)
    sequences = sequence_hashes(words, hashes)
    found = []
    for i, (first, last) in enumerate(zip(words.first[:-1], words.first[1:])):
        if last - first >= SHINGLE:
            values = np.sort(runs[first : last - SHINGLE + 1])
            new = np.ones(len(values), bool)
            np.not_equal(values[1:], values[:-1], out=new[1:])
            found.append(values[new])
        else:
            found.append(sequences[i : i + 1] if last > first else sequences[:0])
    assert len(runs) == len(whole)
    return found


def prefix_length(size: np.ndarray, sketch: int = SKETCH, percent: int = PERCENT) -> np.ndarray:
    """Of the rarest sketch values of a set, how many must be listed to meet every similar sketch."""
    complete = size - -(-percent * size // 100) + 1
    sampled = np.minimum(size, sketch) - least_shared(percent) + 1
    return np.where(100 * size <= percent * sketch, complete, sampled)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets (ascending hashes) are similar: union sketch first, then exactly."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    head = np.sort(np.concatenate((a[:SKETCH], b[:SKETCH])))
    new = np.append(True, head[1:] != head[:-1])
    lowest = head[new][:SKETCH]
    both = np.count_nonzero(~new[: np.searchsorted(head, lowest[-1], side="right")])
    if both * SKETCH < least_shared(percent) * len(lowest):
        return False
    merged = np.sort(np.concatenate((a, b)))
    common = np.count_nonzero(merged[1:] == merged[:-1])
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketches(docs: DataFrame) -> DataFrame:
    """Set size, class key and sketch of every document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch, "_text")
            for start, stop in slices(column):
                words = read_words(column[start:stop], lower=True)
                sets, hashes = shingle_sets(words), word_hashes(words)
                keys = [pa.array(sequence_hashes(words, hashes, k).view(np.int64), pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id")[start:stop],
                        pa.array([len(s) for s in sets], pa.int64()),
                        *keys,
                        pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()),
                    ],
                    ["_id", "n", "k0", "k1", "sketch"],
                )

    return docs.mapInArrow(shared.given_back(sketch), "_id long, n long, k0 long, k1 long, sketch binary")


def _lists(sets: DataFrame, blocks: int, sketch: int, percent: int) -> DataFrame:
    """Listed values that two or more documents hold, of sets or sketches ``s`` (``id``, ``n``).

    ``common`` says how common a document's values are on average: the origin of
    many edited copies has the highest. ``place`` counts the rarer values before.
    """

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [np.frombuffer(s, "<u8")[:sketch] for s in batch.column("s").to_pylist()]
            lengths = [len(s) for s in sketches]
            values = np.concatenate(sketches) if sketches else np.zeros(0, np.uint64)
            ids = np.repeat(np.asarray(batch.column("id")), lengths)
            sizes = np.repeat(np.asarray(batch.column("n")), lengths)
            # A value's bucket comes from its low bits: sketch values are small.
            bucket = (values % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else np.zeros(0, int)
            parts = [order[i:j] for i, j in zip(heads, np.append(heads[1:], len(order)))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[order[heads]] if len(order) else [], pa.int32()),
                    pa.array([values[p].tobytes() for p in parts], pa.binary()),
                    pa.array([ids[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                    pa.array([sizes[p].astype("<i4").tobytes() for p in parts], pa.binary()),
                ],
                ["bucket", "v", "i", "n"],
            )

    def held_twice(table: pa.Table) -> pa.Table:
        read = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        values, ids, sizes = read("v", "<u8"), read("i", "<i8"), read("n", "<i4")
        order = np.argsort(values, kind="stable")
        values = values[order]
        heads = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        held = np.diff(np.append(heads, len(values)))
        held = np.repeat(held, held)
        twice = held > 1
        chosen = order[twice]
        return pa.table(
            {
                "block": pa.array((ids[chosen] % blocks).astype(np.int32), pa.int32()),
                "value": pa.array(values[twice].view(np.int64), pa.int64()),
                "held": pa.array(held[twice], pa.int64()),
                "id": pa.array(ids[chosen], pa.int64()),
                "n": pa.array(sizes[chosen].astype(np.int64), pa.int64()),
            }
        )

    def rarest(table: pa.Table) -> pa.Table:
        value, held, ids, n = (np.asarray(table.column(c)) for c in ("value", "held", "id", "n"))
        order = np.lexsort((value, held, ids))
        ids = ids[order]
        heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        counts = np.diff(np.append(heads, len(ids)))
        rank = np.arange(len(ids)) - np.repeat(heads, counts)
        size = n[order]
        alone = np.minimum(size, sketch) - np.repeat(counts, counts)
        common = np.repeat(np.add.reduceat(held[order], heads), counts) / np.minimum(size, sketch)
        listed = rank < prefix_length(size, sketch, percent) - alone
        out = table.select(["value", "id", "n"]).take(pa.array(order[listed]))
        out = out.append_column("common", pa.array(common[listed], pa.float64()))
        return out.append_column("place", pa.array((rank + alone)[listed], pa.int64()))

    sent = sets.select("id", "n", "s").mapInArrow(shared.given_back(invert), "bucket int, v binary, i binary, n binary")
    twice = sent.groupBy("bucket").applyInArrow(shared.group_given_back(held_twice), "block int, value long, held long, id long, n long")
    return twice.groupBy("block").applyInArrow(shared.group_given_back(rarest), "value long, id long, n long, common double, place long")


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Full shingle sets of some documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch, "_text")
            for start, stop in slices(column):
                sets = shingle_sets(read_words(column[start:stop], lower=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id")[start:stop],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["id", "n", "s"],
                )

    return docs.join(ids, docs["_id"] == ids["id"], "left_semi").mapInArrow(shared.given_back(read), "id long, n long, s binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The similar ones of some pairs ``a``, ``b``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            good = [
                similar(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), percent) for x, y in zip(sa, sb)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda side: sets.select(F.col("id").alias(side), F.col("s").alias(f"s{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb").mapInArrow(shared.given_back(check), "a long, b long")


def _compatible(n: str, m: str, percent: int):
    return (100 * F.col(n) >= percent * F.col(m)) & (100 * F.col(m) >= percent * F.col(n))


def _with_pivots(lists: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Each document and, of the pivots of its lists outside its component, the one it meets most often."""
    lists = lists.join(placed, "id")
    pivot = F.max(F.struct("common", -F.col("id"), "id", "n", "c")).alias("p")
    pivots = lists.groupBy("value").agg(pivot, F.count("*").alias("size")).filter("size > 1")
    met = lists.join(pivots, "value").filter("c <> p.c").filter(_compatible("n", "p.n", percent))
    met = met.groupBy(F.col("id").alias("a"), F.col("p.id").alias("b")).agg(F.count("*").alias("times"))
    return met.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))


def _towards_pivots(links: DataFrame) -> DataFrame:
    """A provisional component ``c`` of each ``id``: the pivot of its pivot, or its pivot."""
    up = links.select(F.col("a").alias("b"), F.col("b").alias("top"))
    return links.join(up, "b", "left").select(F.col("a").alias("id"), F.coalesce("top", "b").alias("c"))


def _apart(lists: DataFrame, placed: DataFrame) -> DataFrame:
    """The lists whose members are not all in one component."""
    lists = lists.join(placed, "id")
    mixed = lists.groupBy("value").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("value")
    return lists.join(mixed, "value", "left_semi")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``class_id``, ``component_id`` and ``kept`` of every document.

    ``percent`` is the least similarity.
    """
    least_shared(percent)  # Raises if sketches are too short.
    docs = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    blocks = max(shared.shuffle_partitions(docs.sparkSession), shared.block_count(docs, "_text"))
    rows = shared.stored(_sketches(docs), "sketches")

    classes = rows.filter("n > 0").groupBy("k0", "k1").agg(F.min("_id").alias("class_id"))
    # An empty set is a class of its own, as are rows of the same id.
    members = rows.select("_id", "n", "k0", "k1").join(classes, ["k0", "k1"], "left")
    members = members.select("_id", "n", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("_id")).alias("class_id"))
    members = shared.stored(members, "classes")

    firsts = classes.filter("class_id is not null").select(F.col("class_id").alias("_id"), "k0", "k1")
    representatives = rows.filter("n > 0").join(firsts, ["_id", "k0", "k1"], "left_semi")
    representatives = representatives.select(F.col("_id").alias("id"), "n", F.col("sketch").alias("s"))
    lists = shared.stored(_lists(representatives, blocks, SKETCH, percent).distinct(), "lists")
    sets = shared.stored(_sets_of(docs, lists.select("id").distinct()), "sets")

    # First every document and the pivot it meets most often.
    alone = lists.select("id", F.col("id").alias("c")).distinct()
    pairs = _with_pivots(lists, alone, percent)
    links = shared.stored(_confirmed(pairs, sets, percent), "confirmed")
    placed = alone.drop("c").join(_towards_pivots(links), "id", "left").select("id", F.coalesce("c", "id").alias("c"))

    # Documents in a list with others that are still apart: whole sets, shorter lists.
    apart = _apart(lists, placed).select("id").distinct()
    whole = sets.join(apart, "id", "left_semi")
    lists = shared.stored(_lists(whole, blocks, WHOLE, percent).distinct(), "lists")
    more = shared.stored(_confirmed(_with_pivots(lists, placed, percent), sets, percent), "confirmed")
    links = links.unionByName(more)
    found = components(links)

    # What is left is compared with each other.
    placed = placed.drop("c").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("c"))
    left = _apart(lists, placed)
    right = left.select("value", F.col("id").alias("b"), F.col("n").alias("m"), F.col("c").alias("d"), F.col("place").alias("at"))
    # Of the first value two sets share, neither may have more before it than a similar pair leaves over.
    needed = F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / (100 + percent))
    near_enough = (F.col("place") <= F.col("n") - needed) & (F.col("at") <= F.col("m") - needed)
    pairs = left.join(right, "value").filter("id > b and c <> d").filter(near_enough)
    pairs = shared.stored(pairs.select(F.col("id").alias("a"), "b").distinct(), "pairs")
    last = shared.stored(_confirmed(pairs, sets, percent), "confirmed")
    found = components(links.unionByName(last))

    joined = members.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.coalesce("component", "class_id")
    return joined.select(
        F.col("_id").alias(key),
        F.col("n").alias("n_shingles"),
        "class_id",
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates of smaller id, with their own columns.

    Only ids that go are joined. Repeated rows of one id and text are one document;
    of those one row stays.
    """
    found = near_duplicates(docs, key, text, percent)
    gone = found.filter(~F.col("kept")).select(F.col(key).cast("long").alias("__gone")).distinct()
    left = docs.join(gone, F.col(key).cast("long") == F.col("__gone"), "left_anti")
    repeated = docs.filter(F.col(key).isNotNull()).groupBy(key, F.xxhash64(text).alias("__text")).agg(F.count("*").alias("c"))
    repeated = repeated.filter("c > 1").select(F.col(key).alias("__again")).distinct()
    if repeated.isEmpty():
        return left
    again = left.join(repeated, F.col(key) == F.col("__again"), "left_semi").dropDuplicates([key, text])
    return left.join(repeated, F.col(key) == F.col("__again"), "left_anti").unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[p:p + 4] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach AS (
  SELECT a AS doc_id, a AS r FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
), low AS (
  SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.r, d.doc_id) AS component_id,
  d.doc_id = coalesce(low.r, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
