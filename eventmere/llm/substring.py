"""Removal of word passages that occur more than once in a corpus.

A passage of ``window`` words that also starts anywhere else is removed wherever
it stands. Hashing every window of a corpus would send one key per word through
the network. Instead only shorter *anchors* at cover positions are hashed: the
positions of a document, taken modulo a period, that belong to a difference
cover. For any two places of an equal window some shift brings both to cover
positions, so they share an aligned anchor inside the window. Anchors that occur
twice are then extended: only windows around them are compared in full, by
128-bit hashes counted over the corpus. No pair of places is ever made, so a
passage in a third of all documents costs each block of documents one entry.

Cases: a null text has no words; texts shorter than a window are kept; repeated
rows are documents of their own, so their windows count as repeats; rows with
equal ids stay separate; an empty table gives an empty result; other columns of
the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import exchange, shared
from eventmere.llm.texts import Words, read_words, run_hashes, slices, text_column, whole_runs, word_hashes

#: A perfect difference cover: every difference modulo the period occurs.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)

_IS_COVER = np.isin(np.arange(PERIOD), COVER)
DONE, PENDING, KEYS = 0, 1, 2


def anchor_length(window: int) -> int:
    """Words of an anchor: it fits into the window at each of ``PERIOD`` shifts."""
    if window <= PERIOD:
        raise ValueError(f"windows must be longer than {PERIOD} words")
    return window - PERIOD + 1


def _anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the anchors of documents that have a window."""
    length = anchor_length(window)
    whole = whole_runs(words, length)
    count = len(whole)
    long = np.repeat(words.counts >= window, words.counts)[:count]
    at = np.flatnonzero(whole & long & _IS_COVER[words.place[:count] % PERIOD])
    return at, run_hashes(hashes, length)[at]


def _window_keys(hashes: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of the windows that start at some words."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return run_hashes(hashes, window, 0)[at], run_hashes(hashes, window, 1)[at]


def _candidates(words: Words, hashes: np.ndarray, window: int, at: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Starts of the windows that contain one of the anchors ``at`` that was ``found`` twice."""
    reached = np.zeros(len(hashes) + 1, np.int32)
    reached[at[found] + 1] = 1
    reached = np.cumsum(reached, dtype=np.int32)
    whole = whole_runs(words, window)
    starts = np.arange(len(whole))
    return np.flatnonzero(whole & (reached[starts + PERIOD] > reached[starts]))


def _kept_texts(words: Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    data = words.data.copy()
    change = np.zeros(len(data) + 1, np.int8)
    change[words.starts[kept]] += 1
    change[words.ends[kept]] -= 1
    chosen = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    places = np.flatnonzero(kept)
    text_of = words.text_of[places]
    if len(places):
        between = places[np.append(text_of[1:] == text_of[:-1], False)]
        data[words.ends[between]] = 0x20
        chosen[words.ends[between]] = True
    reached = np.zeros(len(data) + 1, np.int64)
    np.cumsum(chosen, out=reached[1:])
    offsets = reached[words.offsets]
    out = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[chosen].tobytes())
    )
    return out.cast(pa.string())


def _covered(words: Words, starts: np.ndarray, window: int) -> np.ndarray:
    """Words that lie in a window starting at one of ``starts``."""
    change = np.zeros(len(words.starts) + 1, np.int32)
    change[starts] += 1
    np.subtract.at(change, starts + window, 1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_removed`` and ``kept_text`` of every document."""
    anchor_length(window)  # too short a window is refused at once
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    key_type = docs.schema["_key"].dataType
    blocks = shared.block_count(docs, "_text")
    tagged = docs.withColumn("block", shared.block_of(blocks, "_key", "_text"))

    def anchors_of(column: pa.Array):
        """Words, hashes and anchors of each slice, and the block's distinct anchors."""
        parts = []
        for start, stop in slices(column):
            words = read_words(column[start:stop])
            hashes = word_hashes(words)
            parts.append((start, stop, words, hashes, *_anchors(words, hashes, window)))
        merged = np.concatenate([p[-1] for p in parts]) if parts else np.zeros(0, np.uint64)
        return parts, exchange.grouped(merged, np.zeros_like(merged))

    def send_anchors(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return exchange.send(keys[0].as_py(), *anchors_of(text_column(table, "_text"))[1], blocks)

    sent = tagged.groupBy("block").applyInArrow(send_anchors, exchange.SENT_DDL)
    answers = exchange.answers(sent)
    answers = shared.stored(answers, "anchors")

    part_ddl = f"kind int, _key {key_type.simpleString()}, n_words long, _text string, spots binary, {exchange.SENT_DDL}"

    def extend(keys: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        block, column, ids = keys[0].as_py(), text_column(table, "_text"), text_column(table, "_key")
        rows, firsts, seconds = [], [], []
        parts, (distinct, zeros, _) = anchors_of(column)
        known = exchange.Totals(found, distinct, zeros)
        for start, stop, words, hashes, at, anchors in parts:
            twice = known.of(anchors, np.zeros_like(anchors)) > 1
            at = _candidates(words, hashes, window, at, twice)
            first, second = _window_keys(hashes, at, window)
            firsts.append(first)
            seconds.append(second)
            near = np.zeros(len(words.starts), bool)
            near[at] = True
            texts = _kept_texts(words, np.ones(len(words.starts), bool))
            rows.append(_part_rows(ids[start:stop], words, texts, near, block))
        merged = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (firsts, seconds)]
        out = exchange.send(block, *exchange.grouped(*merged), blocks)
        return pa.concat_tables([*rows, _key_rows(out, key_arrow(table))])

    def key_arrow(table: pa.Table) -> pa.DataType:
        return table.schema.field("_key").type

    split = tagged.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(extend, part_ddl)
    split = shared.stored(split, "windows")

    sent_keys = split.filter(F.col("kind") == KEYS).select("bucket", "block", "keys", "counts")
    answers = exchange.answers(sent_keys)
    pending = split.filter(F.col("kind") == PENDING).select("_key", "_text", "spots", "block")

    def remove(keys: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        column, ids = text_column(table, "_text"), text_column(table, "_key")
        spots, parts, rows = table.column("spots").to_pylist(), [], []
        for start, stop in slices(column):
            words = read_words(column[start:stop])
            near = [np.unpackbits(np.frombuffer(b, np.uint8), count=c) for b, c in zip(spots[start:stop], words.counts)]
            at = np.flatnonzero(np.concatenate(near))
            parts.append((start, stop, words, at, *_window_keys(word_hashes(words), at, window)))
        merged = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64) for i in (-2, -1)]
        known = exchange.Totals(found, *exchange.grouped(*merged)[:2])
        for start, stop, words, at, first, second in parts:
            repeated = at[known.of(first, second) > 1]
            gone = _covered(words, repeated, window)
            rows.append(
                pa.table(
                    {
                        "_key": ids[start:stop],
                        "n_words": pa.array(words.counts, pa.int64()),
                        "n_removed": pa.array(np.bincount(words.text_of[gone], minlength=stop - start), pa.int64()),
                        "_text": _kept_texts(words, ~gone),
                    }
                )
            )
        return pa.concat_tables(rows) if rows else _empty(key_arrow(table))

    out_ddl = f"_key {key_type.simpleString()}, n_words long, n_removed long, _text string"
    removed = pending.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(remove, out_ddl)
    whole = split.filter(F.col("kind") == DONE).select("_key", "n_words", F.lit(0).cast("long").alias("n_removed"), "_text")
    return whole.unionByName(removed).select(
        F.col("_key").alias(key), "n_words", "n_removed", F.col("_text").alias("kept_text")
    )


def _empty(key_type: pa.DataType) -> pa.Table:
    fields = [("_key", key_type), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("_text", pa.string())]
    return pa.schema(fields).empty_table()


def _part_rows(ids: pa.Array, words: Words, texts: pa.Array, near: np.ndarray, block: int) -> pa.Table:
    """Whole documents; those with a window to compare are pending and say where its words start."""
    n = len(ids)
    pending = np.bincount(words.text_of[near], minlength=n) > 0
    spots = [np.packbits(near[i:j]).tobytes() if p else None for i, j, p in zip(words.first[:-1], words.first[1:], pending)]
    return pa.table(
        {
            "kind": pa.array(np.where(pending, PENDING, DONE), pa.int32()),
            "_key": ids,
            "n_words": pa.array(words.counts, pa.int64()),
            "_text": texts,
            "spots": pa.array(spots, pa.binary()),
            "bucket": pa.nulls(n, pa.int32()),
            "block": pa.array(np.full(n, block), pa.int32()),
            "keys": pa.nulls(n, pa.binary()),
            "counts": pa.nulls(n, pa.binary()),
        }
    )


def _key_rows(sent: pa.Table, key_type: pa.DataType) -> pa.Table:
    n = sent.num_rows
    return pa.table(
        {
            "kind": pa.array(np.full(n, KEYS), pa.int32()),
            "_key": pa.nulls(n, key_type),
            "n_words": pa.nulls(n, pa.int64()),
            "_text": pa.nulls(n, pa.string()),
            "spots": pa.nulls(n, pa.binary()),
            **{name: sent.column(name) for name in ("bucket", "block", "keys", "counts")},
        }
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept of every document of ``documents``, as a digest."""
    kept = remove_repeats(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS p, w FROM d WHERE len(w) >= 35
), k AS (
  SELECT r, p, md5(array_to_string(w[p:p + 34], ' ')) AS h FROM s
), twice AS (
  SELECT h FROM k GROUP BY h HAVING count(*) > 1
), hit AS (
  SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM k JOIN twice USING (h)
), gone AS (
  SELECT r, list(q) AS qs, count(*) AS n FROM hit GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
         ELSE coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(qs, i)), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
