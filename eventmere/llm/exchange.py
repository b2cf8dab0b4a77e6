"""Counts of very many keys, asked block by block.

Every block of documents sends its distinct keys, packed, to buckets by key; a
bucket adds up what all blocks sent and answers each block for its own keys. A
hot key costs one entry per block, not one per occurrence. Keys have 128 bits,
so that different content stays apart at any corpus size. Between blocks and
buckets there are at most as many rows as keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
SENT_DDL = "bucket int, block int, keys binary, counts binary"
ANSWER_DDL = "bucket int, block int, counts binary"


def grouped(first: np.ndarray, second: np.ndarray, counts: np.ndarray | None = None):
    """Distinct key pairs in order and the sum of their counts (1 each if none are given)."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    if not len(a):
        return a, b, np.zeros(0, np.int64)
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(heads, len(a)))
    else:
        sums = np.add.reduceat(counts[order], heads)
    return a[heads], b[heads], sums.astype(np.int64)


def pack(first: np.ndarray, second: np.ndarray) -> bytes:
    """Both parts one after the other; a second part of zeros only is left out."""
    return first.astype("<u8").tobytes() + (second.astype("<u8").tobytes() if second.any() else b"")


def unpack(blob: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    parts = np.frombuffer(blob, dtype="<u8")
    return parts[:count], parts[count:] if len(parts) > count else np.zeros(count, np.uint64)


def send(block: int, first: np.ndarray, second: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """Rows for the buckets; keys must be distinct and in order."""
    # The bucket is the key's leading part, so each bucket's keys are one stretch.
    bucket = ((first >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)
    heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    ends = np.append(heads[1:], len(bucket))
    return pa.table(
        {
            "bucket": pa.array(bucket[heads], pa.int32()),
            "block": pa.array(np.full(len(heads), block), pa.int32()),
            "keys": pa.array([pack(first[i:j], second[i:j]) for i, j in zip(heads, ends)], pa.binary()),
            "counts": pa.array([counts[i:j].astype("<i4").tobytes() for i, j in zip(heads, ends)], pa.binary()),
        },
        schema=SENT,
    )


def _received(sent: pa.Table):
    """Sender row, key parts and counts of everything a bucket got."""
    counts = [np.frombuffer(c, dtype="<i4").astype(np.int64) for c in sent.column("counts").to_pylist()]
    pairs = [unpack(b, len(c)) for b, c in zip(sent.column("keys").to_pylist(), counts)]
    sender = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return sender, join([p[0] for p in pairs]), join([p[1] for p in pairs]), join(counts).astype(np.int64)


def totals(sent: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of everything a bucket got: the sender row, the total of its key, and whether the key stands there first."""
    sender, first, second, counts = _received(sent)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order], heads) if len(heads) else np.zeros(0, np.int64)
    total, leading = np.empty(len(a), np.int64), np.empty(len(a), bool)
    total[order] = np.repeat(sums, np.diff(np.append(heads, len(a))))
    leading[order] = new
    return sender, total, leading


def answers(sent: DataFrame) -> DataFrame:
    """The buckets' answers: the total of every key a block sent, in the order it sent them.

    Keys are not sent back, as a block can make its own again.
    """

    def of_bucket(rows: pa.Table) -> pa.Table:
        sender, total, _ = totals(rows)
        edges = np.searchsorted(sender, np.arange(rows.num_rows + 1))
        packed = [total[i:j].astype("<i8").tobytes() for i, j in zip(edges[:-1], edges[1:])]
        return pa.table({"bucket": rows.column("bucket"), "block": rows.column("block"), "counts": pa.array(packed, pa.binary())})

    return sent.select("bucket", "block", "keys", "counts").groupBy("bucket").applyInArrow(of_bucket, ANSWER_DDL)


class Totals:
    """Answers to one block for the distinct keys it sent, looked up by key."""

    def __init__(self, answers: pa.Table, first: np.ndarray, second: np.ndarray):
        order = np.argsort(np.asarray(answers.column("bucket")), kind="stable")
        blobs = answers.column("counts").to_pylist()
        parts = [np.frombuffer(blobs[i], dtype="<i8") for i in order]
        self.first, self.second = first, second
        self.counts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if len(self.counts) != len(first):
            raise ValueError("a block's keys changed between asking and reading the answer")

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Totals of some of the block's keys."""
        at = np.searchsorted(self.first, first)
        left = np.flatnonzero(self.second[at] != second) if len(at) else at
        while len(left):  # keys that differ in their second part only follow each other
            at[left] += 1
            left = left[self.second[at[left]] != second[left]]
        return self.counts[at] if len(at) else np.zeros(0, np.int64)
