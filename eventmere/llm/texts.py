"""Words and word hashes of whole text columns, without a Python loop over words.

A column of texts is one byte buffer with offsets, so words, hashes of words and
hashes of word runs are found by array operations on the buffer. Texts are
handled in slices of about ``SLICE_BYTES``, which bounds the memory of a task
whatever the number of rows; only a single longer text makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
#: Odd bases of the word and run polynomials modulo 2**64.
_BYTE_BASE = 0x5851F42D4C957F2D
_RUN_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection, so no collision is added)."""
    z = values + _STEP
    z = (z ^ (z >> np.uint64(30))) * _MIX_1
    z = (z ^ (z >> np.uint64(27))) * _MIX_2
    return z ^ (z >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte base and of its inverse modulo 2**64, at least ``size`` of each."""
    if len(_powers["up"]) < size:
        length = max(size, SLICE_BYTES + (1 << 16))
        for name, base in (("up", _BYTE_BASE), ("down", pow(_BYTE_BASE, -1, 1 << 64))):
            table = np.full(length, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: bytes, word spans, and first word of each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def place(self) -> np.ndarray:
        """Each word's position in its text."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes, whole texts only."""
    if len(column) == 0:
        return
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    reached = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = reached[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reached, before + size, side="right")))
        yield start, stop
        start = stop


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    # Two texts that meet without white space are two words.
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return Words(data, offsets, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def read_words(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = buffer_of(column)
    return words_of(LOWER[data] if lower else data, offsets)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    up, down = _power_tables(len(words.data) + 1)
    reached = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[words.data] * up[: len(words.data)], out=reached[1:])
    spans = (reached[words.ends] - reached[words.starts]) * down[words.starts]
    return mix(spans + (words.ends - words.starts).astype(np.uint64) * _STEP)


def run_hashes(hashes: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """A hash of every ``length`` neighbouring words; ``kind`` 0 and 1 are independent.

    Runs that reach over the end of a text are the caller's to leave out.
    """
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    source = hashes if kind == 0 else mix(hashes)
    total = source[:count].copy()
    for step in range(1, length):
        total *= _RUN_BASES[kind]
        total += source[step : step + count]
    return mix(total)


def whole_runs(words: Words, length: int) -> np.ndarray:
    """Whether the ``length`` words from each run start lie in one text."""
    count = len(words.starts) - length + 1
    if count <= 0:
        return np.zeros(0, bool)
    left = np.repeat(words.first[1:], words.counts) - np.arange(len(words.starts))
    return left[:count] >= length


def sequence_hashes(words: Words, hashes: np.ndarray, kind: int = 0) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    base = int(_RUN_BASES[kind])
    n = len(hashes)
    if not n:
        return mix(np.zeros(len(words.first) - 1, np.uint64))
    table = np.full(n, base, dtype=np.uint64)
    table[0] = 1
    up = np.multiply.accumulate(table)
    table[1:] = pow(base, -1, 1 << 64)
    down = np.multiply.accumulate(table)
    reached = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(hashes + np.uint64(kind)) * up, out=reached[1:])
    heads = np.minimum(words.first[:-1], n - 1)
    spans = (reached[words.first[1:]] - reached[words.first[:-1]]) * down[heads]
    return mix(spans + words.counts.astype(np.uint64))


def text_column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
