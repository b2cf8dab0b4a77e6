"""Counts over whole texts that the quality operators judge by.

Every text gives one struct of whole numbers; a null text counts as empty and
gives zeros. The counts are exact; equal lines and windows within one text are
found by 64-bit hashes of their content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventmere.llm.shared import given_back
from eventmere.llm.texts import mix, read_words, run_hashes, slices, text_column, whole_runs, word_hashes
from eventmere.llm.texts import _BYTE_VALUES, _power_tables

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_upper", "n_digits", "n_stops", "n_exclaims", "n_wide",
)
REPEAT_WINDOW = 8
STRUCT = T.StructType([T.StructField(name, T.LongType()) for name in NAMES])


def _bytes_in(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_CLASSES = {
    "n_symbols": _bytes_in(b"#*$%&|<>"),
    "n_upper": _bytes_in(bytes(range(ord("A"), ord("Z") + 1))),
    "n_digits": _bytes_in(b"0123456789"),
    "n_stops": _bytes_in(b".,;:?"),
    "n_exclaims": _bytes_in(b"!"),
    "n_wide": np.arange(256) >= 0xC0,  # first bytes of characters beyond ASCII
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    reached = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=reached[1:])
    return np.diff(reached[offsets])


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its content is in its owner twice, and whether an equal one stands before it."""
    keyed = mix(owner.astype(np.uint64)) ^ hashes
    order = np.argsort(keyed, kind="stable")
    ordered = keyed[order]
    same = np.zeros(len(keyed) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice, later = np.zeros(len(keyed), bool), np.zeros(len(keyed), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def _lines(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier line, per text."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    if not len(starts):
        zero = np.zeros(len(offsets) - 1, np.int64)
        return zero, zero
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 0x0A)
    words = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=words[1:])
    full = words[ends] > words[starts]
    starts, ends = starts[full], ends[full]
    up, down = _power_tables(len(data) + 1)
    reached = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=reached[1:])
    hashes = mix((reached[ends] - reached[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    n = len(offsets) - 1
    return np.bincount(owner, minlength=n), np.bincount(owner[_repeats(owner, hashes)[1]], minlength=n)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of some texts."""
    words = read_words(column)
    data, offsets, n = words.data, words.offsets, len(column)
    hashes, owner = word_hashes(words), words.text_of
    change = np.zeros(len(data) + 1, np.int8)
    change[words.starts] += 1
    change[words.ends] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    found = {"n_words": words.counts, "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), offsets)}
    found |= {name: _per_text(table[data], offsets) for name, table in _CLASSES.items()}
    found["n_lines"], found["n_dup_lines"] = _lines(data, offsets, inside)
    found["n_distinct"] = words.counts - np.bincount(owner[_repeats(owner, hashes)[1]], minlength=n)
    at = np.flatnonzero(whole_runs(words, REPEAT_WINDOW))
    runs = run_hashes(hashes, REPEAT_WINDOW)[at]
    twice = at[_repeats(owner[at], runs)[0]]
    cover = np.zeros(len(hashes) + 1, np.int32)
    cover[twice] += 1
    cover[twice + REPEAT_WINDOW] -= 1
    found["n_repeat_words"] = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)
    return found


def with_statistics(df: DataFrame, into: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add a struct column of the statistics; the text may be dropped on the way."""
    kept = [f for f in df.schema.fields if f.name != into and (keep_text or f.name != text)]
    schema = T.StructType([*kept, T.StructField(into, STRUCT)])
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch, text)
            for start, stop in slices(column):
                found = measure(column[start:stop])
                struct = pa.StructArray.from_arrays([pa.array(found[name], pa.int64()) for name in NAMES], list(NAMES))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name)[start:stop] for name in names] + [struct], [*names, into]
                )

    return df.mapInArrow(given_back(add), schema)
