"""Benchmark passages in documents, found by latent semantic retrieval.

Benchmark passages become TF-IDF vectors; their inverse document frequencies come from
the whole corpus, over hashed terms. Passages are taken in blocks. A randomised singular
value decomposition of a block's passage matrix, made of sums over tasks, gives each of
its words a short vector; the rank grows with the passages of the block, and the number
of blocks with the benchmark, so that a passage keeps most of its length whatever the size
of the benchmark. Documents are cut into overlapping windows of three sizes, one for
each class of passage lengths. The cosine of a window, the sum of its words' vectors
over the length of its whole TF-IDF vector, with the passages of its class chooses the
candidates. Where the cosine cannot be trusted, for passages that keep less than
``TRUSTED`` of their length or have fewer than ``LEAST_WORDS`` words, candidates come from
an exact bound instead: a leak holds at least half of the item's words, so of any larger
part of them it holds all but the other half.

Each candidate is compared word by word: by the longest common subsequence with the
item, and by the item's last words, its answer.

Documents need no shuffle: all they need is broadcast, ``ROUND_BLOCKS`` blocks at a time,
each with about ``PASSAGES`` passages and at most ``RANK`` numbers for each of their words.
More blocks take more rounds over the documents, whose finds are joined at the end.

Cases: null and empty texts, and items without words, match nothing; repeated
rows are judged alike; an item repeated in the benchmark is reported under each
of its ids; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.llm import shared
from eventmere.llm.texts import Words, mix, read_words, slices, text_column, word_hashes

TERMS = 1 << 17
ROWS = 128
#: Passages of a block, about, and the most numbers a word's vector has.
PASSAGES = 384
RANK = 256
OVERSAMPLED = 16
#: Blocks that are searched in one pass over the documents.
ROUND_BLOCKS = 8
#: Words of a step of places where an item may begin; a passage has two steps at most.
STEP = 32
#: Longest passage of each class; its windows are three halves of this, and begin at every half.
CLASSES = (16, 32, 64)
HOP = CLASSES[0] // 2
#: Least cosine of a candidate.
NEAR = 0.2
#: Share of a passage's length that the space must keep, and words an item must have, for the cosine to choose.
TRUSTED, LEAST_WORDS = 0.6, 8
#: Shares of an item's words, in order, that make a leak, alone or with its answer.
LEAK_SHARE, ANSWERED_SHARE = 70, 50
ANSWER_WORDS = 5
SLICE = 400_000
#: Candidates whose places are counted at a time.
CANDIDATES = 20_000

LEAKS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("common_words", T.LongType()),
            T.StructField("item_words", T.LongType()),
            T.StructField("answered", T.BooleanType()),
        ]
    )
)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(47)).astype(np.int64)


def _windows(words: Words, size: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Each word's step, numbered over all texts, and the text of each step."""
    steps = -(-words.counts // size)
    first = np.cumsum(steps) - steps
    return np.repeat(first, words.counts) + words.place // size, np.repeat(np.arange(len(steps)), steps)


def _signs(words: np.ndarray) -> np.ndarray:
    """Random signs of each word: the test matrix of the decomposition."""
    width = np.arange(RANK + OVERSAMPLED, dtype=np.uint64)
    return np.where(mix(words[:, None] ^ mix(width)[None, :]) >> np.uint64(63), 1.0, -1.0)


def _flags(rows: np.ndarray) -> np.ndarray:
    return rows.reshape(-1) if len(rows) else np.zeros(TERMS)


def _passages(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, word hashes and the item's word hashes of each benchmark passage, two steps long at most."""
    words = read_words(column, lower=True)
    hashes = word_hashes(words)
    for row, (i, j) in enumerate(zip(words.first[:-1], words.first[1:])):
        for start in range(i, max(j - STEP, i + 1), STEP):
            if j > i:
                yield row, hashes[start : min(start + 2 * STEP, j)], hashes[i:j]


def _weighted(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a passage and its unit TF-IDF vector."""
    own, tf = np.unique(hashes, return_counts=True)
    a = tf * weights[_terms(own)]
    return own, a / (np.linalg.norm(a) or 1.0)


def term_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each hashed term over all documents' ``text``."""

    def frequency(batch: pa.RecordBatch) -> np.ndarray:
        counts, column = np.zeros(TERMS), text_column(batch, "text")
        for start, stop in slices(column):
            words = read_words(column[start:stop], lower=True)
            held = np.sort(words.text_of * TERMS + _terms(word_hashes(words)))
            held = held[np.append(True, held[1:] != held[:-1])] if len(held) else held
            counts += np.bincount(held % TERMS, minlength=TERMS)
        return np.vstack((counts.reshape(ROWS, -1), np.full(TERMS // ROWS, len(column))))

    found = shared.summed(docs.select("text"), frequency, TERMS // ROWS)
    total = found[ROWS, 0] if len(found) else 0.0
    return np.log((total + 1) / (_flags(found[:ROWS]) + 1)) + 1e-3


def decompose(items: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some passages, in order, and for each a vector of at most ``RANK`` numbers.

    The sum of a text's word vectors, weighted by TF-IDF, is its place in the space.
    """
    width = RANK + OVERSAMPLED

    def sketched(column: pa.Array):
        for _, hashes, _ in _passages(column):
            own, a = _weighted(hashes, weights)
            yield own, a, a @ _signs(own)

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        rows = [y for _, _, y in sketched(text_column(batch, "text"))]
        y = np.array(rows).reshape(-1, width)
        return y.T @ y

    g = shared.summed(items.select("text"), gram, width)
    if not len(g) or not g.any():
        return np.zeros(0, np.uint64), np.zeros((0, 1), np.float32)
    values, vectors = np.linalg.eigh(g)
    good = values > max(values.max(), 1e-12) * 1e-10
    inverse = vectors[:, good] / np.sqrt(values[good])
    rank = inverse.shape[1]

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows = [], []
        for batch in batches:
            for own, a, y in sketched(text_column(batch, "text")):
                words.append(own)
                rows.append(a[:, None] * (y @ inverse)[None, :])
        if words:
            own, total = _added(np.concatenate(words), np.concatenate(rows))
            for part in range(ROWS):
                chosen = own % np.uint64(ROWS) == part
                if chosen.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part], pa.int32()),
                            pa.array([own[chosen].astype("<u8").tobytes()], pa.binary()),
                            pa.array([total[chosen].astype("<f4").tobytes()], pa.binary()),
                        ],
                        ["part", "w", "v"],
                    )

    def add(table: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(t, "<u8") for t in table.column("w").to_pylist()])
        rows = np.concatenate([np.frombuffer(v, "<f4").reshape(-1, rank) for v in table.column("v").to_pylist()])
        own, total = _added(words, rows)
        return pa.table({"w": pa.array([own.astype("<u8").tobytes()], pa.binary()), "v": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    projected = items.select("text").mapInArrow(by_word, "part int, w binary, v binary")
    # The words of a block's passages: the bounded model that is sent to all tasks.
    found = projected.groupBy("part").applyInArrow(add, "w binary, v binary").collect()
    words = np.concatenate([np.frombuffer(r["w"], "<u8") for r in found])
    b = np.concatenate([np.frombuffer(r["v"], "<f4").reshape(-1, rank) for r in found])[np.argsort(words)]
    _, turn = np.linalg.eigh((b.T @ b).astype(float))
    b = b @ turn[:, ::-1][:, :RANK].astype(np.float32)
    b /= np.maximum(np.linalg.norm(b, axis=0), 1e-9)
    return np.sort(words), b


def _added(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(words, return_inverse=True)
    total = np.zeros((len(own), rows.shape[1]))
    np.add.at(total, at, rows)
    return own, total


def common_length(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per item word."""
    places: dict[int, int] = {}
    for n, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << n
    full = (1 << len(item)) - 1
    row = full
    for word in words.tolist():
        hit = places.get(word)
        if hit:
            met = row & hit
            row = ((row + met) | (row - met)) & full
    return len(item) - row.bit_count()


@dataclass
class Index:
    """What the exact bound needs of some items; other items have no entries."""

    #: Indexed words in ascending order, where each one's entries begin, and the entries: item and its places with the word.
    words: np.ndarray
    heads: np.ndarray
    entry_item: np.ndarray
    entry_places: np.ndarray
    #: Of each item, how many indexed places a leak fills at least, and how many steps a leak's region has.
    needed: np.ndarray
    steps: np.ndarray


@dataclass
class Block:
    """Some items: words and their vectors, unit vectors, item and class of each trusted passage, the items, and the index of the others."""

    words: np.ndarray
    table: np.ndarray
    vectors: np.ndarray
    item_of: np.ndarray
    class_of: np.ndarray
    ids: list[int]
    items: list[np.ndarray]
    index: Index


def read_block(rows: pa.Table, words: np.ndarray, table: np.ndarray, weights: np.ndarray) -> Block:
    """A block of items with the space of its passages."""
    ids = rows.column("item_id").to_pylist()
    items = [np.zeros(0, np.uint64)] * len(ids)
    vectors, item_of, class_of, exact = [], [], [], set()
    for row, hashes, whole in _passages(text_column(rows, "text")):
        own, a = _weighted(hashes, weights)
        at = np.searchsorted(words, own)
        vector = (a[:, None] * table[at]).sum(0) if len(words) else np.zeros(1)
        kept = float(np.linalg.norm(vector))
        items[row] = whole
        if kept < TRUSTED or len(whole) < LEAST_WORDS:
            exact.add(row)
        else:
            vectors.append(vector / kept)
            item_of.append(row)
            class_of.append(int(np.searchsorted(CLASSES, len(hashes))))
    untrusted = [x if n in exact else x[:0] for n, x in enumerate(items)]
    # Weighted once here, so that a window is a plain sum.
    scaled = (table * weights[_terms(words)][:, None]).astype(np.float32) if len(words) else table
    return Block(
        words, scaled, np.array(vectors, np.float32).reshape(len(vectors), table.shape[1]), np.array(item_of, np.int64),
        np.array(class_of, np.int64), ids, items, index_words(untrusted, weights),
    )


def _region_words(length: np.ndarray | int):
    """Words of the region where an item that begins in a step is looked for, from that step's first word on."""
    return np.maximum(3 * STEP, length + STEP)


def index_words(items: list[np.ndarray], weights: np.ndarray) -> Index:
    """The words of each item that cost least to look up, enough of them for the bound."""
    length = np.array([len(x) for x in items], np.int64)
    words = np.concatenate(items) if len(items) else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(items)), length)
    kinds, kind = np.unique(words, return_inverse=True)
    # Places of a word in an item, and items of a word.
    pairs, pair, places = np.unique(kind * max(len(items), 1) + item, return_inverse=True, return_counts=True)
    held = np.bincount(pairs // max(len(items), 1), minlength=len(kinds))
    # What looking up a word costs: how often it comes, times its entries.
    cost = np.exp(-weights[_terms(kinds)]) * held
    order = np.lexsort((pair, cost[kind], item))
    first = np.cumsum(length) - length
    rank = np.arange(len(words)) - np.repeat(first, length)
    # A leak misses half of the item's places at most.
    missed = length - -(-ANSWERED_SHARE * length // 100)
    needed = np.maximum(1, np.minimum(length // 4, length - missed))
    indexed = pair[order[rank < np.repeat(missed + needed, length)]]
    chosen, count = np.unique(indexed, return_counts=True)
    of_word = pairs[chosen] // max(len(items), 1)
    used, heads = np.unique(of_word, return_index=True)
    steps = 1 + -(-_region_words(length) // STEP)
    return Index(kinds[used], np.append(heads, len(chosen)), pairs[chosen] % max(len(items), 1), count, needed, steps)


def candidates(hashes: np.ndarray, step_of: np.ndarray, text_of: np.ndarray, passages: Index) -> list[tuple[int, int]]:
    """Steps and items such that enough indexed places of the item are filled from this step on."""
    if not len(passages.words):
        return []
    indexed = np.zeros(TERMS, bool)
    indexed[_terms(passages.words)] = True
    hit = np.flatnonzero(indexed[_terms(hashes)])
    at = np.searchsorted(passages.words, hashes[hit])
    at = np.minimum(at, len(passages.words) - 1)
    same = passages.words[at] == hashes[hit]
    found = np.unique(step_of[hit[same]] * len(passages.words) + at[same])
    step, word = found // len(passages.words), found % len(passages.words)
    entries = passages.heads[word + 1] - passages.heads[word]
    reached = np.cumsum(entries)
    entry = np.arange(reached[-1] if len(reached) else 0) + np.repeat(passages.heads[word] - (reached - entries), entries)
    item, places = passages.entry_item[entry], passages.entry_places[entry]
    # Steps are numbered with gaps, so that no region reaches into the next text or item.
    gap = int(passages.steps.max(initial=0))
    spread = np.arange(len(text_of)) + text_of * gap
    stride = (spread[-1] if len(spread) else 0) + gap + 1
    stands = np.sort(word * stride + spread[step])
    step = np.repeat(step, entries)
    key = item * stride + spread[step]
    order = np.argsort(key, kind="stable")
    key, step, item = key[order], step[order], item[order]
    filled = np.append(0, np.cumsum(places[order]))
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    ends = np.searchsorted(key, key[heads] + passages.steps[item[heads]])
    enough = heads[filled[ends] - filled[heads] >= passages.needed[item[heads]]]
    step, item = step[enough], item[enough]
    # A word that stands in several steps was counted in each. Now every place counts once.
    by_item = np.argsort(passages.entry_item, kind="stable")
    own_words = np.repeat(np.arange(len(passages.words)), np.diff(passages.heads))[by_item]
    edges = np.searchsorted(passages.entry_item[by_item], np.arange(len(passages.needed) + 1))
    kept = []
    for i in range(0, len(step), CANDIDATES):
        some, of = step[i : i + CANDIDATES], item[i : i + CANDIDATES]
        entries = edges[of + 1] - edges[of]
        reached = np.cumsum(entries)
        entry = np.arange(reached[-1]) + np.repeat(edges[of] - (reached - entries), entries)
        least = own_words[entry] * stride + np.repeat(spread[some], entries)
        next_one = np.append(stands, np.iinfo(np.int64).max)[np.searchsorted(stands, least)]
        there = next_one < least + np.repeat(passages.steps[of], entries)
        filled = np.bincount(np.repeat(np.arange(len(some)), entries), passages.entry_places[by_item][entry] * there, len(some))
        good = filled >= passages.needed[of]
        kept += zip(some[good].tolist(), of[good].tolist())
    return kept


def _row_sums(table: np.ndarray, rows: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """The sum of each owner's rows of a table; owners ascend, and an owner has a few rows only."""
    sums = np.zeros((count, table.shape[1]), table.dtype)
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, int)
    sizes = np.diff(np.append(heads, len(owner)))
    # Owners with most rows first: those that have an n-th row are the first ones.
    order = np.argsort(-sizes, kind="stable")
    heads, sizes = heads[order], sizes[order]
    more = heads[: np.searchsorted(-sizes, -1)]
    rest = table[rows[more + 1]]
    for n in range(2, int(sizes.max(initial=0))):
        own = heads[: np.searchsorted(-sizes, -n)]
        rest[: len(own)] += table[rows[own + n]]
    total = table[rows[heads]]
    total[: len(more)] += rest
    sums[owner[heads]] = total
    return sums


def near_windows(words: Words, hashes: np.ndarray, block: Block, weights: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, first and last word place, item and cosine of windows that are near to a passage of their class."""
    if not len(block.vectors) or not len(hashes):
        return
    at = np.minimum(np.searchsorted(block.words, hashes), len(block.words) - 1)
    hit = np.flatnonzero(block.words[at] == hashes)
    hop_of, text_of = _windows(words, HOP)
    sums = _row_sums(block.table, at[hit], hop_of[hit], len(text_of))
    squares = np.bincount(hop_of, weights[_terms(hashes)] ** 2, len(text_of))
    place = np.arange(len(text_of)) - np.searchsorted(text_of, text_of)
    for number, longest in enumerate(CLASSES):
        if number:  # two hops of the class before are one of this
            keep = place % 2 == 0
            odd = np.flatnonzero(~keep)
            sums[odd - 1] += sums[odd]
            squares[odd - 1] += squares[odd]
            sums, squares, text_of, place = sums[keep], squares[keep], text_of[keep], place[keep] // 2
        chosen = np.flatnonzero(block.class_of == number)
        if not len(chosen):
            continue
        window, length = sums.copy(), squares.copy()
        for step in (1, 2):
            same = np.flatnonzero(text_of[step:] == text_of[: len(text_of) - step])
            window[same] += sums[same + step]
            length[same] += squares[same + step]
        cosine = (window @ block.vectors[chosen].T) / np.sqrt(np.maximum(length, 1e-12)).astype(np.float32)[:, None]
        w, p = np.nonzero(cosine >= NEAR)
        first = place[w] * (longest // 2)
        yield text_of[w], first, first + 3 * (longest // 2) - 1, block.item_of[chosen[p]], cosine[w, p]


def places(words: Words, hashes: np.ndarray, block: Block, weights: np.ndarray) -> dict[tuple[int, int], dict[int, float]]:
    """Text and item of the candidates, with the steps where the item may begin and the best cosine of each."""
    found: dict[tuple[int, int], dict[int, float]] = {}
    for text_of, first, last, item_of, cosines in near_windows(words, hashes, block, weights):
        for text, low, high, item, cosine in zip(*(x.tolist() for x in (text_of, first, last, item_of, cosines))):
            steps = found.setdefault((text, item), {})
            final = (int(words.counts[text]) - 1) // STEP
            for step in range(max(0, (low - len(block.items[item])) // STEP), min(high // STEP, final) + 1):
                steps[step] = max(steps.get(step, 0.0), cosine)
    step_of, text_of = _windows(words)
    first_step = np.searchsorted(text_of, np.arange(len(words.counts) + 1))
    for step, item in candidates(hashes, step_of, text_of, block.index):
        text = int(text_of[step])
        own, place = found.setdefault((text, item), {}), step - int(first_step[text])
        last = int(first_step[text + 1] - first_step[text]) - 1
        # All regions with this step.
        for at in range(max(0, place - int(block.index.steps[item]) + 2), min(place + 1, last) + 1):
            own.setdefault(at, 0.0)
    return found


def search(column: pa.Array, block: Block, weights: np.ndarray) -> list[list[dict]]:
    """The leaks in each text."""
    words = read_words(column, lower=True)
    hashes = word_hashes(words)
    found: list[list[dict]] = [[] for _ in range(len(column))]
    for (text, row), steps in places(words, hashes, block, weights).items():
        item, begin, end = block.items[row], int(words.first[text]), int(words.first[text + 1])
        length, best = int(_region_words(len(item))), None
        low, high = min(steps), max(steps)
        whole = hashes[max(begin, begin + (low - 1) * STEP) : min(end, begin + high * STEP + length)]
        if 100 * np.count_nonzero(np.isin(item, whole)) < ANSWERED_SHARE * len(item):
            continue
        for at, cosine in steps.items():
            # Where an item that begins in this step would stand, with a step more on both sides.
            region = hashes[max(begin, begin + (at - 1) * STEP) : min(end, begin + at * STEP + length)]
            if 100 * np.count_nonzero(np.isin(item, region)) < ANSWERED_SHARE * len(item):
                continue
            common = common_length(item, region)
            tail = item[-ANSWER_WORDS:]
            answered = any(np.array_equal(region[i : i + len(tail)], tail) for i in np.flatnonzero(region == tail[0]))
            if 100 * common >= LEAK_SHARE * len(item) or answered and 100 * common >= ANSWERED_SHARE * len(item):
                if best is None or (common, cosine) > (best["common_words"], best["cosine"]):
                    best = {"item_id": block.ids[row], "cosine": cosine, "common_words": common, "item_words": len(item), "answered": answered}
        if best:
            found[text].append(best)
    return found


def blocks_of(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """Items with their ``block``, and the number of blocks of about ``PASSAGES`` passages."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Words are counted roughly here, by white space.
    steps = F.greatest(F.lit(1), F.ceil(F.size(F.split("text", r"\s+")) / STEP) - 1)
    total = items.agg(F.sum(steps)).first()[0] or 0
    count = max(1, -(-int(total) // PASSAGES))
    return shared.stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))), "leak-items"), count


def find_leaks(docs: DataFrame, benchmark: DataFrame, into: str = "leaks", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add an array of the benchmark items that each document holds."""
    spark = docs.sparkSession
    items, count = blocks_of(benchmark)
    weights = term_weights(docs.select(F.col(text).alias("text")))
    kept = [f for f in docs.schema.fields if f.name != into]
    out = [f for f in kept if keep_text or f.name != text]
    if count <= ROUND_BLOCKS:
        found, _ = _one_round(docs, out, items, range(count), weights, into, text, False)
        return found
    # Several rounds: finds are kept by row and joined, so that each round's broadcast can go.
    base = shared.stored(docs.select(*[f.name for f in kept]).withColumn("__row", F.monotonically_increasing_id()), "leak-docs")
    row = base.schema["__row"]
    parts = []
    for start in range(0, count, ROUND_BLOCKS):
        found, sent = _one_round(base.select(text, "__row"), [row], items, range(start, min(start + ROUND_BLOCKS, count)), weights, into, text, True)
        parts.append(shared.stored(found, "leak-finds"))
        sent.destroy()
    finds = parts[0]
    for part in parts[1:]:
        finds = finds.unionByName(part)
    finds = finds.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list(into))).alias(into))
    joined = base.join(finds, "__row", "left").withColumn(into, F.coalesce(into, F.array().cast(LEAKS)))
    return joined.select(*[f.name for f in out], into)


def _one_round(docs: DataFrame, out: list[T.StructField], items: DataFrame, blocks: range, weights: np.ndarray, into: str, text: str, finds_only: bool):
    """Some blocks searched in all documents, and what was broadcast for it."""
    made = []
    for number in blocks:
        own = items.filter(F.col("block") == number)
        made.append(read_block(own.select("item_id", "text").orderBy("item_id", "text").toArrow(), *decompose(own, weights), weights))
    # Plain tuples: what is broadcast must be read without this module.
    plain = [tuple(tuple(vars(v).values()) if isinstance(v, Index) else v for v in vars(b).values()) for b in made]
    sent = docs.sparkSession.sparkContext.broadcast((plain, weights.astype(np.float32)))
    names = [f.name for f in out]
    whole, flag = pa.int64(), pa.bool_()
    leak_type = pa.list_(
        pa.struct(
            [("item_id", whole), ("cosine", pa.float64()), ("common_words", whole), ("item_words", whole), ("answered", flag)]
        )
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, weights = sent.value
        blocks = [Block(*values[:-1], Index(*values[-1])) for values in plain]
        for batch in batches:
            column = text_column(batch, text)
            for start, stop in slices(column, SLICE):
                found: list[list[dict]] = [[] for _ in range(stop - start)]
                for block in blocks:
                    for one, more in zip(found, search(column[start:stop], block, weights)):
                        one.extend(more)
                for one in found:
                    one.sort(key=lambda x: (x["item_id"] is not None, x["item_id"] or 0))
                rows = pa.RecordBatch.from_arrays(
                    [batch.column(n)[start:stop] for n in names] + [pa.array(found, leak_type)], [*names, into]
                )
                yield rows.filter(pa.array([bool(x) for x in found])) if finds_only else rows

    schema = T.StructType([*out, T.StructField(into, LEAKS)])
    return docs.mapInArrow(shared.given_back(add), schema), sent


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with their own columns."""
    found = find_leaks(docs, benchmark, "__leaks", text)
    return found.filter(F.size("__leaks") == 0).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, shared.table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda x: x["item_id"].cast("string")), ",").alias("item_ids"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["cosine"])), F.lit(0.0)).alias("cosine"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["common_words"])), F.lit(0)).alias("common_words"),
    )
