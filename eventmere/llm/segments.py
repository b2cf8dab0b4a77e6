"""Sampled segmentations of texts into the pieces of a public vocabulary.

A text's segmentations are the paths of a lattice whose edges are pieces, or the
bytes of a character no piece covers. Pieces never reach over the start of a word,
so the lattice of a text is a chain of small ones, made once for every distinct
unit of a slice by array operations. Backward sums give the chance of each edge.

``SAMPLES`` distinct segmentations are drawn without replacement by Gumbel
top-k: every set of paths with one beginning has a perturbed score, the maximum
over its paths, distributed as a Gumbel variable around its log mass and bounded
by its parent's. A best-first search opens the set with the highest score, so the
paths come out in the order of their perturbed scores, and the best score left over
gives each path's chance to have been included. All random numbers are hashes of
the row's key and a position: a retried task draws the same.

Edge weights follow a Zipf law over the vocabulary's order; nothing is trained.
Decoding joins pieces and bytes and drops the space put before a text; it gives
back the text exactly.

Cases: null and empty texts have no pieces and one empty segmentation; a text with
fewer segmentations than asked for gives all of them, each with inclusion 1; rows
with the same key and text give the same samples; an empty table gives an empty
result; other columns are carried along.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.llm import shared
from eventmere.llm.texts import buffer_of, mix, slices, text_column

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
#: Offset and exponent of the law that weights pieces by their place in the vocabulary.
ZIPF_OFFSET, ZIPF_POWER = 2.7, 1.0
SLICE = 1_000_000
#: Sets of paths with less mass (natural log) than a float can tell from nothing are not opened.
LEAST_LOG_MASS = -45.0
#: Edges looked at first, four times as many where their mass is not used up, and cells at a time.
WIDTH, CELLS = 512, 2_000_000
SPACE = 0x20
FALLBACK = -1


@dataclass
class Vocabulary:
    """Pieces as a tree of their bytes; spaces stand for the model's word mark."""

    ids: np.ndarray
    weights: np.ndarray
    column: np.ndarray  # of each byte, its place among those that pieces have
    child: np.ndarray  # a row for each node with children, the root first; no child is 0
    piece: np.ndarray  # of each node, the piece that ends there, or -1
    byte_ids: np.ndarray
    byte_weight: float


@functools.cache
def piece_bytes(path: str = MODEL_FILE) -> list[bytes | None]:
    """What each id stands for; control and unknown ids stand for nothing."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: list[bytes | None] = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            found.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            found.append(None)
        else:
            found.append(model.id_to_piece(i).replace("▁", " ").encode())
    return found


def _tree(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns of bytes, children and pieces of the tree of all pieces, which are distinct."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces], np.int64)
    begins = np.cumsum(lengths) - lengths
    used = np.unique(data)
    column = np.zeros(256, np.int64)
    column[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    node_of, nodes = np.zeros(len(pieces), np.int64), 1
    parents, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for depth in range(int(lengths.max(initial=0))):
        own = np.flatnonzero(lengths > depth)
        keys, at = np.unique(node_of[own] * width + column[data[begins[own] + depth]], return_inverse=True)
        parents.append(keys // width)
        columns.append(keys % width)
        node_of[own] = nodes + at
        nodes += len(keys)
    parent, place = np.concatenate(parents), np.concatenate(columns)
    # Nodes with children get the lowest numbers.
    inner = np.zeros(nodes, bool)
    inner[0] = True
    inner[parent] = True
    number = np.empty(nodes, np.int32)
    number[np.argsort(~inner, kind="stable")] = np.arange(nodes)
    child = np.zeros((int(inner.sum()), width), np.int32)
    child[number[parent], place] = number[1:]
    piece = np.full(nodes, -1, np.int32)
    piece[number[node_of]] = np.arange(len(pieces))
    return column, child, piece


@functools.cache
def read_vocabulary(path: str = MODEL_FILE) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = piece_bytes(path)
    byte_ids = np.zeros(256, np.int64)
    pieces: list[tuple[bytes, int]] = []
    for i, piece in enumerate(found):
        if piece is not None and model.is_byte(i):
            byte_ids[piece[0]] = i
        elif piece is not None:
            if b" " in piece.lstrip(b" "):
                raise ValueError("a piece reaches over the start of a word")
            pieces.append((piece, i))
    order = {i: n for n, (_, i) in enumerate(sorted(pieces, key=lambda p: (-model.get_score(p[1]), p[1])))}
    law = -ZIPF_POWER * np.log(np.arange(len(pieces)) + ZIPF_OFFSET)
    law -= np.log(np.exp(law).sum())
    ids = np.array([i for _, i in pieces], np.int32)
    weights = np.array([law[order[i]] for i in ids.tolist()])
    return Vocabulary(ids, weights, *_tree([p for p, _ in pieces]), byte_ids, float(law.min()))


@dataclass
class Lattice:
    """Edges of all distinct units, in the order of the nodes they leave."""

    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    chance: np.ndarray
    log_chance: np.ndarray
    first: np.ndarray  # first edge of each node, one more at the end
    reached: np.ndarray  # sum of the chances of all edges up to and with this one
    ends: np.ndarray  # whether a node ends its unit
    starts: np.ndarray  # first node of each unit
    data: np.ndarray
    byte_of: np.ndarray  # place of a node in the data


def build_lattice(units: pa.Array, words: Vocabulary) -> Lattice:
    data, offsets = buffer_of(units)
    lengths = np.diff(offsets)
    unit_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(data))
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    char_length = np.diff(np.append(lead, len(data)))
    sources, sizes, pieces, weights = [], [], [], []
    whole = np.zeros(len(data), bool)
    size_at = np.zeros(len(data), np.int32)
    size_at[lead] = char_length
    # From every character the tree is followed as long as it goes on inside the unit.
    inner, width = words.child.shape
    children, columns = words.child.reshape(-1), words.column[data]
    at, ahead, node, length = lead, left[lead], np.zeros(len(lead), np.int64), 0
    while len(at):
        length += 1
        node = children[node * width + columns[at + (length - 1)]]
        place = words.piece[node]
        hit = np.flatnonzero((place >= 0) & (node > 0))
        own, place = at[hit], place[hit]
        sources.append(own)
        sizes.append(np.full(len(own), length, np.int32))
        pieces.append(words.ids[place])
        weights.append(words.weights[place])
        whole[own[size_at[own] == length]] = True
        on = np.flatnonzero((node > 0) & (node < inner) & (ahead > length))
        at, ahead, node = at[on], ahead[on], node[on].astype(np.int64)
    bare = lead[~whole[lead]]
    sources.append(bare)
    sizes.append(size_at[bare])
    pieces.append(np.full(len(bare), FALLBACK, np.int32))
    weights.append(size_at[bare] * words.byte_weight)
    # Each unit has a node per byte and one for its end.
    nodes = len(data) + len(lengths)
    leaving = np.bincount(np.concatenate(sources), minlength=len(data))
    at_byte = np.append(0, np.cumsum(leaving))
    filled = at_byte[:-1].copy()
    total = int(at_byte[-1])
    source, size, piece = (np.empty(total, np.int32) for _ in range(3))
    weight = np.empty(total)
    for own, length, ids, law in zip(sources, sizes, pieces, weights):
        # A node has one edge of each length at most in each part.
        spot = filled[own]
        filled[own] += 1
        source[spot], size[spot], piece[spot], weight[spot] = own, length, ids, law
    unit = unit_of[source]
    far = offsets[unit + 1] - source
    source = source + unit
    target = source + size
    mass = np.zeros(nodes)
    by_far = np.argsort(far.astype(np.uint16) if far.max(initial=0) < 1 << 16 else far, kind="stable")
    edges = np.append(0, np.cumsum(np.bincount(far)))
    leaves, reaches, laws = source[by_far], target[by_far], weight[by_far]
    new = np.append(True, leaves[1:] != leaves[:-1])
    for begin, end in zip(edges[1:-1].tolist(), edges[2:].tolist()):
        if begin == end:
            continue
        values = laws[begin:end] + mass[reaches[begin:end]]
        heads = np.flatnonzero(new[begin:end])
        if not len(heads) or heads[0]:
            heads = np.append(0, heads)
        top = np.maximum.reduceat(values, heads)
        total = np.add.reduceat(np.exp(values - np.repeat(top, np.diff(np.append(heads, end - begin)))), heads)
        mass[leaves[begin + heads]] = top + np.log(total)
    log_chance = weight + mass[target] - mass[source]
    chance = np.exp(log_chance)
    ends = np.zeros(nodes, bool)
    ends[offsets[1:] + np.arange(len(lengths))] = True
    byte_of = np.arange(nodes) - np.repeat(np.arange(len(lengths)), lengths + 1)
    first = np.append(0, np.cumsum(np.bincount(source, minlength=nodes)))
    starts = offsets[:-1] + np.arange(len(lengths))
    return Lattice(source, target, piece, chance, log_chance, first, np.cumsum(chance), ends, starts, data, byte_of)


def uniform(seeds: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit seeds."""
    return ((mix(seeds) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _pick(lattice: Lattice, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An edge leaving each node, by its chance."""
    first, last = lattice.first[nodes], lattice.first[nodes + 1] - 1
    below = np.where(first > 0, lattice.reached[first - 1], 0.0)
    wanted = below + u * (lattice.reached[last] - below)
    return np.clip(np.searchsorted(lattice.reached, wanted, side="right"), first, last)


def walk(lattice: Lattice, nodes: np.ndarray, seeds: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A random path from each node to the end of its unit: all edges, and where each path begins.

    ``order`` sorts the nodes, so that neighbours in the lattice are read together.
    """
    order = np.argsort(nodes, kind="stable") if order is None else order
    nodes, seeds = nodes[order], seeds[order]
    alive, steps, counts = np.arange(len(nodes)), [], np.zeros(len(nodes), np.int64)
    step = 0
    while len(alive):
        edge = _pick(lattice, nodes[alive], uniform(seeds[alive] + np.uint64((step + 1) * 7919)))
        steps.append((order[alive], edge))
        counts[order[alive]] += 1
        nodes[alive] = lattice.target[edge]
        alive = alive[~lattice.ends[nodes[alive]]]
        step += 1
    begins = np.append(0, np.cumsum(counts))
    out = np.zeros(begins[-1], np.int64)
    for n, (path, edge) in enumerate(steps):
        out[begins[path] + n] = edge
    return out, begins


def _bounded(location: np.ndarray, bound: float | np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel variables around ``location``, none above ``bound``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        return np.where(np.isneginf(location), -np.inf, location - np.log(np.exp(location - bound) - np.log(u)))


@dataclass
class Paths:
    """One path of each text: all edges and the unit of each, and where each text's path begins."""

    edges: np.ndarray
    units: np.ndarray
    begins: np.ndarray

    def of(self, texts: np.ndarray) -> Paths:
        lengths = self.begins[texts + 1] - self.begins[texts]
        at = _stretches(self.begins[texts], lengths)
        return Paths(self.edges[at], self.units[at], np.append(0, np.cumsum(lengths)))


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of some stretches, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _seeded(keys: np.ndarray, use: int) -> np.ndarray:
    return mix(mix(keys) + np.uint64(use))


def _sides(lattice: Lattice, paths: Paths, start: np.ndarray, score: np.ndarray, seeds: np.ndarray, width: int):
    """Of the first ``width`` edges of each path: log mass before, and the score of the set that leaves there.

    Sets that leave before ``start`` belong to earlier paths. Last, whether a path
    goes on beyond the width with a mass that counts.
    """
    lengths = np.diff(paths.begins)
    columns = np.arange(width)
    inside = columns[None, :] < lengths[:, None]
    at = np.minimum(paths.begins[:-1, None] + columns[None, :], max(len(paths.edges) - 1, 0))
    log = np.where(inside, lattice.log_chance[paths.edges[at]], 0.0)
    reached = np.cumsum(log, axis=1)
    before = reached - log
    other = np.where(inside, np.maximum(1 - lattice.chance[paths.edges[at]], 0.0), 0.0)
    other[(other < 1e-12) | (columns[None, :] < start[:, None])] = 0.0
    with np.errstate(divide="ignore"):
        location = before + np.log(other)
    draws = uniform(seeds[:, None] + columns.astype(np.uint64)[None, :])
    too_short = (lengths > width) & (reached[:, -1] > LEAST_LOG_MASS)
    return before, _bounded(location, score[:, None], draws), too_short


def top_paths(lattice: Lattice, fresh: list[Paths], keys: np.ndarray, width: int):
    """Each text's paths with the highest perturbed scores, one after the other, for all texts at once.

    ``fresh`` holds as many independent paths of every text as are wanted; parts of
    them continue a path after it has left an earlier one. Returns the paths, whether
    each text has them, the best score left over, and which texts need a larger width.
    """
    n = len(keys)
    rows = np.arange(n)
    score = -np.log(-np.log(uniform(_seeded(keys, 1))))
    before, side, short = _sides(lattice, fresh[0], np.zeros(n, np.int64), score, _seeded(keys, 2), width)
    found, has = [fresh[0]], [np.ones(n, bool)]
    befores, sides = [before], [side]
    taken: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(n)]
    while True:
        best_at = np.array([s.argmax(axis=1) for s in sides])
        best_score = np.array([s[rows, t] for s, t in zip(sides, best_at)])
        best = best_score.argmax(axis=0)
        score = best_score[best, rows]
        number, alive = len(found), ~np.isneginf(score)
        if number == len(fresh) or not alive.any():
            return found, has, score, short
        t = best_at[best, rows]
        # Where each text leaves: the edge there, and those taken from that place before.
        pool = Paths(np.concatenate([p.edges for p in found]), np.concatenate([p.units for p in found]), np.zeros(0))
        base = np.cumsum([0] + [len(p.edges) for p in found[:-1]])
        origin = np.array([b + p.begins[:-1] for b, p in zip(base, found)])[best, rows]
        left_edge = pool.edges[np.minimum(origin + t, len(pool.edges) - 1)]
        node = lattice.source[left_edge]
        gone = np.full((n, number), -1)
        for i in np.flatnonzero(alive):
            own = taken[i].setdefault((int(best[i]), int(t[i])), [int(left_edge[i])])
            gone[i, : len(own)] = sorted(own)
        mass = np.where(gone >= 0, lattice.chance[gone], 0.0)
        first, last = lattice.first[node], lattice.first[node + 1] - 1
        below = np.where(first > 0, lattice.reached[first - 1], 0.0)
        wanted = below + uniform(_seeded(keys, 10 * number)) * np.maximum(lattice.reached[last] - below - mass.sum(1), 0.0)
        for c in range(number):  # step over the edges taken before, in order
            over = (gone[:, c] >= 0) & (wanted >= np.where(gone[:, c] > 0, lattice.reached[gone[:, c] - 1], 0.0))
            wanted = np.where(over, wanted + mass[:, c], wanted)
        edge = np.clip(np.searchsorted(lattice.reached, wanted, side="right"), first, last)
        clash = alive & (edge[:, None] == gone).any(1)
        for i in np.flatnonzero(clash):  # rounding at an edge's border
            edge[i] = next(e for e in range(first[i], last[i] + 1) if e not in gone[i])
        for i in np.flatnonzero(alive):
            taken[i][(int(best[i]), int(t[i]))].append(int(edge[i]))
        mass_left = 1 - mass.sum(1) - lattice.chance[edge]
        with np.errstate(divide="ignore"):
            place = np.where(mass_left > 1e-12, np.log(np.maximum(mass_left, 1e-300)), -np.inf) + np.array(
                [b[rows, np.minimum(t, b.shape[1] - 1)] for b in befores]
            )[best, rows]
        again = _bounded(place, score, uniform(_seeded(keys, 10 * number + 1)))
        for p, s in enumerate(sides):
            chosen = alive & (best == p)
            s[rows[chosen], t[chosen]] = again[chosen]
        # Beginning of the earlier path, the new edge, the rest of its unit, then a fresh tail.
        target = lattice.target[edge]
        going = np.flatnonzero(alive & ~lattice.ends[target])
        rest, rest_begins = walk(lattice, target[going], _seeded(keys[going], 10 * number + 2))
        rest_start, rest_length = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rest_start[going], rest_length[going] = rest_begins[:-1], np.diff(rest_begins)
        unit = pool.units[np.minimum(origin + t, len(pool.units) - 1)]
        new = fresh[number]
        text_of = np.repeat(rows, np.diff(new.begins))
        tail_length = np.bincount(text_of[new.units > unit[text_of]], minlength=n)
        parts = np.concatenate((pool.edges, edge, rest, new.edges))
        offsets = np.cumsum([len(pool.edges), n, len(rest)])
        starts = np.column_stack((origin, offsets[0] + rows, offsets[1] + rest_start, offsets[2] + new.begins[1:] - tail_length))
        lengths = np.column_stack((t, np.ones(n, np.int64), rest_length, tail_length)) * alive[:, None]
        units = np.concatenate((pool.units, unit, np.repeat(unit[going], np.diff(rest_begins)), new.units))
        at = _stretches(starts.ravel(), lengths.ravel())
        path = Paths(parts[at], units[at], np.append(0, np.cumsum(lengths.sum(1))))
        before, side, more = _sides(lattice, path, t + 1, score, _seeded(keys, 10 * number + 3), width)
        short |= more & alive
        found.append(path)
        has.append(alive)
        befores.append(before)
        sides.append(np.where(alive[:, None], side, -np.inf))


def _ids(lattice: Lattice, paths: Paths, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all paths and where each begins; an edge without a piece is spelled in bytes."""
    ids = lattice.piece[paths.edges]
    bare = ids == FALLBACK
    begin = lattice.byte_of[lattice.source[paths.edges]]
    sizes = np.ones(len(ids), np.int64)
    sizes[bare] = lattice.byte_of[lattice.target[paths.edges[bare]]] - begin[bare]
    reached = np.append(0, np.cumsum(sizes))
    out = np.repeat(ids, sizes)
    spelled = np.flatnonzero(np.repeat(bare, sizes))
    out[spelled] = byte_ids[lattice.data[_stretches(begin[bare], sizes[bare])]]
    return out, reached[paths.begins]


def _units(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts, a space put before each, and each text's first unit."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    spaced = pc.if_else(pc.equal(pc.binary_length(column), 0), column, pc.binary_join_element_wise(space, column, nothing))
    data, offsets = buffer_of(spaced)
    space = data == SPACE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts, len(data))
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))
    return units, np.searchsorted(starts, offsets)


def sample_texts(column: pa.Array, keys: np.ndarray, words: Vocabulary, k: int) -> Iterator[list[tuple[np.ndarray, float, float]]]:
    """For each text its samples: ids, log chance, inclusion."""
    units, first = _units(column)
    if not len(units):
        yield from ([(np.zeros(0, np.int64), 0.0, 1.0)] for _ in range(len(column)))
        return
    encoded = units.dictionary_encode()
    lattice = build_lattice(encoded.dictionary, words)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(units)) - np.repeat(first[:-1], counts)
    nodes = lattice.starts[np.asarray(encoded.indices)]
    fresh, order = [], np.argsort(nodes, kind="stable")
    for n in range(k):
        edges, begins = walk(lattice, nodes, mix(_seeded(keys, 1000 + n)[owner] + place.astype(np.uint64)), order)
        fresh.append(Paths(edges, np.repeat(place, np.diff(begins)), begins[first]))
    out: list[list[tuple[np.ndarray, float, float]]] = [[(np.zeros(0, np.int64), 0.0, 1.0)] for _ in range(len(column))]
    todo, width = np.flatnonzero(counts), WIDTH
    while len(todo):
        later = []
        for part in np.array_split(todo, -(-len(todo) * width // CELLS)):
            paths, has, left, short = top_paths(lattice, [f.of(part) for f in fresh], keys[part], width)
            later.append(part[short])
            ids = [(*_ids(lattice, p, words.byte_ids), np.add.reduceat(np.append(lattice.log_chance[p.edges], 0.0), p.begins[:-1])) for p in paths]
            for row in np.flatnonzero(~short):
                own = []
                for (values, begins, totals), exists in zip(ids, has):
                    if exists[row]:
                        total = float(totals[row])
                        inclusion = 1.0 if np.isneginf(left[row]) else -math.expm1(-math.exp(min(total - left[row], 700.0)))
                        own.append((values[begins[row] : begins[row + 1]], total, inclusion))
                out[part[row]] = own
        todo, width = np.concatenate(later), width * 4
    yield from out


def decode(ids: np.ndarray, pieces: list[bytes | None]) -> str:
    """The text of some piece ids."""
    text = b"".join([pieces[i] or b"" for i in ids.tolist()])
    return (text[1:] if text[:1] == b" " else text).decode(errors="replace")


FIELDS = [
    T.StructField("n_pieces", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("log_chance", T.DoubleType()),
    T.StructField("inclusion", T.DoubleType()),
]
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def sample_segments(
    docs: DataFrame, into: str = "segments", key: str = "doc_id", text: str = "text", k: int = SAMPLES,
    model: str = MODEL_FILE, with_ids: bool = True, keep_text: bool = True,
) -> DataFrame:
    """Add an array of sampled segmentations, best perturbed score first, and ``round_trip``.

    ``round_trip`` says that every sample decodes to the text.
    """
    kept = [f for f in docs.schema.fields if f.name not in (into, "round_trip", "__seed") and (keep_text or f.name != text)]
    names = [f.name for f in kept]
    fields = [*FIELDS, *([IDS] if with_ids else [])]
    struct = T.ArrayType(T.StructType(fields))
    schema = T.StructType([*kept, T.StructField(into, struct), T.StructField("round_trip", T.BooleanType())])
    arrow = {"n_pieces": pa.int64(), "ids_sha256": pa.string(), "log_chance": pa.float64(), "inclusion": pa.float64(), "ids": pa.list_(pa.int32())}
    kind = pa.list_(pa.struct([(f.name, arrow[f.name]) for f in fields]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces = read_vocabulary(model), piece_bytes(model)
        for batch in batches:
            column, seeds = text_column(batch, text), mix(np.asarray(batch.column("__seed")).astype(np.int64).view(np.uint64))
            for start, stop in slices(column, SLICE):
                rows, same = [], []
                texts = column[start:stop].to_pylist()
                for own, samples in zip(texts, sample_texts(column[start:stop], seeds[start:stop], words, k)):
                    same.append(all(decode(ids, pieces) == (own or "") for ids, _, _ in samples))
                    rows.append(
                        [
                            {
                                "n_pieces": len(ids),
                                "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                "log_chance": total,
                                "inclusion": inclusion,
                                **({"ids": ids.astype(np.int32)} if with_ids else {}),
                            }
                            for ids, total, inclusion in samples
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n)[start:stop] for n in names] + [pa.array(rows, kind), pa.array(same, pa.bool_())],
                    [*names, into, "round_trip"],
                )

    return docs.withColumn("__seed", F.xxhash64(key)).mapInArrow(shared.given_back(add), schema)


def decode_segments(docs: DataFrame, ids: str = "ids", into: str = "text", model: str = MODEL_FILE) -> DataFrame:
    """Add the text of an array of piece ids; null ids give null."""
    kept = [f for f in docs.schema.fields if f.name != into]
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_bytes(model)
        for batch in batches:
            texts = [None if x is None else decode(np.array(x, np.int64), pieces) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string())], [*names, into])

    return docs.mapInArrow(add, T.StructType([*kept, T.StructField(into, T.StringType())]))


DIGESTS = ("n_samples", "n_pieces", "ids_sha256", "log_chance", "inclusion", "log_chances", "inclusions", "round_trip")


def digest_columns(into: str = "segments") -> list:
    """A row's samples as plain columns; ``log_chance`` and ``inclusion`` are those of the first."""
    each = lambda name: F.transform(into, lambda s: s[name])
    return [
        F.size(into).cast("long").alias("n_samples"),
        F.array_join(F.transform(each("n_pieces"), lambda n: n.cast("string")), ",").alias("n_pieces"),
        F.array_join(each("ids_sha256"), ",").alias("ids_sha256"),
        F.element_at(each("log_chance"), 1).alias("log_chance"),
        F.element_at(each("inclusion"), 1).alias("inclusion"),
        F.array_join(F.transform(each("log_chance"), lambda x: x.cast("string")), ",").alias("log_chances"),
        F.array_join(F.transform(each("inclusion"), lambda x: x.cast("string")), ",").alias("inclusions"),
        "round_trip",
    ]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return sample_segments(docs, with_ids=False, keep_text=False).select("doc_id", *digest_columns())
