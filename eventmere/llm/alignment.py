"""Alignment of two tokenizers over the same bytes, and how often their ids are linked.

Tokens of A and of B cut a text's bytes in two ways. Merging both lists of token ends
gives all cuts; each stretch between two cuts lies in one token of A and one of B, so
it is the one link between them, and where both lists have a cut a group of tokens
ends. The merge of a slice of texts is divided by merge paths: binary searches along
diagonals of the two lists find where each piece of ``PIECE`` ends begins, whatever the
lengths of texts, and a cut that both lists have is never divided. Pieces are worked
off independently, each emits its overlaps and the group ends it has seen, and groups
that reach over pieces are put together from the group ends in order.

Links of an id pair are counted over the whole corpus: every block of documents sends
its distinct pairs to buckets by pair, which answer with totals (``exchange.py``). The
highest count of each B id, one number per entry of the vocabulary, is all that is
broadcast.

Cases: null and empty texts, and texts that one of the tokenizers does not give back
byte by byte (such as U+2581, which B takes for a space), have no tokens and no
groups; equal rows and equal ids are counted each; a null id is kept; a very long text
makes more pieces, not larger ones, and its pairs are kept once with their numbers; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import exchange, shared
from eventmere.llm.encoding import KNOWN, WHITE, Encoder, drop_most, file_bytes, library, no_collection, vocabulary_file
from eventmere.llm.texts import slices, text_column

#: Token ends of A and B that one piece of a merge holds.
PIECE = 1 << 16
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 12_000_000

#: An odd number, whose products spread pairs over buckets, and its inverse modulo 2**64.
SPREAD = 0x9E3779B97F4A7C15
GATHER = pow(SPREAD, -1, 1 << 64)

LINKS_DDL = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# -- vocabularies -------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """Byte-level letters: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Byte-level tokens of a JSON file; strings of special tokens in a text are plain text."""

    #: White space after which, or before which, a piece of text may not be cut.
    unsafe = frozenset()

    def __init__(self, blob: bytes, pattern: str | None = None):
        letters, config = _byte_letters(), json.loads(blob)
        found = library().from_str(blob.decode()).get_vocab(with_added_tokens=True)
        special = {t["content"] for t in config.get("added_tokens", [])}
        self.tokens = [b""] * (max(found.values()) + 1)
        for name, i in found.items():
            self.tokens[i] = name.encode() if name in special else bytes(letters[c] for c in name)
        self.encoder = Encoder(blob, 4, pattern, plain_special=True)

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin with the space both tokenizers start with."""
        return self.encoder.texts(texts)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        return self.encoder.pieces(pieces)


class PieceTokens:
    """Pieces of a model file, which puts a space before each text itself."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.tokens, self.unsafe = [], set()
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            own = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            self.tokens.append(own)
            # A piece that reaches over the beginning of white space.
            self.unsafe.update(re.findall(f"[^{WHITE}]([{WHITE}])", piece.replace("▁", " ")))
        self.space = self.model.piece_to_id("▁")

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin with the space the model adds."""
        return self._serialized(self.model.encode([t[1:] for t in texts], num_threads=1))

    def pieces(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of pieces; those without a space in front must do without the one the model adds."""
        found = self.model.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        bare = {n: ids[:1] == [self.space] for n, (p, ids) in enumerate(zip(pieces, found)) if p[0] != " "}
        data = self._serialized([ids[1:] if n in bare else ids for n, ids in enumerate(found)])
        return [d if bare.get(n, True) else None for n, d in enumerate(data)]

    def _serialized(self, found: list[list[int]]) -> list[bytes]:
        data = np.array([i for ids in found for i in ids], "<u4").tobytes()
        edges = np.cumsum([0, *[4 * len(ids) for ids in found]]).tolist()
        return [data[i:j] for i, j in zip(edges, edges[1:])]


# -- merging ------------------------------------------------------------------


def cut_paths(a: np.ndarray, b: np.ndarray, piece: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists is cut into pieces: places in both lists.

    A piece has ``piece`` elements, one more or one less. Equal elements of both lists
    come in one piece.
    """
    piece = piece or PIECE
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        # Elements of A come first among equals: more of A are taken while A[i] <= B[d - i - 1].
        i = (low + high) // 2
        at, other = np.minimum(i, max(len(a) - 1, 0)), np.clip(diagonal - i - 1, 0, max(len(b) - 1, 0))
        more = open_ & (a[at] <= b[other])
        low, high = np.where(more, i + 1, low), np.where(open_ & ~more, i, high)
    i, j = low, diagonal - low
    # If A's copy is the last of a piece, B's equal element comes with it.
    parted = (i > 0) & (j < len(b))
    parted[parted] = a[i[parted] - 1] == b[j[parted]]
    return i, j + parted


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All cuts of one piece: the token of A and of B that each ends or lies in, and whether both end."""
    cuts = np.concatenate([a, b])
    cuts.sort(kind="stable")
    if len(cuts):
        cuts = cuts[np.r_[True, cuts[1:] != cuts[:-1]]]
    i, j = np.searchsorted(a, cuts), np.searchsorted(b, cuts)
    both = np.zeros(len(cuts), bool)
    inside = (i < len(a)) & (j < len(b))
    both[inside] = (a[i[inside]] == cuts[inside]) & (b[j[inside]] == cuts[inside])
    return i, j, both


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of A and of B of every link in order, and whether a group ends with it.

    Both lists of ends go up and end at the same byte.
    """
    at_a, at_b = cut_paths(a, b)
    found = []
    for i, i_end, j, j_end in zip(at_a, at_a[1:], at_b, at_b[1:]):
        own_a, own_b, both = overlaps(a[i:i_end], b[j:j_end])
        found.append((own_a + i, own_b + j, both))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found))


# -- one slice of texts -------------------------------------------------------


class Aligner:
    """Links, groups and pairs of whole texts."""

    def __init__(self, a, b):
        self.a, self.b, self.width = a, b, len(b.tokens)
        self.cut = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.sizes = [np.array([len(t) for t in x.tokens]) for x in (a, b)]
        # A token with what follows it: "," inside its side, "|" after side A, ";" after side B.
        self.written = [b"%d%c" % (i, c) for i in range(max(len(a.tokens), len(b.tokens))) for c in b",|;"]

    def _learn(self, pieces: set[str]) -> None:
        """Ids by A and B of pieces not seen before; None where one does not give the piece back, or cannot tell."""
        self.known = known = drop_most(self.known, pieces, KNOWN)
        new = list(pieces - known.keys())
        by_a, by_b = self.a.pieces(new), self.b.pieces(new)
        same = self._give(new, by_a, 0) & self._give(new, [b or b"" for b in by_b], 1)
        known.update((p, (a, b) if s else None) for p, a, b, s in zip(new, by_a, by_b, same.tolist()))

    def _give(self, texts: list[str], found: list[bytes], side: int) -> np.ndarray:
        """Whether the bytes of each text's tokens are those of the text."""
        tokens = (self.a, self.b)[side].tokens
        ids = np.frombuffer(b"".join(found), "<u4")
        given = b"".join(map(tokens.__getitem__, ids.tolist()))
        whole = [t.encode() for t in texts]
        # Equal as a whole and text by text equally long: then all are equal.
        edges = np.cumsum([0, *[len(f) // 4 for f in found]])
        reached = np.append(0, np.cumsum(self.sizes[side][ids]))[edges]
        if given == b"".join(whole) and np.array_equal(reached[1:], np.cumsum([len(w) for w in whole])):
            return np.ones(len(texts), bool)
        return np.array([given[i:j] == w for w, i, j in zip(whole, reached, reached[1:])], bool)

    def _ids(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids by A and B, none where the tokens' bytes are not those of the text.

        Both tokenizers cut before white space that follows anything else, so a text is
        put together from pieces, each encoded once. A text with white space that is
        no such place, or a piece that is not given back alone, is encoded as a whole.
        """
        whole = [" " + t for t in texts]
        unsafe = self.a.unsafe | self.b.unsafe
        pieces = [self.cut.findall(t) if unsafe.isdisjoint(t) else None for t in whole]
        self._learn(set().union(*[p for p in pieces if p]))
        found: list[tuple[bytes, bytes]] = [(b"", b"")] * len(texts)
        left = []
        for n, (text, own) in enumerate(zip(texts, pieces)):
            ids = [self.known[p] for p in own] if own else [None]
            if not text:
                continue
            if None in ids:
                left.append(n)
            else:
                found[n] = tuple(map(b"".join, zip(*ids)))
        rest = [whole[n] for n in left]
        by_a, by_b = self.a.texts(rest), self.b.texts(rest)
        same = self._give(rest, by_a, 0) & self._give(rest, by_b, 1)
        for n, a, b, s in zip(left, by_a, by_b, same.tolist()):
            found[n] = (a, b) if s else (b"", b"")
        return found

    def align(self, texts: list[str]) -> dict[str, pa.Array]:
        found = self._ids(texts)
        n_a, n_b = (np.array([len(f[k]) // 4 for f in found], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.frombuffer(b"".join(f[k] for f in found), "<u4").astype(np.int64) for k in (0, 1))
        # Ends over the whole slice: texts follow each other, and end together in A and B.
        link_a, link_b, ends = merged(np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b]))
        doc_ends = np.cumsum(n_a)
        doc = np.searchsorted(doc_ends, link_a, side="right")
        n_links = np.bincount(doc, minlength=len(texts))
        n_groups = np.bincount(doc[ends], minlength=len(texts))
        all_pairs = len(self.a.tokens) * self.width
        pair = doc * all_pairs + ids_a[link_a] * self.width + ids_b[link_b]
        pair.sort()
        heads = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, int)
        times = np.diff(np.append(heads, len(pair)))
        edges = np.searchsorted(pair[heads], np.arange(len(texts) + 1) * all_pairs)
        return {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b),
            "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
            "groups_sha256": pa.array(self._groups(ids_a, ids_b, link_a[ends], link_b[ends], n_a + n_b), pa.string()),
            "pairs": _binaries((pair[heads] % all_pairs).astype(pair_type(self.width, len(self.a.tokens))), edges),
            "times": _binaries(times.astype("<u4"), edges),
        }

    def _groups(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, tokens: np.ndarray) -> list[str]:
        """The hash of each text's groups; ``last_a`` and ``last_b`` are the last tokens of all groups."""
        count_a, count_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        # A token of A is written after the B tokens of earlier groups, one of B after the A tokens of its own too.
        place_a = np.arange(len(ids_a)) + np.repeat(np.cumsum(count_b) - count_b, count_a)
        place_b = np.arange(len(ids_b)) + np.repeat(np.cumsum(count_a), count_b)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[place_a], codes[place_b] = ids_a * 3, ids_b * 3
        codes[place_a[last_a]] += 1
        codes[place_b[last_b]] += 2
        out, at, written = [], 0, self.written
        for end in np.cumsum(tokens).tolist():
            line = b"".join(map(written.__getitem__, codes[at:end].tolist()))[:-1]
            out.append(hashlib.sha256(line).hexdigest() if line else "")
            at = end
        return out


def pair_type(width_b: int, width_a: int) -> str:
    """How pairs are stored: in four bytes if all pairs of two vocabularies have numbers that fit."""
    return "<u4" if width_a * width_b < 1 << 32 else "<u8"


def _binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Neighbouring stretches of one array as binary values."""
    places = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(places), pa.py_buffer(values)])


# -- counts over the corpus ---------------------------------------------------


def _numbers(table: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and their numbers in some documents, and where each document's begin and the last ends."""
    pairs, times = (table.column(n).to_pylist() for n in ("pairs", "times"))
    edges = np.cumsum([0, *[len(t) // 4 for t in times]])
    return np.frombuffer(b"".join(pairs), kind).astype(np.uint64), np.frombuffer(b"".join(times), "<u4").astype(np.int64), edges


def _spread(pairs: np.ndarray) -> np.ndarray:
    return pairs * np.uint64(SPREAD)


def best_counts(sent: DataFrame, width: int) -> np.ndarray:
    """For each B id, the highest count of a pair that holds it; as long as the vocabulary."""

    def highest(table: pa.Table) -> pa.Table:
        _, totals, leading = exchange.totals(table)
        keys = np.concatenate([exchange.unpack(k, len(c) // 4)[0] for k, c in zip(*(table.column(n).to_pylist() for n in ("keys", "counts")))])
        order = np.argsort(ids := ((keys[leading] * np.uint64(GATHER)) % np.uint64(width)).astype(np.int64), kind="stable")
        ids, own = ids[order], totals[leading][order]
        heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        return pa.table({"b": pa.array(ids[heads]), "best": pa.array(np.maximum.reduceat(own, heads), pa.int64())})

    own = sent.groupBy("bucket").applyInArrow(highest, "b long, best long")
    best = np.zeros(width, np.int64)
    for row in own.groupBy("b").agg(F.max("best").alias("best")).collect():
        best[row["b"]] = row["best"]
    return best


def align(
    docs: DataFrame, make: Callable[[bytes, bytes], Aligner], file_a: bytes, file_b: bytes,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key`` and the columns of ``RESULT`` for every document.

    ``make`` builds the aligner of two vocabulary files.
    """
    spark = docs.sparkSession
    plain = make(file_a, file_b)
    width, kind = plain.width, pair_type(plain.width, len(plain.a.tokens))
    key_type = docs.schema[key].dataType
    docs = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    blocks = shared.block_count(docs, "text", BLOCK_BYTES)
    files = spark.sparkContext.broadcast((file_a, file_b))
    names = [f.split()[0] for f in LINKS_DDL.split(", ")]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make(*files.value)
        for batch in batches:
            column = text_column(batch, "text")
            for start, stop in slices(column, SLICE_BYTES):
                with no_collection():
                    found = aligner.align([t or "" for t in column[start:stop].to_pylist()])
                own = [text_column(batch, c)[start:stop] for c in ("doc", "row")]
                yield pa.RecordBatch.from_arrays([*own, *[found[n] for n in names]], ["doc", "row", *names])

    ddl = f"doc {key_type.simpleString()}, row long, {LINKS_DDL}"
    linked = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(link, ddl)
    # By row, so that equal rows are in different blocks.
    linked = shared.stored(linked.withColumn("block", shared.block_of(blocks, "row")).drop("row"), "alignment-links")

    def ask(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        pairs, times, _ = _numbers(table, kind)
        return exchange.send(group[0].as_py(), *exchange.grouped(_spread(pairs), np.zeros_like(pairs), times), blocks)

    sent = linked.select("block", "pairs", "times").groupBy("block").applyInArrow(ask, exchange.SENT_DDL)
    sent = shared.stored(sent, "alignment-pairs")
    best = spark.sparkContext.broadcast(best_counts(sent, width))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def answer(table: pa.Table, found: pa.Table) -> pa.Table:
        pairs, times, edges = _numbers(table, kind)
        known = exchange.Totals(found, *exchange.grouped(_spread(pairs), np.zeros_like(pairs), times)[:2])
        counts = known.of(_spread(pairs), np.zeros_like(pairs))
        top = counts == best.value[(pairs % np.uint64(width)).astype(np.int64)]
        total = lambda v: pa.array(np.diff(np.append(0, np.cumsum(v))[edges]), pa.int64())
        kept = {n: table.column(n) for n in ("doc", *numbers)}
        return pa.table({**kept, "n_best": total(times * top), "count_sum": total(times * counts), "groups_sha256": table.column("groups_sha256")})

    out_ddl = f"doc {key_type.simpleString()}, " + ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in RESULT)
    counted = linked.groupBy("block").cogroup(exchange.answers(sent).groupBy("block")).applyInArrow(answer, out_ddl)
    return counted.select(F.col("doc").alias(key), *RESULT)


#: How byte-level tokenizers cut a text before merging.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_and_piece(file_a: bytes, file_b: bytes) -> Aligner:
    return Aligner(ByteTokens(file_a, BYTE_PATTERN), PieceTokens(file_b))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    file_a, file_b = (file_bytes(vocabulary_file(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(docs, byte_and_piece, file_a, file_b)
