"""Token ids in binary shards: every document compressed alone with one shared dictionary.

All ids of a corpus are written once, in ascending order of the documents' ids. A
shard holds about ``SHARD_IDS`` ids of neighbouring documents; each document is one
zstandard frame of its serialized ids, so a short document is read without its
neighbours. What short arrays have in common is in a dictionary trained on pieces of
serialized id arrays, drawn evenly from all of them.

A shard file is::

    magic                      8 bytes
    header length              4 bytes, little-endian
    header                     JSON: width of an id in bytes, id at the end, SHA-256 of the dictionary
    frames                     one per document
    offset index               zstandard: documents' ids, their nulls, frame ends, numbers of ids
    index place, documents     8 bytes each, little-endian

The store is the shards, the dictionary under its hash, and a table of the offset
indexes of all shards. A reader refuses a shard made with another dictionary.

Tasks write files under a name of their own per attempt; a file is in the store only
if its task ended well. The dictionary is trained on at most about ``SAMPLE_PIECES``
pieces of ``PIECE_BYTES``, in the driver; it decides sizes only. All else, counts and
offsets among it, is worked out for all documents in tasks.

Cases: a null or empty text has the end id only; null ids come first, equal ids are
ordered by their ids' digest, equal rows are kept each; a very long text is one frame
in a shard of its own size; an empty table gives an empty store; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmere.llm import shared
from eventmere.llm.encoding import KNOWN, MARKS, Encoder, Recent, file_bytes, library, no_collection, vocabulary_file
from eventmere.llm.texts import LOWER, SPACE, mix, read_words, slices, text_column
from eventmere.llm.texts import Words as TextWords
from eventmere.sources import paths

MAGIC = b"IDSTORE1"
#: Ids that a shard should hold.
SHARD_IDS = 8_000_000
#: Pieces that train the dictionary, about; bytes of one; bytes of the dictionary.
SAMPLE_PIECES = 2000
PIECE_BYTES = 4096
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: File bytes that a task of the encoding should read.
TASK_BYTES = 48 << 20
#: Shards whose totals are added up in one window.
RUN = 1000

#: What a byte adds to the count of letters, and of marks, of a word; any other byte adds to neither.
_LETTER, _MARK, _OTHER = 1, 1 << 21, 1 << 42
_BYTE_KINDS = np.zeros(256, np.int64)
_BYTE_KINDS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
_BYTE_KINDS[list(MARKS.encode())] = _MARK

IDS_DDL = "doc long, ids binary, n_ids long, row long"
INDEX_DDL = "shard int, file string, doc long, place long, length long, n_ids long"
READ_DDL = "shard int, doc long, before long, n_ids long, ids binary"


def id_width(tokenizer: bytes, end_id: int) -> int:
    """Bytes that hold any id of a vocabulary file."""
    most = max(library().from_str(tokenizer.decode()).get_vocab(with_added_tokens=True).values(), default=0)
    return 2 if max(most, end_id) < 1 << 16 else 4


def word_pattern(tokenizer: bytes) -> str | None:
    """The pattern by which a file cuts words, if it makes lower case, drops white space and never joins over it."""
    config = json.loads(tokenizer)
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if [n["type"] for n in steps] != ["NFC", "Replace", "Lowercase"] or steps[1] != spaces:
        return None
    if [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[1].get("use_regex") or cuts[1].get("add_prefix_space"):
        return None
    split = cuts[0]
    if (split["behavior"], split["invert"]) != ("Removed", True) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"]):
        return None
    return split["pattern"].get("Regex")


class Words:
    """Serialized ids of texts by a file that cuts words; each distinct word ``[^\x20\x09-\x0D]+`` is encoded once.

    Of words of plain letters with marks after them the letters, in lower case, and the marks are looked up.
    """

    def __init__(self, tokenizer: bytes, width: int):
        self.pattern = word_pattern(tokenizer)
        self.encoder = Encoder(tokenizer, width, self.pattern, lower=True)
        self.known, self.width = Recent(), width
        special = [t["content"] for t in json.loads(tokenizer).get("added_tokens", [])]
        self.cuts = all(_BYTE_KINDS[np.frombuffer(s.encode(), np.uint8)].min(initial=1) == 0 for s in special)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        ids, edges = self.ids(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        return [ids[i:j].tobytes() for i, j in zip(edges.tolist(), edges[1:].tolist())]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin; nulls have none."""
        kind = f"<u{self.width}"
        if self.pattern is None:
            found = self.encoder.texts([t or "" for t in column.to_pylist()])
            return np.frombuffer(b"".join(found), kind), np.cumsum([0, *map(len, found)]) // self.width
        units, first = self._units(read_words(column))
        encoded = units.dictionary_encode()
        asked = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.known.renew(KNOWN)
        known = self.known.new
        if new := self.known.absent(asked):
            known.update(zip(new, self.encoder.pieces(b" ".join(new).decode().split(" "))))
        blobs = list(map(known.__getitem__, asked))
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // self.width
        begins, at = np.cumsum(sizes) - sizes, np.asarray(encoded.indices)
        reached = np.append(0, np.cumsum(sizes[at]))
        places = np.repeat(begins[at] - reached[:-1], sizes[at]) + np.arange(reached[-1])
        return np.frombuffer(b"".join(blobs), kind)[places], reached[first]

    def _units(self, words: TextWords) -> tuple[pa.Array, np.ndarray]:
        """What is looked up of all words, and the first of each text."""
        data, lengths = words.data[~SPACE[words.data]], words.ends - words.starts
        begins, kinds = np.cumsum(lengths) - lengths, _BYTE_KINDS[data]
        # Letters, marks, and marks before a letter of the same word, counted in one sum.
        before = kinds[:-1] == _MARK
        before &= kinds[1:] == _LETTER
        before[begins[1:] - 1] = False
        kinds[:-1][before] += _OTHER
        counted = np.append(0, np.cumsum(kinds))
        counted = counted[begins + lengths] - counted[begins]
        letters, marks = counted % _MARK, counted % _OTHER // _MARK
        simple = (letters + marks == lengths) & (counted < _OTHER) & self.cuts
        data = np.where(np.repeat(simple, lengths), LOWER[data], data)
        both = simple & (letters > 0) & (marks > 0)
        place = np.append(0, np.cumsum(1 + both))
        edges = np.full(place[-1] + 1, len(data), np.int64)
        edges[place[:-1]] = begins
        edges[place[:-1][both] + 1] = (begins + letters)[both]
        buffers = [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes())]
        return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers), place[words.first]


def large_tasks(docs: DataFrame, size: int = TASK_BYTES) -> DataFrame:
    """The documents in tasks of at least ``size`` file bytes, as long as all cores have one.

    Words repeat, so a task that sees more text encodes fewer of its words.
    """
    spark = docs.sparkSession
    parts = docs.rdd.getNumPartitions()
    whole = -(-parts * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() // size)
    return docs.coalesce(min(parts, max(1, whole, spark.sparkContext.defaultParallelism)))


def encode(
    docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, int]:
    """The serialized ids of every document, end id included, stored; and an id's width."""
    blob = file_bytes(tokenizer)
    width = id_width(blob, end_id)
    sent = docs.sparkSession.sparkContext.broadcast(blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Words(sent.value, width)
        for batch in batches:
            column, ids, rows = (text_column(batch, c) for c in ("text", "doc", "row"))
            for start, stop in slices(column):
                with no_collection():
                    found, edges = encoder.ids(column[start:stop])
                found, edges = np.insert(found, edges[1:], end_id), edges + np.arange(len(edges))
                buffers = [None, pa.py_buffer((edges * width).tobytes()), pa.py_buffer(found.tobytes())]
                blobs = pa.Array.from_buffers(pa.large_binary(), stop - start, buffers).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids[start:stop], blobs, pa.array(np.diff(edges)), rows[start:stop]], ["doc", "ids", "n_ids", "row"]
                )

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = large_tasks(rows).withColumn("row", F.monotonically_increasing_id())
    return shared.stored(rows.mapInArrow(shared.given_back(run), IDS_DDL), "token-ids"), width


def _train(pieces: list[bytes]) -> bytes:
    """A dictionary of the pieces; of very few of them, the pieces themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def drawn(rows: np.ndarray, arrays: pa.Array, limit: np.uint64) -> list[bytes]:
    """The pieces of some rows' serialized arrays whose lots, by row and place, are not above the limit."""
    counts = -(-pc.binary_length(arrays).to_numpy(zero_copy_only=False).astype(np.int64) // PIECE_BYTES)
    own = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    lots = mix(mix(rows.astype(np.uint64))[own] + place.astype(np.uint64))
    hits = np.flatnonzero(lots <= limit)
    return [
        bytes(memoryview(arrays[n].as_buffer())[i * PIECE_BYTES : (i + 1) * PIECE_BYTES])
        for n, i in zip(own[hits].tolist(), place[hits].tolist())
    ]


def train_dictionary(ids: DataFrame, width: int) -> bytes:
    """A dictionary from pieces of serialized arrays, each taken with the same chance.

    About ``SAMPLE_PIECES`` pieces reach the driver, whatever the corpus.
    """
    # Its ids tell an array's length, so that the arrays themselves are read once.
    total = ids.agg(F.sum(F.ceil(F.col("n_ids") * width / PIECE_BYTES))).first()[0] or 0
    limit = np.uint64(min(1.0, SAMPLE_PIECES / max(total, 1)) * float(2**64 - 2**11))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = drawn(np.asarray(batch.column("row")), batch.column("ids"), limit)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["piece"])

    pieces = ids.select("row", "ids").mapInArrow(draw, "piece binary").collect()
    return _train(sorted(bytes(r["piece"]) for r in pieces))


def _dictionary(blob: bytes) -> zstandard.ZstdCompressionDict | None:
    """Pieces put together as they are also work as a dictionary; nothing at all is none."""
    return zstandard.ZstdCompressionDict(blob) if blob else None


def _packer(blob: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(blob), write_checksum=True)


def _unpacker(blob: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(blob))


def _header(width: int, end_id: int, dictionary: bytes) -> bytes:
    head = {"dictionary_sha256": hashlib.sha256(dictionary).hexdigest(), "end_id": end_id, "width": width}
    text = json.dumps(head, sort_keys=True).encode()
    return MAGIC + len(text).to_bytes(4, "little") + text


class _Shard:
    """A shard file being written."""

    def __init__(self, system, top: str, head: bytes):
        self.file = f"{uuid.uuid4().hex}.ids"
        system.create_dir(top, recursive=True)
        self.out = system.open_output_stream(f"{top}/{self.file}", compression=None)
        self.out.write(head)
        self.at = len(head)
        self.docs: list[int | None] = []
        self.ends: list[int] = []
        self.counts: list[int] = []

    def add(self, doc: int | None, frame: bytes, count: int) -> int:
        """Write a frame; the place where it begins."""
        begin = self.at
        self.out.write(frame)
        self.at += len(frame)
        self.docs.append(doc)
        self.ends.append(self.at)
        self.counts.append(count)
        return begin

    def close(self) -> None:
        arrays = [
            np.array([d or 0 for d in self.docs], "<i8"), np.array([d is None for d in self.docs], "<i8"),
            np.array(self.ends, "<i8"), np.array(self.counts, "<i8"),
        ]
        index = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(a.tobytes() for a in arrays))
        self.out.write(index + np.array([self.at, len(self.docs)], "<i8").tobytes())
        self.out.close()


def read_header(source) -> tuple[dict, int]:
    """A shard's header and where its frames begin."""
    source.seek(0)
    start = source.read(len(MAGIC) + 4)
    if start[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of token ids")
    size = int.from_bytes(start[len(MAGIC) :], "little")
    return json.loads(source.read(size)), len(start) + size


def read_offsets(source) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, frame ends and numbers of ids of a shard, from its own end."""
    size = source.size()
    source.seek(size - 16)
    place, count = np.frombuffer(source.read(16), "<i8").tolist()
    source.seek(place)
    index = zstandard.ZstdDecompressor().decompress(source.read(size - 16 - place))
    docs, nulls, ends, counts = np.frombuffer(index, "<i8").reshape(4, count)
    return [None if n else d for d, n in zip(docs.tolist(), nulls.tolist())], ends, counts


class Store:
    """A written store: folder, dictionary, width of an id, and the table of offsets."""

    def __init__(self, folder: str, dictionary: bytes, width: int, index: DataFrame):
        self.folder, self.dictionary, self.width, self.index = folder, dictionary, width, index

    def shards(self) -> DataFrame:
        """``shard``, ``file``, ``docs``, ``n_ids`` and ``start``: the ids of all shards before it."""
        own = self.index.groupBy("shard", "file").agg(F.count("*").alias("docs"), F.sum("n_ids").alias("n_ids"))
        own = own.withColumn("run", F.expr(f"shard div {RUN}"))
        inner = Window.partitionBy("run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        # One line per RUN shards is all that is summed in one place.
        runs = own.groupBy("run").agg(F.sum("n_ids").alias("total"))
        outer = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.select("run", F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("before"))
        start = F.col("before") + F.coalesce(F.sum("n_ids").over(inner), F.lit(0))
        return own.join(runs, "run").withColumn("start", start).drop("run", "before")

    def read(self) -> DataFrame:
        """``doc``, ``start``, ``n_ids`` and serialized ``ids`` of all documents, shard by shard."""
        shards = shared.stored(self.shards(), "token-shards")
        folder, dictionary = self.folder, self.dictionary
        wanted = hashlib.sha256(dictionary).hexdigest()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, top = shared.file_system(folder)
            unpacker = _unpacker(dictionary)
            for shard, file in [(r["shard"], r["file"]) for b in batches for r in b.to_pylist()]:
                with system.open_input_file(f"{top}/{file}") as source:
                    head, at = read_header(source)
                    if head["dictionary_sha256"] != wanted:
                        raise ValueError(f"{file} was made with another dictionary")
                    docs, ends, counts = read_offsets(source)
                    before = np.cumsum(counts) - counts
                    # Frames in stretches of some MB; a longer frame is a stretch of its own.
                    cuts = _stretches(ends - at)
                    for i, j in zip(cuts, [*cuts[1:], len(docs)]):
                        first = at if i == 0 else int(ends[i - 1])
                        source.seek(first)
                        data = source.read(int(ends[j - 1]) - first)
                        edges = [0, *(ends[i:j] - first).tolist()]
                        ids = [unpacker.decompress(data[a:b]) for a, b in zip(edges, edges[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([shard] * (j - i), pa.int32()), pa.array(docs[i:j], pa.int64()),
                             pa.array(before[i:j]), pa.array(counts[i:j]), pa.array(ids, pa.binary())],
                            ["shard", "doc", "before", "n_ids", "ids"],
                        )

        files = shards.select("shard", "file")
        found = files.repartition(max(1, files.count())).mapInArrow(run, READ_DDL)
        starts = shards.select("shard", "start")
        return found.join(starts, "shard").select("doc", (F.col("start") + F.col("before")).alias("start"), "n_ids", "ids")

    def lookup(self, docs: DataFrame, key: str = "doc_id") -> DataFrame:
        """``doc`` and serialized ``ids`` of some documents, each read by its own byte range."""
        wanted = docs.select(F.col(key).cast("long").alias("doc")).filter("doc IS NOT NULL").distinct()
        places = self.index.join(wanted, "doc").select("doc", "file", "place", "length")
        folder, dictionary = self.folder, self.dictionary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, top = shared.file_system(folder)
            unpacker, name, source = _unpacker(dictionary), None, None
            for batch in batches:
                docs, ids = [], []
                for row in batch.to_pylist():
                    if row["file"] != name:
                        name, source = row["file"], system.open_input_file(f"{top}/{row['file']}")
                    source.seek(row["place"])
                    docs.append(row["doc"])
                    ids.append(unpacker.decompress(source.read(row["length"])))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.binary())], ["doc", "ids"])

        return places.sortWithinPartitions("file", "place").mapInArrow(run, "doc long, ids binary")


def _stretches(ends: np.ndarray, size: int = 4 << 20) -> list[int]:
    """Where stretches of at most about ``size`` bytes begin."""
    cuts, at = [], 0
    while at < len(ends):
        cuts.append(at)
        before = ends[at - 1] if at else 0
        at = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
    return cuts


def write_store(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> Store:
    """Encode all documents and write their ids in ascending order of ``key``."""
    ids, width = encode(docs, tokenizer, end_id, key, text)
    dictionary = train_dictionary(ids, width)
    head = _header(width, end_id, dictionary)
    # The digest orders equal ids, the row deals out equal rows over shards.
    total = ids.agg(F.sum("n_ids")).first()[0] or 0
    order = ["doc", "digest", "row"]
    ordered = ids.withColumn("digest", F.xxhash64("ids")).repartitionByRange(max(1, -(-total // SHARD_IDS)), *order)
    ordered = ordered.sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc", "ids", "n_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = shared.file_system(folder)
        packer, shard = _packer(dictionary), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            shard = shard or _Shard(system, top, head)
            places, lengths = [], []
            for doc, data, count in zip(batch.column("doc").to_pylist(), batch.column("ids"), batch.column("n_ids").to_pylist()):
                frame = packer.compress(data.as_buffer())
                places.append(shard.add(doc, frame, count))
                lengths.append(len(frame))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array([shard.file] * batch.num_rows), batch.column("doc"),
                 pa.array(places, pa.int64()), pa.array(lengths, pa.int64()), batch.column("n_ids")],
                ["shard", "file", "doc", "place", "length", "n_ids"],
            )
        if shard:
            shard.close()

    index = shared.stored(ordered.mapInArrow(run, INDEX_DDL), "token-index")
    system, top = shared.file_system(folder)
    system.create_dir(top, recursive=True)
    with system.open_output_stream(f"{top}/{hashlib.sha256(dictionary).hexdigest()}.dictionary", compression=None) as out:
        out.write(dictionary)
    return Store(folder, dictionary, width, index)


def ids_crc32(rows: DataFrame, width: int) -> DataFrame:
    """Add ``ids_crc32``: of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(d.as_buffer(), f"<u{width}").astype("<u4")) for d in batch.column("ids")]
            kept = [batch.column(c) for c in ("doc", "start", "n_ids")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], ["doc", "start", "n_ids", "ids_crc32"])

    return rows.select("doc", "start", "n_ids", "ids").mapInArrow(run, "doc long, start long, n_ids long, ids_crc32 long")


WORD_VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = paths.fresh_folder(spark, "token-store")
    store = write_store(docs, folder, vocabulary_file(WORD_VOCABULARY), END_ID)
    return ids_crc32(store.read(), store.width).select(
        F.col("doc").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32"
    )
