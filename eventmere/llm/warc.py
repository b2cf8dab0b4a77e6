"""Web archives in WARC files with a two-level index of captures.

Every page is one record, gzipped on its own so that it can be read by a range
of bytes. Pages with equal payloads are stored once: the largest id is the
response, the others are revisits that refer to it. The index sorts captures by
reversed-host URL key and packs them into compressed blocks; a sparse directory
holds the first and last key of each block. A lookup searches the bounds of the
index parts, then a part's directory, opens only the blocks that may hold its
keys, and reads only the byte ranges found there.

Files are written by tasks to the shared folder under a name of their own per
attempt. A capture is in the index only if the task that wrote it ended well, so
files of lost or repeated attempts are never read.

The parts' bounds are all that is broadcast: one pair of keys per ``PART_ROWS``
captures, at most ``MOST_PARTS`` of them. Equal keys are cut by id, so a URL with very many captures fills
several blocks and parts.

Cases: a null payload is an empty one, and empty payloads are equal; rows with
the same id and payload have the same role; a null id is a revisit if its payload
has an id, otherwise a response; a null URL has the empty key; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import shared
from eventmere.llm.texts import text_column
from eventmere.sources import paths

FILE_BYTES = 64 << 20
BLOCK_LINES = 1000
PART_ROWS = 50_000
MOST_PARTS = 20_000
#: Bytes of a file that one task reads, about.
READ_BYTES = 16 << 20
#: URLs of these characters are written as they are; others are quoted, which a header of their record says.
URL_CHARS = re.compile(r"[!-~]+")
QUOTED = "X-Target-URI-Quoted: yes"
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE_DDL = "url_key string, page_id long, file string, offset long, length long"
RECORD_DDL = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``com,example,www)/a?b``."""
    if not url:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.strip())
    host, cut, path = re.match(r"([^/?#]*)([/?#]?)(.*)", rest, re.S).groups()
    host, port = re.match(r"(\[[^\]]*\]|[^:]*):?(.*)", host.rpartition("@")[2].lower(), re.S).groups()
    port = "" if port in ("", "80", "443") else f":{port}"
    if host.startswith("["):  # an address with colons has no labels to reverse
        return f"{host}{port}){cut if cut == '/' else '/' + cut}{path}"
    return ",".join(reversed(host.strip(".").split("."))) + f"{port}){cut if cut == '/' else '/' + cut}{path}"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, size: int) -> bytes:
    """One gzipped record; a revisit keeps the headers of the answer but no payload."""
    revisit = payload is None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += payload or b""
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:capture:{name}>", f"WARC-Date: {CAPTURED}"]
    if url is not None and URL_CHARS.fullmatch(url):
        head.append("WARC-Target-URI: " + url)
    elif url is not None:
        head += ["WARC-Target-URI: " + urllib.parse.quote(url, safe="/:=&?~#+!$,;'@()*[]"), QUOTED]
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:capture:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> dict:
    """The fields of ``RECORD_DDL`` of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    name = lambda field: int(field[13:-1]) if field and field[13:-1] else None
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if not revisit and (size != len(payload) or "sha1:" + _digest(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": name(fields["WARC-Record-ID"]),
        "url": urllib.parse.unquote(url) if url is not None and QUOTED in head.decode().split("\r\n") else url,
        "payload": None if revisit else payload,
        "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"][5:],
        "record_type": fields["WARC-Type"],
        "refers_to": name(fields.get("WARC-Refers-To")),
    }


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``page_id``, ``url``, ``html``; the captures, stored.

    Payloads of at least ``least`` bytes are stored once.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("sha", F.unhex(F.sha2("html", 256)))
    firsts = pages.groupBy("sha").agg(F.max("page_id").alias("first_id"))
    joined = pages.join(firsts, "sha").withColumn(
        "refers_to",
        F.when((F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")),
    )
    joined = joined.select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open(folder)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    system.create_dir(top, recursive=True)
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                payload = row["html"].encode()
                stored = payload if row["refers_to"] is None else None
                data = _record(row["page_id"], row["url"], stored, _digest(payload), row["refers_to"], len(payload))
                out.write(data)
                rows.append((url_key(row["url"]), row["page_id"], name, at, len(data)))
                at += len(data)
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["url_key", "page_id", "file", "offset", "length"]
            )
        if out is not None:
            out.close()

    return shared.stored(joined.mapInArrow(write, CAPTURE_DDL), "captures")


def build_index(captures: DataFrame) -> DataFrame:
    """Sorted, compressed blocks: ``part``, ``block``, ``first_key``, ``last_key``, ``lines``."""
    parts = min(MOST_PARTS, -(-captures.count() // PART_ROWS) or 1)
    ordered = captures.repartitionByRange(parts, "url_key", "page_id", "file", "offset")
    ordered = ordered.sortWithinPartitions("url_key", "page_id", "file", "offset").withColumn("part", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_rows = 0, []

        def block(rows: list[dict]) -> pa.RecordBatch:
            lines = "\n".join(f"{urllib.parse.quote(r['url_key'])}\t{r['file']}\t{r['offset']}\t{r['length']}" for r in rows)
            columns = [[rows[0]["part"]], [number], [rows[0]["url_key"]], [rows[-1]["url_key"]], [zlib.compress(lines.encode())]]
            types = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["part", "block", "first_key", "last_key", "lines"]
            )

        for batch in batches:
            open_rows += batch.to_pylist()
            while len(open_rows) >= BLOCK_LINES:
                yield block(open_rows[:BLOCK_LINES])
                number, open_rows = number + 1, open_rows[BLOCK_LINES:]
        if open_rows:
            yield block(open_rows)

    blocks = ordered.mapInArrow(pack, "part int, block int, first_key string, last_key string, lines binary")
    return shared.stored(blocks, "capture-index")


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures (``url_key``, ``file``, ``offset``, ``length``) of some distinct ``url_key`` values."""
    bounds = index.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high")).orderBy("part").collect()
    parts, lows, highs = ([b[i] for b in bounds] for i in (0, 1, 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch.column("url_key").to_pylist():
                # Parts are in order; a key may stand in several, or in none.
                for p in range(bisect_left(highs, key), bisect_right(lows, key)):
                    found.append((parts[p], key))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.string())], ["part", "url_key"]
            )

    def search(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        directory = sorted(blocks.to_pylist(), key=lambda b: b["block"])
        lows, highs = [b["first_key"] for b in directory], [b["last_key"] for b in directory]
        opened: dict[int, set[str]] = {}
        for key in wanted.column("url_key").to_pylist():
            for n in range(bisect_left(highs, key), bisect_right(lows, key)):
                opened.setdefault(n, set()).add(key)
        found = []
        for n, keys in opened.items():
            for line in zlib.decompress(directory[n]["lines"]).decode().split("\n"):
                name, file, offset, length = line.split("\t")
                name = urllib.parse.unquote(name)
                if name in keys:
                    found.append((name, file, int(offset), int(length)))
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.table([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], ["url_key", "file", "offset", "length"])

    placed = keys.mapInArrow(place, "part int, url_key string")
    return index.groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(search, "url_key string, file string, offset long, length long")


def url_keys(pages: DataFrame) -> DataFrame:
    """The distinct keys of some pages' URLs."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [url_key(u) for u in text_column(batch, "url").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["url_key"])

    return pages.select("url").mapInArrow(keys, "url_key string").distinct()


def read_ranges(captures: DataFrame, folder: str, payloads: bool = True, total_bytes: int | None = None) -> DataFrame:
    """The records at some captures, read by byte range; payloads may be left out.

    ``total_bytes`` is how much there is to read: each task reads some ``READ_BYTES``, of
    one stretch of a file as far as possible.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _open(folder)
        name, source = None, None
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    source = system.open_input_file(f"{top}/{name}")
                source.seek(row["offset"])
                record = parse_record(zlib.decompress(source.read(row["length"]), 31))
                found.append(record if payloads else record | {"payload": None})
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    # The index is small beside what it points to, so the count follows from the archive's bytes.
    tasks = max(1, -(-(total_bytes or READ_BYTES) // READ_BYTES))
    by_file = captures.repartition(tasks, "file", F.expr(f"offset div {READ_BYTES}")).sortWithinPartitions("file", "offset")
    return by_file.mapInArrow(read, RECORD_DDL)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = paths.fresh_folder(spark, "warc")
    written = write_archives(pages, folder)
    total_bytes = written.agg(F.sum("length")).first()[0]
    captures = lookup(build_index(written), url_keys(pages))
    return read_ranges(captures, folder, payloads=False, total_bytes=total_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT html, max(page_id) AS first_id FROM p GROUP BY html
)
SELECT page_id, octet_length(encode(p.html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f ON p.html = f.html
"""
