"""Secrets found by fixed patterns and by how hard a credential's value is to guess.

Base patterns find assigned values, access keys and long hexadecimal runs. The
method looks at values in a credential context that no base span covers, and finds
the cheapest way to guess each: a dynamic programme splits the value into words,
dates, repeats, sequences, keyboard walks and brute-force spans, each with its
number of guesses. Values that are dear to guess are spans of kind
``credential``; placeholders and plain words are cheap and stay.

The scan needs no shuffle. Word ranks come from a public vocabulary file whose path
is a parameter; it holds a bounded number of words and is broadcast.

Cases: null and empty texts have no spans; repeated rows are judged alike; an
empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmere.llm import shared
from eventmere.llm.texts import text_column

KINDS = ("assign", "access", "hex", "credential")
WORD_FILE = "/opt/tokenizers/word_bpe_49k.json"
#: A value that takes fewer guesses (log10) is a placeholder or a plain word.
LEAST_COST = 10.0
#: Values are compared up to the longest word and scored whole.
LONGEST_WORD = 24

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Names of a credential. A text without one of them has no context.
NAMES = (
    *("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "credentials", "credential"),
    *(f"api{x}key" for x in ("", "_", " ", "-")),
    *(f"private{x}key" for x in (" ", "_", "-")),
)
_CONTEXT = re.compile(
    rf"""(?:{"|".join(re.escape(x) for x in NAMES)})["'`]?"""
    r"""(?:\x20*(?::=|=>|[:=])\x20*|\x20+(?:is|was)\x20+)["'`]?([^\s"'`,;<>(){}]{6,})""",
    re.I | re.A,
)

_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEXT: dict[str, set[str]] = {}
for _r, _row in enumerate(_ROWS):
    for _c, _key in enumerate(_row):
        near = [(_r, _c - 1), (_r, _c + 1), (_r - 1, _c), (_r - 1, _c + 1), (_r + 1, _c - 1), (_r + 1, _c)]
        _NEXT[_key] = {_ROWS[r][c] for r, c in near if 0 <= r < len(_ROWS) and 0 <= c < len(_ROWS[r])}
_LEET = str.maketrans("@4301$5!7", "aaeoissit")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?\d\d?[-/.]?\d\d?|\d\d?[-/.]?\d\d?[-/.]?(?:19|20)\d\d|(?:19|20)\d\d)")


def _class_size(ch: str) -> int:
    if ch.isdigit():
        return 10
    return 26 if ch.isascii() and ch.isalpha() else 33 if ch.isascii() else 100


def _word_cost(part: str, ranks: dict[str, int]) -> float | None:
    """Guesses for a dictionary word, capitals and look-alike characters included."""
    low = part.lower()
    for spelled, extra in ((low, 0.0), (low.translate(_LEET), math.log10(2) * 2)):
        if spelled in ranks:
            capitals = sum(c.isupper() for c in part)
            turns = 0.0 if not capitals else math.log10(2) if capitals == len(part) or part[0].isupper() and capitals == 1 else capitals * 0.6
            return math.log10(ranks[spelled] + 1) + extra + turns
    return None


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses for the cheapest segmentation of a value."""
    n = len(value)
    low = value.lower()
    brute = [0.0]
    for ch in value:
        brute.append(brute[-1] + math.log10(_class_size(ch)))
    # Starts of runs of one character, of steps by one, and of neighbouring keys, as of each end.
    spans: list[tuple[int, int, float]] = []
    for test, price in (
        (lambda a, b: a == b, lambda k: 1.0 + math.log10(k)),
        (lambda a, b: abs(ord(a) - ord(b)) == 1, lambda k: 1.5 + math.log10(k)),
        (lambda a, b: b in _NEXT.get(a, ()), lambda k: 1.6 + 0.5 * (k - 1)),
    ):
        start = 0
        for i in range(1, n + 1):
            if i == n or not test(low[i - 1], low[i]):
                if i - start >= 3:
                    spans.append((start, i, price(i - start)))
                start = i
    for unit in range(2, min(n // 2, LONGEST_WORD) + 1):
        i = 0
        while i + 2 * unit <= n:
            k = 1
            while value[i : i + unit] == value[i + k * unit : i + (k + 1) * unit]:
                k += 1
            if k > 1:
                inner = _word_cost(value[i : i + unit], ranks)
                spans.append((i, i + k * unit, (brute[i + unit] - brute[i] if inner is None else inner) + math.log10(k)))
                i += (k - 1) * unit
            i += 1
    for i in range(n):
        found = _DATE.match(value, i)
        if found:
            spans.append((i, found.end(), 2.0 if len(found[0]) == 4 else 4.6))
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            cost = _word_cost(value[i:j], ranks)
            if cost is not None:
                spans.append((i, j, cost))
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in spans:
        ends[j].append((i, cost))
    # A further segment costs the choice of its place, too.
    step = 0.5
    best, open_brute = [0.0] * (n + 1), math.inf
    for j in range(1, n + 1):
        # The cheapest brute-force span that ends here either begins or goes on.
        open_brute = min(open_brute, best[j - 1] + (step if j > 1 else 0.0) - brute[j - 1])
        best[j] = open_brute + brute[j]
        for i, cost in ends[j]:
            best[j] = min(best[j], best[i] + (step if i else 0.0) + cost)
    return best[n]


def find_in(text: str, ranks: dict[str, int], least: float = LEAST_COST) -> list[tuple[int, int, int, bool]]:
    """Spans (kind, start, end, base) of a text in code points."""
    found = []
    low = text.lower()
    hinted = any(h in low for h in NAMES)
    if hinted:
        found += [(0, m.start(), m.end(), True) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), True) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), True) for m in _HEX.finditer(text)]
    if hinted:
        for m in _CONTEXT.finditer(text):
            start, value = m.start(1), m[1].rstrip(".!?:")
            end = start + len(value)
            if any(s < end and start < e for _, s, e, _ in found) or len(value) < 6:
                continue
            if guess_cost(value, ranks) >= least:
                found.append((3, start, end, False))
    return sorted(found, key=lambda s: (s[1], s[0]))


def word_ranks(path: str) -> dict[str, int]:
    """Whole words of a vocabulary file and their place in it, which follows their frequency."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = sorted((i, w[:-4]) for w, i in vocabulary.items() if w.endswith("</w>") and len(w) > 6 and w[:-4].isalpha())
    return {w: n for n, (_, w) in enumerate(words, 1)}


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def find_secrets(docs: DataFrame, into: str = "secrets", text: str = "text", words: str = WORD_FILE, keep_text: bool = True) -> DataFrame:
    """Add an array of spans to the documents; the text may be dropped on the way."""
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(words))
    kept = [f for f in docs.schema.fields if f.name != into and (keep_text or f.name != text)]
    names = [f.name for f in kept]
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in find_in(t or "", ranks.value)]
                for t in text_column(batch, text).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(spans, span_type)], [*names, into])

    return docs.mapInArrow(add, T.StructType([*kept, T.StructField(into, SPANS)]))


def _listed(spans: Column) -> Column:
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = F.filter("secrets", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
    )
