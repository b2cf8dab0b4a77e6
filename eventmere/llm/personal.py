"""Personal data found by fixed patterns, and by contexts learned from them.

Seeds are what the four base patterns find. The two words before a seed, and the two
after it, are lexical contexts; in a list, where fewer stand between two matches, the
words before the first one are the context of all. The same scan also collects
candidates: identifiers of a looser shape that no base pattern covers, with their
contexts. Contexts and instances make a graph. A few rounds score it: a context is as
sure as the instances it holds, an instance that is no seed as sure as its contexts
together. Candidates with a context that is sure enough, and that several different
sure instances vouch for, become spans as well. Base spans always stay.

Everything is a DataFrame expression or a join on the main path: positions come
from splitting a text at a pattern's matches, so no Python sees a text. Positions are
added up in chunks of ``CHUNK`` matches, and candidates meet base spans by cells of the
text, so that a text with very many matches takes time in proportion. The graph
holds matches only, is summed before each shuffle, and no context's members are
ever gathered in one place.

Patterns are written so that the regular-expression engine neither recurses nor
rescans long runs: a run of letters or digits is tried from its start only, which
finds the same leftmost matches.

Cases: null and empty texts have no spans; repeated rows are judged each for
itself; matches at the edges of a text, or that touch, are kept apart; an empty
table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmere.llm import shared

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser shapes, judged by context: spelled-out mail addresses, addresses with
#: colons, and national phone numbers. Card-like numbers that fail their check
#: are candidates as well.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: A text without this has no match.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
LOOSE_NEEDS = {"email": "at", "ip": ":"}

ROUNDS = 3
#: Different sure instances, seeds or not, that must follow a context, and how sure these and it must be.
LEAST_SEEDS = 5
LEAST_SURE = 0.8

#: Two words at the end, and at the beginning, of what stands around a match; of longer words the nearer part counts.
_BEFORE = r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$"
_AFTER = r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)"
CONTEXT_CHARS = 80
SPAN = "struct<kind:int,start:int,end:int,value:string,context:string,after:string>"
#: Matches whose positions are added up together, and characters of a cell.
CHUNK = 512
CELL = 256


def _matches(text: str, pattern: str, need: str | None) -> Column:
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(F.contains(F.col(text), F.lit(need)), found).otherwise(none) if need else found, none)


def _words(text: Column, pattern: str) -> Column:
    """Two words as a context: in lower case, with single spaces; empty if there are not two."""
    return F.lower(F.regexp_replace(F.regexp_extract(text, pattern, 1), r"[\x20\x09-\x0D]+", " "))


def _spans(text: str, matches: str, pattern: str, kind: int) -> Column:
    """Positions and contexts of the matches, from what lies between them."""
    pieces = F.split(F.col(text), pattern, -1)
    left = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(matches)),
        F.col(matches),
        lambda gap, value: F.struct(
            F.char_length(gap).alias("gap"),
            F.char_length(value).alias("size"),
            value.alias("value"),
            _words(F.right(gap, F.lit(CONTEXT_CHARS)), _BEFORE).alias("context"),
        ),
    )
    items = F.zip_with(
        left,
        F.slice(pieces, F.lit(2), F.size(matches)),
        lambda x, gap: F.struct(x["gap"], x["size"], x["value"], x["context"], _words(F.left(gap, F.lit(CONTEXT_CHARS)), _AFTER).alias("after")),
    )

    def step(done: Column, item: Column) -> Column:
        start = done["at"] + item["gap"]
        end = start + item["size"]
        # In a list the words before its first match count.
        context = F.when(item["context"] != "", item["context"]).otherwise(done["context"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), item["value"].alias("value"),
            context.alias("context"), item["after"].alias("after"),
        )
        return F.struct(end.alias("at"), context.alias("context"), F.concat(done["spans"], F.array(span)).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("context"), none.alias("spans"))
    # An array that grows by one is copied each time, so chunks are added up first, and then moved.
    numbers = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int"))
    whole = F.struct(items.alias("items"))
    chunks = F.get(
        F.transform(F.array(whole), lambda w: F.transform(
            numbers, lambda c: F.aggregate(F.slice(w["items"], c * CHUNK + 1, F.lit(CHUNK)), start, step)
        )), F.lit(0),
    )

    def join(done: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["spans"], lambda s: F.struct(
            s["kind"].alias("kind"), (s["start"] + done["at"]).alias("start"), (s["end"] + done["at"]).alias("end"), s["value"].alias("value"),
            F.when(s["context"] != "", s["context"]).otherwise(done["context"]).alias("context"), s["after"].alias("after"),
        ))
        context = F.when(chunk["context"] != "", chunk["context"]).otherwise(done["context"])
        return F.struct(
            (done["at"] + chunk["at"]).alias("at"), context.alias("context"), F.concat(done["parts"], F.array(moved)).alias("parts")
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("context"), F.array().cast(f"array<array<{SPAN}>>").alias("parts"))
    located = F.aggregate(chunks, first, join, lambda done: F.flatten(done["parts"]))
    return F.when(F.size(matches) > 0, located).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the check: every second one from the right is doubled."""
    backwards = F.reverse(_digits(value))
    digits = F.transform(
        F.sequence(F.lit(1), F.char_length(backwards)),
        lambda i: F.struct(F.substring(backwards, i, F.lit(1)).cast("int").alias("d"), (i % 2 == 0).alias("twice")),
    )
    doubled = lambda x: x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)
    total = F.aggregate(digits, F.lit(0), lambda s, x: s + F.when(x["twice"], doubled(x)).otherwise(x["d"]))
    return total % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    """The check a base pattern's match must pass."""
    small = lambda p: F.char_length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3
    checks = {
        "ip": lambda s: F.forall(F.split(s["value"], r"\."), lambda p: small(p) & (F.right(p, F.lit(3)).cast("int") <= 255)),
        "card": lambda s: F.char_length(_digits(s["value"])).between(13, 19) & _luhn(s["value"]),
        "phone": lambda s: F.char_length(_digits(s["value"])).between(9, 15),
    }
    return checks.get(kind, lambda s: F.lit(True))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__base`` and ``__loose``, the base spans and what else looks like one in every text."""
    rows = docs
    for n, kind in enumerate(KINDS):
        rows = rows.withColumn(f"__m_{kind}", _matches(text, PATTERNS[kind], NEEDS.get(kind)))
        rows = rows.withColumn(f"__s_{kind}", _spans(text, f"__m_{kind}", PATTERNS[kind], n))
    for n, kind in enumerate(KINDS):
        if kind in LOOSE:
            rows = rows.withColumn(f"__n_{kind}", _matches(text, LOOSE[kind], LOOSE_NEEDS.get(kind)))
            rows = rows.withColumn(f"__l_{kind}", _spans(text, f"__n_{kind}", LOOSE[kind], n))
    base = [F.filter(f"__s_{kind}", _valid(kind)) for kind in KINDS]
    cards = F.filter("__s_card", lambda s: F.char_length(_digits(s["value"])).between(13, 19) & ~_luhn(s["value"]))
    rows = rows.withColumn("__base", F.concat(*base)).withColumn("__loose", F.concat(*[f"__l_{k}" for k in LOOSE], cards))
    return rows.select(*docs.columns, "__base", "__loose")


def candidates(rows: DataFrame) -> DataFrame:
    """``__row`` and span ``s`` of the loose spans that have a context and overlap no base span.

    Both meet in the cells of a text they reach into, not span by span.
    """
    open_rows = rows.filter(F.size("__loose") > 0)
    in_cells = lambda column: open_rows.select("__row", F.explode(column).alias("s")).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("s.start") / CELL), F.floor((F.col("s.end") - 1) / CELL)))
    )
    loose, base = in_cells("__loose"), in_cells("__base").select(F.col("__row").alias("r"), F.col("cell").alias("c"), F.col("s").alias("b"))
    meet = (F.col("__row") == F.col("r")) & (F.col("cell") == F.col("c"))
    covered = loose.join(base, meet & (F.col("s.start") < F.col("b.end")) & (F.col("b.start") < F.col("s.end")), "left_semi")
    covered = covered.select("__row", F.col("s.kind").alias("kind"), F.col("s.start").alias("start")).distinct()
    spans = open_rows.select("__row", F.explode("__loose").alias("s")).filter((F.col("s.context") != "") | (F.col("s.after") != ""))
    same = (spans["__row"] == covered["__row"]) & (F.col("s.kind") == covered["kind"]) & (F.col("s.start") == covered["start"])
    return spans.join(covered, same, "left_anti")


def contexts_of(span: Column) -> Column:
    """What stands before and after a span, marked by side."""
    sides = F.array(F.concat(F.lit("<"), span["context"]), F.concat(F.lit(">"), span["after"]))
    return F.filter(sides, lambda c: F.char_length(c) > 1)


def sure_contexts(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Contexts (``kind``, ``context``) whose candidates count as personal data."""
    seeds = rows.select(F.explode("__base").alias("s"), F.lit(1.0).alias("seed")).unionByName(chosen.select("s", F.lit(0.0).alias("seed")))
    edges = seeds.select("s.kind", F.explode(contexts_of(F.col("s"))).alias("context"), F.lower("s.value").alias("value"), "seed")
    edges = shared.stored(edges.groupBy("kind", "context", "value").agg(F.max("seed").alias("seed")), "edges")
    instances = edges.groupBy("kind", "value").agg(F.max("seed").alias("sure"))
    for _ in range(ROUNDS):
        held = edges.join(instances, ["kind", "value"])
        contexts = held.groupBy("kind", "context").agg(
            (F.sum("sure") / (F.count("*") + 1)).alias("weight"), F.sum((F.col("sure") >= LEAST_SURE).cast("int")).alias("seeds")
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("weight"), F.lit(1e-9)))))
        instances = (
            edges.join(contexts, ["kind", "context"])
            .groupBy("kind", "value")
            .agg(F.greatest(F.max("seed"), 1 - doubt).alias("sure"))
        )
    return contexts.filter((F.col("weight") >= LEAST_SURE) & (F.col("seeds") >= LEAST_SEEDS)).select("kind", "context")


def find_personal(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``__base`` and ``__added`` spans; the text may be dropped."""
    rows = scan(docs, text)
    rows = rows if keep_text else rows.drop(text)
    rows = shared.stored(rows.withColumn("__row", F.monotonically_increasing_id()), "spans")
    own = [c for c in rows.columns if c not in ("__loose", "__row")]
    chosen = shared.stored(candidates(rows), "candidates")
    contexts = sure_contexts(rows, chosen)
    each = chosen.withColumn("context", F.explode(contexts_of(F.col("s"))))
    picked = each.join(contexts, (F.col("s.kind") == contexts["kind"]) & (each["context"] == contexts["context"]), "left_semi")
    picked = picked.select("__row", "s").distinct().groupBy("__row").agg(F.collect_list("s").alias("__added"))
    # Most texts have no candidate and need no join.
    plain = rows.filter(F.size("__loose") == 0).select(*own, F.array().cast(f"array<{SPAN}>").alias("__added"))
    joined = rows.filter(F.size("__loose") > 0).join(picked, "__row", "left")
    return plain.unionByName(joined.select(*own, F.coalesce("__added", F.array().cast(f"array<{SPAN}>")).alias("__added")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans by kind, then start, joined by commas."""
    short = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(short, text), ",")


def mask_personal(docs: DataFrame, text: str = "text", size: str | None = None) -> DataFrame:
    """The documents with every found span replaced by its kind in brackets; ``size`` names their length."""
    rows = find_personal(docs, text)
    spans = F.array_sort(
        F.transform(F.concat("__base", "__added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        part = F.concat(F.substring(F.col(text), done["at"] + 1, s["start"] - done["at"]), F.get(names, s["kind"]))
        # A span that overlaps the one before only extends it.
        return F.struct(
            F.greatest(s["end"], done["at"]).alias("at"),
            F.when(s["start"] >= done["at"], F.concat(done["out"], part)).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, F.char_length(text)))
    masked = F.aggregate(F.col("__spans"), start, step, rest)
    rows = rows.withColumn("__spans", spans).withColumn(text, F.when(F.size("__spans") > 0, masked).otherwise(F.col(text)))
    if size in docs.columns:
        kind = docs.schema[size].dataType
        rows = rows.withColumn(size, F.when(F.size("__spans") > 0, F.char_length(text).cast(kind)).otherwise(F.col(size)))
    return rows.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = lambda n: F.size(F.filter("__base", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(listed(F.col("__base")), 256).alias("base_sha256"),
        listed(F.concat("__base", "__added")).alias("spans"),
    )
