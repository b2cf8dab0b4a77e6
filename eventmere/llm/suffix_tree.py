"""Language-model scores from a probabilistic suffix tree.

The symbols are the bytes of a token, a mark after each word and one at the end of a
text, so every text has a probability, known words or not. A context of up to ``DEPTH``
symbols is a state if it was seen ``LEAST_COUNT`` times and the symbols after it differ
from those after its longest shorter state, by a likelihood ratio test. Distributions
are smoothed with that shorter state's. Each symbol is scored in its longest state. A
word's probability by symbols in turn smooths its share of all words seen, so that
frequent words need not be spelled.

The tree is a table, never held in one place. Blocks of documents send their distinct
contexts with the symbol that follows to buckets by hash (see ``exchange``); what the
buckets add up is joined level by level, from the empty context on, each row with the
chance its symbol has after the context that is one symbol shorter. The buckets then
answer every block with the chances it asked for. So states and depth in use grow with
the corpus, and a task holds one block or one bucket. Word counts are asked for in the
same way. The driver gets totals only.

Cases: null and empty texts have the end as their only token; without documents
to learn from, all words are unknown; repeated rows count as often as they
stand; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmere.llm import exchange, shared
from eventmere.llm.texts import SPACE, Words, read_words, run_hashes, slices, text_column, word_hashes

DEPTH = 5
BITS = 9
#: Marks after a word and at the end of a text; byte b is symbol b + 2.
SPACE_MARK, END_MARK = 0, 1
SYMBOLS = 258
#: How often a context must be seen to become a state.
LEAST_COUNT = 100
#: Log-likelihood (natural) a state must gain over its shorter state.
LEAST_GAIN = 50.0
#: Weight of the shorter state's distribution, in symbols.
PRIOR = 16.0
#: An odd number, whose products spread contexts over buckets.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: str = "doc_id") -> Column:
    checksum = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(checksum, F.lit(7)) == 2


def symbols_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, and where each text begins in them (and the last ends)."""
    lengths = words.ends - words.starts
    inside = np.flatnonzero(~SPACE[words.data])
    out = np.full(len(inside) + len(lengths) + len(words.first) - 1, SPACE_MARK, np.uint64)
    out[np.arange(len(inside)) + np.repeat(np.arange(len(lengths)) + words.text_of, lengths)] = words.data[inside].astype(np.uint64) + 2
    reached = np.append(0, np.cumsum(lengths))[words.first]
    begins = reached + words.first + np.arange(len(words.first))
    out[begins[1:] - 1] = END_MARK
    return out, begins


def grams_of(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Each symbol, in the low bits, with the ``DEPTH`` before it, newest first; space marks before a text."""
    found = np.zeros(len(symbols), np.uint64)
    for back in range(1, DEPTH + 1):
        found[back:] |= symbols[:-back] << np.uint64(BITS * (back - 1))
    for place in range(DEPTH):
        at = begins[:-1] + place
        at = at[at < len(symbols)]
        found[at] &= np.uint64((1 << (BITS * place)) - 1)
    return found << np.uint64(BITS) | symbols


def chances(grams: DataFrame) -> DataFrame:
    """``gram``, ``bucket`` and ``chance`` (log10) of the distinct grams with their counts ``n``.

    Grams that were not learned from have a count of 0; their chance comes from
    shorter contexts.
    """
    at = lambda level: F.col("gram").bitwiseAND(F.lit((1 << (BITS * (level + 1))) - 1))
    known = grams.groupBy(at(0).alias("gram")).agg(F.sum("n").alias("n"))
    total = known.agg(F.sum("n")).first()[0] or 0
    known = known.select("gram", F.log((F.col("n") + 1) / (total + SYMBOLS)).alias("chance"))
    for level in range(1, DEPTH + 1):
        rows = grams if level == DEPTH else grams.groupBy(at(level).alias("gram")).agg(F.sum("n").alias("n"))
        before = known.select(F.col("gram").alias("shorter"), F.col("chance").alias("_before"))
        rows = rows.join(before, at(level - 1) == F.col("shorter"))
        # A context has at most SYMBOLS rows.
        own = Window.partitionBy(F.shiftright("gram", BITS))
        seen, count = F.sum("n").over(own), F.col("n").cast("double")
        gain = F.sum(F.when(count > 0, count * (F.log(count) - F.col("_before"))).otherwise(0.0)).over(own)
        rows = rows.withColumns({"_seen": seen, "_gain": gain})
        kept = (F.col("_seen") >= LEAST_COUNT) & (F.col("_gain") - F.col("_seen") * F.log("_seen") >= LEAST_GAIN)
        blended = F.log((count + PRIOR * F.exp("_before")) / (F.col("_seen") + PRIOR))
        chance = F.when(kept, blended).otherwise(F.col("_before"))
        known = rows.select("gram", *(["bucket"] if level == DEPTH else []), chance.alias("chance"))
        if level < DEPTH:
            known = shared.stored(known, "suffix-states")
    return known.withColumn("chance", F.col("chance") / float(np.log(10)))


def spelled(words: Words, each: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log10 probability of each word and of each text's end, from those of the symbols."""
    reached = np.append(0.0, np.cumsum(each, dtype=np.float64))
    lengths = words.ends - words.starts
    first = np.append(0, np.cumsum(lengths))[:-1] + np.arange(len(lengths)) + words.text_of
    return reached[first + lengths + 1] - reached[first], each[begins[1:] - 1].astype(np.float64)


def blended(seen: np.ndarray, chance: np.ndarray, tokens: int, kinds: int) -> np.ndarray:
    """log10 of a token's share, smoothed with its spelling by the share of new tokens (Witten and Bell)."""
    if not tokens:
        return chance
    with np.errstate(divide="ignore"):
        share = np.logaddexp(np.log(seen), np.log(kinds) + chance * np.log(10))
    return share / np.log(10) - np.log10(tokens + kinds)


def _word_keys(column: pa.Array):
    """Each slice's words and their 128-bit keys."""
    for start, stop in slices(column):
        words = read_words(column[start:stop], lower=True)
        hashes = word_hashes(words)
        yield start, stop, words, hashes, run_hashes(hashes, 1, 1)


def _block_grams(column: pa.Array, held: np.ndarray):
    """Each slice's distinct grams, spread, with the place of every symbol among them, and those of the block.

    The block's come with their counts where they may be learned from.
    """
    parts, keys, counts = [], [], []
    for start, stop in slices(column):
        symbols, begins = symbols_of(read_words(column[start:stop], lower=True))
        spread = grams_of(symbols, begins) * SPREAD
        learned = np.repeat(~held[start:stop], np.diff(begins))
        # Distinct grams are found by hashing, and only these are sorted.
        encoded = pa.array(spread).dictionary_encode()
        distinct = np.asarray(encoded.dictionary)
        order = np.argsort(distinct)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        place = rank[np.asarray(encoded.indices)]
        parts.append((distinct[order], place, begins))
        keys.append(distinct[order])
        counts.append(np.bincount(place[learned], minlength=len(order)))
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    keys = join(keys, np.uint64)
    return parts, exchange.grouped(keys, np.zeros_like(keys), join(counts, np.int64))


def gram_chances(tagged: DataFrame, blocks: int) -> DataFrame:
    """For every block the log10 chances of its distinct grams, packed by bucket in the order it sends them."""

    def ask(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = _block_grams(text_column(table, "_text"), np.asarray(table.column("_held")))[1]
        return exchange.send(keys[0].as_py(), *found, blocks)

    back = np.uint64(pow(int(SPREAD), -1, 1 << 64))

    def add(rows: pa.Table) -> pa.Table:
        _, total, leading = exchange.totals(rows)
        spread = np.concatenate([exchange.unpack(k, len(c) // 4)[0] for k, c in zip(*(rows.column(n).to_pylist() for n in ("keys", "counts")))])
        # What stands first among equal keys holds the total of all.
        order = np.argsort(spread, kind="stable")
        firsts = order[np.r_[True, spread[order][1:] != spread[order][:-1]]] if len(order) else order
        assert len(firsts) == np.count_nonzero(leading)
        bucket = pa.array(np.full(len(firsts), rows.column("bucket")[0].as_py()), pa.int32())
        return pa.table({"bucket": bucket, "gram": pa.array((spread[firsts] * back).astype(np.int64)), "n": pa.array(total[firsts], pa.int64())})

    sent = shared.stored(tagged.groupBy("block").applyInArrow(ask, exchange.SENT_DDL), "gram-keys")
    grams = shared.stored(sent.groupBy("bucket").applyInArrow(add, "bucket int, gram long, n long"), "gram-counts")
    known = shared.stored(chances(grams), "gram-chances")

    def reply(rows: pa.Table, table: pa.Table) -> pa.Table:
        spread = np.asarray(table.column("gram")).astype(np.uint64) * SPREAD
        order = np.argsort(spread)
        spread, chance = spread[order], np.asarray(table.column("chance"))[order]
        packed = []
        for blob, counts in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist()):
            keys = exchange.unpack(blob, len(counts) // 4)[0]
            packed.append(chance[np.searchsorted(spread, keys)].astype("<f4").tobytes())
        return pa.table({"bucket": rows.column("bucket"), "block": rows.column("block"), "chances": pa.array(packed, pa.binary())})

    found = sent.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(reply, "bucket int, block int, chances binary")
    return shared.stored(found, "gram-answers")


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", held: Column | None = None) -> DataFrame:
    """Base and tree scores of every document; ``held`` marks those not learned from."""
    held = held_out(key) if held is None else held
    docs = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), held.alias("_held"))
    key_type = docs.schema["_key"].dataType.simpleString()
    blocks = shared.block_count(docs, "_text")
    tagged = docs.withColumn("block", shared.block_of(blocks, "_key", "_text"))
    spelling = gram_chances(tagged, blocks)

    def distinct(parts, held: np.ndarray):
        """The block's words, counted where they may be learned from."""
        weights = [np.repeat(~held[start:stop], words.counts) for start, stop, words, _, _ in parts]
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        return exchange.grouped(
            join([p[3] for p in parts], np.uint64), join([p[4] for p in parts], np.uint64), join(weights, bool).astype(np.int64)
        )

    def ask(keys: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = list(_word_keys(text_column(table, "_text")))
        return exchange.send(keys[0].as_py(), *distinct(parts, np.asarray(table.column("_held"))), blocks)

    def reply(rows: pa.Table) -> pa.Table:
        sender, total, leading = exchange.totals(rows)
        edges = np.searchsorted(sender, np.arange(rows.num_rows + 1))
        packed = [total[i:j].astype("<i8").tobytes() for i, j in zip(edges[:-1], edges[1:])]
        tokens, kinds = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        tokens[0], kinds[0] = total[leading].sum(), np.count_nonzero(total[leading])
        return pa.table(
            {
                "bucket": rows.column("bucket"),
                "block": rows.column("block"),
                "counts": pa.array(packed, pa.binary()),
                "tokens": pa.array(tokens),
                "kinds": pa.array(kinds),
            }
        )

    sent = tagged.groupBy("block").applyInArrow(ask, exchange.SENT_DDL)
    replies = sent.groupBy("bucket").applyInArrow(reply, f"{exchange.ANSWER_DDL}, tokens long, kinds long")
    replies = shared.stored(replies, "word-counts")
    sums = replies.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    ends = docs.filter(~F.col("_held")).count()
    total = int(sums["tokens"] or 0) + ends
    kinds = int(sums["kinds"] or 0) + (ends > 0)
    unit = np.log10(total + kinds + 1)

    def score(keys: tuple[pa.Scalar, ...], table: pa.Table, found: pa.Table) -> pa.Table:
        column, held = text_column(table, "_text"), np.asarray(table.column("_held"))
        parts = list(_word_keys(column))
        is_word = found.column("chances").is_null()
        known = exchange.Totals(found.filter(is_word), *distinct(parts, held)[:2])
        grams, (distinct_grams, _, _) = _block_grams(column, held)
        answers = found.filter(pc.invert(is_word)).sort_by("bucket").column("chances").to_pylist()
        chance_of = np.concatenate([np.frombuffer(x, "<f4") for x in answers]) if answers else np.zeros(0, np.float32)
        n_known, base, scores = [], [], []
        for (start, stop, words, first, second), (own, place, begins) in zip(parts, grams):
            seen = known.of(first, second)
            owner, n = words.text_of, stop - start
            n_known.append(np.bincount(owner[seen > 0], minlength=n) + (ends > 0))
            base.append(np.bincount(owner, np.log10(seen + 1) - unit, n) + np.log10(ends + 1) - unit)
            chances, end_chances = spelled(words, chance_of[np.searchsorted(distinct_grams, own)][place], begins)
            ended = blended(np.full(n, ends), end_chances, total, kinds)
            scores.append(np.bincount(owner, blended(seen, chances, total, kinds), n) + ended)
        return pa.table(
            {
                "_key": table.column("_key"),
                "_held": table.column("_held"),
                "n_tokens": pa.array(np.concatenate([p[2].counts for p in parts]) + 1, pa.int64()),
                "n_known": pa.array(np.concatenate(n_known), pa.int64()),
                "base_score": pa.array(np.concatenate(base), pa.float64()),
                "score": pa.array(np.concatenate(scores), pa.float64()),
            }
        )

    none = F.lit(None).cast("binary")
    asked = replies.select("bucket", "block", "counts", none.alias("chances"))
    asked = asked.unionByName(spelling.select("bucket", "block", none.alias("counts"), "chances"))
    out_ddl = f"_key {key_type}, _held boolean, n_tokens long, n_known long, base_score double, score double"
    scored = tagged.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(score, out_ddl)
    return scored.select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
