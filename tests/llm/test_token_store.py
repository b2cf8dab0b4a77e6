import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cases import SCHEMA, frame, texts
from eventmere.llm import catalog, encoding, shared, token_store
from eventmere.sources import paths

FILE = token_store.vocabulary_file("word_bpe_49k.json")
ODD = [
    (30, "Special <|endoftext|>joined<|startoftext|> text"), (31, "İSTANBUL ΣΑΣ ΣΑΣ. ß é ǅ"), (32, "a b c\u0085d\x1ce​f"),
    (33, "don't I'll 123 日本語 🙂 ́accent é x\ńy"), (34, "'s 't \x00 \x0b\x0c|"), (-5, "negative id"),
]


def brute(rows):
    """Documents in order; equal ids by digest, which the order of equal rows does not show."""
    plain = Tokenizer.from_file(FILE)
    return {(i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows}


@pytest.mark.parametrize("by_words", [True, False])
def test_round_trip(spark, monkeypatch, by_words):
    monkeypatch.setattr(token_store, "SHARD_IDS", 4000)
    monkeypatch.setattr(token_store, "KNOWN", 500)
    monkeypatch.setattr(encoding, "KNOWN", 300)
    if not by_words:
        monkeypatch.setattr(token_store, "word_pattern", lambda blob: None)
    monkeypatch.setattr(token_store, "SAMPLE_PIECES", 3)
    rows = texts() + ODD
    store = token_store.write_store(frame(spark, rows), paths.fresh_folder(spark, "ids"), FILE, 1)
    got = store.read().collect()
    assert len(got) == len(rows) and store.width == 2
    assert {(r["doc"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in got} == brute(rows)
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_ids"] for r in got]])[:-1].tolist()
    ids = [r["doc"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert store.shards().count() > 2


def test_words_as_the_library_encodes_them():
    plain = Tokenizer.from_file(FILE)
    rng = random.Random(4)
    letters = "aeiouAEIOU'sdtrevlm.,!?#$%&*()-_=+[]{}|;:\"<>/\\0123456789éÉñÑßİıſŉǅªº²½×÷\u00ad\u0301日🙂Σσς<|endoftext|>\x00\x1c\x7f\u0085\u00a0\u2003\ufb01"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    made += ["x<|endoftext|>y", "<|endoftext|>", "don't", "I'LL'S", "''s's"]
    words = token_store.Words(token_store.file_bytes(FILE), 2)
    texts_ = [" ".join(made[i : i + 40]) for i in range(0, len(made), 40)]
    for text, got in zip(texts_, words.encode([t.encode() for t in texts_])):
        assert np.frombuffer(got, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_lookup_reads_single_documents(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 4000)
    rows = texts() + ODD
    store = token_store.write_store(frame(spark, rows), paths.fresh_folder(spark, "ids"), FILE, 1)
    wanted = spark.createDataFrame([(4,), (4,), (31,), (999,), (None,), (-5,)], "doc_id long")
    got = {(r["doc"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in store.lookup(wanted).collect()}
    assert got == {x for x in brute(rows) if x[0] in (4, 31, -5)}


def test_another_dictionary_is_refused(spark):
    store = token_store.write_store(frame(spark), paths.fresh_folder(spark, "ids"), FILE, 1)
    store.dictionary = b"other" * 100
    with pytest.raises(Exception, match="another dictionary"):
        store.read().collect()


def test_dictionary_helps_short_documents(spark):
    rows = [(i, f"the usual licence text of part {i} applies to this file and all others") for i in range(3000)]
    store = token_store.write_store(frame(spark, rows), paths.fresh_folder(spark, "ids"), FILE, 1)
    index = store.index.agg({"length": "sum", "n_ids": "sum"}).first()
    assert index["sum(length)"] < index["sum(n_ids)"] * 2 * 0.8  # alone, a frame of this size is longer than its array


def test_empty_table(spark):
    store = token_store.write_store(spark.createDataFrame([], SCHEMA), paths.fresh_folder(spark, "ids"), FILE, 1)
    assert store.read().count() == 0


def test_query_on_small_tables(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in catalog.queries()["op12_token_store"](spark, folder).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in shared.table(spark, folder, "documents").collect())
    plain, start = Tokenizer.from_file(FILE), 0
    assert len(got) == len(docs)
    for doc, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        assert got[doc] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_a_word_that_comes_again_stays_known(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN", 200)
    words, asked = token_store.Words(token_store.file_bytes(FILE), 2), []
    plain = words.encoder.pieces
    monkeypatch.setattr(words.encoder, "pieces", lambda pieces: asked.extend(pieces) or plain(pieces))
    rng = random.Random(5)
    for n in range(30):
        own = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(30)]
        words.encode([" ".join(own + ["often"] * (n % 3 == 0)).encode()])
    assert asked.count("often") == 1


def test_capitals_and_marks_do_not_make_new_words(monkeypatch):
    words, asked = token_store.Words(token_store.file_bytes(FILE), 2), []
    plain = words.encoder.pieces
    monkeypatch.setattr(words.encoder, "pieces", lambda pieces: asked.extend(pieces) or plain(pieces))
    text = "House house, HOUSE. (house) house's ... house! \thouse,House"
    whole = Tokenizer.from_file(FILE)
    for got in words.encode([text.encode(), b"", b"house", b"House."]):
        text, own = (text, whole.encode(text, add_special_tokens=False).ids) if len(got) > 4 else (text, None)
        if own:
            assert np.frombuffer(got, "<u2").tolist() == own
    assert sorted(asked) == sorted(["house", ",", ".", "(house)", "house's", "...", "!", "house,House"])


def test_pieces_are_drawn_for_a_batch_at_once(monkeypatch):
    monkeypatch.setattr(token_store, "PIECE_BYTES", 8)
    arrays = pa.array([random.Random(n).randbytes(n % 37) for n in range(300)], pa.binary())[5:]
    rows, limit, calls = np.arange(295) * 2**33, np.uint64(2**62), []
    want = []
    for row, data in zip(rows.tolist(), arrays.to_pylist()):
        lots = token_store.mix(token_store.mix(np.full(1, row, np.uint64)) + np.arange(-(-len(data) // 8), dtype=np.uint64))
        want += [data[i * 8 : i * 8 + 8] for i in np.flatnonzero(lots <= limit).tolist()]
    mix = token_store.mix
    monkeypatch.setattr(token_store, "mix", lambda values: calls.append(1) or mix(values))
    assert token_store.drawn(rows, arrays, limit) == want and 0 < len(want) < 600
    assert len(calls) == 2
    assert token_store.drawn(rows[:0], arrays[:0], limit) == []
