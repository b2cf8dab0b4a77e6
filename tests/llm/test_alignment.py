import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import SCHEMA, frame, texts
from eventmere.llm import alignment
from eventmere.llm.encoding import file_bytes, vocabulary_file

FILES = [vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")]
ODD = [
    (20, " leading and  double   spaces \n\n\tx"), (21, "▁ is taken for a space"), (22, "<|endoftext|> <s> <0x41> <unk>"),
    (23, "日本語のテキスト 🙂🙂 é é"), (24, " nbsp\u0085nel\x00nul\x01"), (25, "a"), (26, " "),
    (27, "https://example.org/a?b=c&d=%20 " * 50), (28, "a;\r\nb )\r{ \r\r x"), (29, "\u00a0 a\u2003\nb\x1cc \x0bd  \n"),
    (30, "don't I'll 'S '' \t\tx\n\n\ny   z"),
]


def brute(rows):
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    from tokenizers import pre_tokenizers

    alphabet = {}  # the letters of the bytes, as the library's own byte-level step writes them
    step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for cp in [*range(0x80), *range(0x80, 0x800), *range(0x800, 0x10000, 61), *range(0x10000, 0x110000, 0x1000)]:
        if 0xD800 <= cp < 0xE000:
            continue
        letters = "".join(x for x, _ in step.pre_tokenize_str(chr(cp)))
        alphabet.update(zip(letters, chr(cp).encode()))
    docs, counts = [], Counter()
    for i, text in rows:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        by_a = [bytes(alphabet[c] for c in a.id_to_token(t)) for t in ids_a]
        by_b = [bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode() for t in ids_b]
        if not text or b"".join(by_a) != whole or b"".join(by_b) != whole:
            docs.append((i, [], [], [], []))
            continue
        ends = [[sum(map(len, x[: n + 1])) for n in range(len(x))] for x in (by_a, by_b)] if len(whole) < 3000 else [
            np.cumsum([len(t) for t in x]).tolist() for x in (by_a, by_b)]
        spans = [list(zip([0, *e], e)) for e in ends]
        links, j = [], 0
        for n, (lo, hi) in enumerate(spans[0]):
            while spans[1][j][1] <= lo:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < hi:
                links.append((ids_a[n], ids_b[k]))
                k += 1
        common, groups, last = sorted(set(ends[0]) & set(ends[1])), [], 0
        for end in common:
            part = ["" .join(",".join(str(t) for t, (lo, hi) in zip(ids, sp) if last <= lo and hi <= end)) for ids, sp in zip((ids_a, ids_b), spans)] if len(whole) < 3000 else None
            groups.append(part)
            last = end
        if len(whole) >= 3000:
            groups, x, y = [], 0, 0
            for end in common:
                p, q = x, y
                while x < len(ends[0]) and ends[0][x] <= end:
                    x += 1
                while y < len(ends[1]) and ends[1][y] <= end:
                    y += 1
                groups.append([",".join(map(str, ids_a[p:x])), ",".join(map(str, ids_b[q:y]))])
        counts.update(links)
        docs.append((i, ids_a, ids_b, groups, links))
    best = {}
    for (_, t), n in counts.items():
        best[t] = max(best.get(t, 0), n)
    return [
        (i, len(x), len(y), len(g), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k),
         hashlib.sha256(";".join("|".join(s) for s in g).encode()).hexdigest() if g else "")
        for i, x, y, g, k in docs
    ]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", *alignment.RESULT).collect()), key=str)


@pytest.mark.parametrize("piece", [1 << 16, 7])
def test_odd_texts_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE", piece)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    rows = texts() + ODD + ODD[:2]
    files = [file_bytes(f) for f in FILES]
    got = alignment.align(frame(spark, rows), alignment.byte_and_piece, *files)
    assert rows_of(got) == sorted(brute(rows), key=str)


def test_paths_divide_evenly_and_keep_equal_ends_together():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 40)))) for _ in "ab")
        last = max(a[-1], b[-1]) + 1
        a, b = np.append(a, last), np.append(b, last)
        piece = rng.randint(2, 9)
        i, j = alignment.cut_paths(a, b, piece)
        sizes = np.diff(i + j)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        assert (sizes[:-1] >= piece - 1).all() and (sizes <= piece + 1).all()
        for x, y in zip(i[1:-1], j[1:-1]):
            assert max([*a[:x], *b[:y]]) < min([*a[x:], *b[y:]], default=last + 1)


def test_query_on_small_tables(spark):
    from eventmere.llm import catalog, shared

    folder = "/root/testdata/sf0.001"
    got = rows_of(catalog.queries()["op13_token_alignment"](spark, folder))
    docs = [(r["doc_id"], r["text"]) for r in shared.table(spark, folder, "documents").collect()]
    assert got == sorted(brute(docs), key=str)


def test_empty_table(spark):
    files = [file_bytes(f) for f in FILES]
    assert alignment.align(spark.createDataFrame([], SCHEMA), alignment.byte_and_piece, *files).count() == 0
