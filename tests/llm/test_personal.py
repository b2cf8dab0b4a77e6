import re
import time

from pyspark.sql import functions as F

from cases import frame, texts
from eventmere.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base(text):
    return ",".join(
        f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])
    )


ODD = [
    (1, "a@b.c._x@d.e f@g@h.i @x.y a@b é@q.r Zé.b@c.d.e-f.g"),
    (2, "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.4 00000000255.1.1.1 1.2.3"),
    (3, "4111111111111111 4111-1111-1111-1111 4111 1111 1111 1111 2 41111111111111112 1 2 3 4 5 6"),
    (4, "+1 (988) 555-2485 +123 +1 2 3 4 5 6 7 8 9) +12345678901234567 ++49.30.123456"),
    (5, "漢字 a@b.c 漢 1.2.3.4😀1.2.3.4"),
    (6, "9" * 20_000 + " " + "1 " * 20_000 + "a" * 20_000 + "@" + "1." * 5_000),
    (7, "a@b.c" + "a@b.c"),
]


def test_base_spans_against_brute_force(spark):
    rows = texts() + ODD
    found = personal.find_personal(frame(spark, rows)).select("text", personal.listed(F.col("__base")).alias("s")).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["s"] == base(row["text"]), row["text"][:80]


def test_contexts_learned_from_seeds_find_new_spans(spark):
    rows = [(i, f"filler {i} reach me on +1 (98{i}) 555-248{i} today") for i in range(9)]
    rows += [(50, "filler reach me on 555-123-4567 now"), (51, "odd words 555-123-4567 now"), (52, "é reach  me\non (555) 123-4567")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found if r["s"]} == {50: "phone:19:31", 52: "phone:15:29"}


def test_phones_without_a_hyphen_in_the_text(spark):
    rows = [(i, f"filler {i} reach me on +1 (98{i}) 555-248{i} today") for i in range(9)]
    rows += [(50, "filler reach me on 555.123.4567 now"), (51, "reach me on (555) 123.4567")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found if r["s"]} == {50: "phone:19:31", 51: "phone:12:26"}


def test_sure_instances_support_a_context_without_seeds(spark):
    rows = [(i, f"filler reach me on +1 (9{i}) 555-2485 today") for i in range(10, 90)]
    rows += [(100 + i, f"reach me on 555-123-456{i} now") for i in range(9)]
    rows += [(200 + i, f"my new line 555-123-456{i} now") for i in range(9)] + [(300, "my new line 555-999-0000 now")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found}[300] == "phone:12:24"


def test_numbers_in_a_list_share_the_context_of_the_first(spark):
    rows = [(i, f"filler {i} reach me on +1 (98{i}) 555-248{i} today") for i in range(9)]
    rows += [(50, "reach me on 555-123-4567 or 555-765-4321, 555-765-4322"), (51, "odd words 555-123-4567 or 555-765-4321")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found if r["s"]} == {50: "phone:12:24,phone:28:40,phone:42:54"}


def test_words_after_a_span_are_a_context_too(spark):
    rows = [(i, f"{'abcdefghi'[i]} x{i} +1 (98{i}) 555-248{i} rings my desk") for i in range(9)]
    rows += [(50, "555-123-4567 rings  my bell"), (51, "555-123-4567 is something else")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found if r["s"]} == {50: "phone:0:12"}


def test_candidates_inside_base_spans_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(personal, "CELL", 3)
    rows = [(i, f"filler {i} reach me on +1 (98{i}) 555-248{i} today") for i in range(9)]
    rows += [(50, "reach me on 555-123-4567.x@example.org now"), (51, "reach me on 555-123-4567 a@b.c")]
    found = personal.find_personal(frame(spark, rows)).select("doc_id", personal.listed(F.col("__added")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found if r["s"]} == {51: "phone:12:24"}


def test_very_many_matches_in_one_text(spark):
    many = " ".join(f"call u{i}@example.org or 555-123-{i % 10_000:04d};" for i in range(60_000))
    start = time.time()
    found = personal.find_personal(frame(spark, [(1, many), (2, "x")])).select("doc_id", F.size("__base").alias("n"), personal.listed(F.col("__base")).alias("s"))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert time.time() - start < 60
    assert rows[1]["n"] == 60_000 and rows[1]["s"] == base(many)


def test_masking(spark):
    rows = [(1, "é a@b.c x +1 (988) 555-2485"), (2, None), (3, "plain")]
    got = {r["doc_id"]: r for r in personal.mask_personal(frame(spark, rows), size="n_chars").collect()}
    assert got[1]["text"] == "é [EMAIL] x [PHONE]" and got[1]["n_chars"] == 19
    assert got[2]["text"] is None and got[3]["text"] == "plain" and got[3]["n_words"] == "clash"


def test_no_python_and_empty_table(spark):
    assert personal.find_personal(frame(spark, [])).count() == 0
    plan = personal.scan(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
