import base64
import gzip
import hashlib

from eventmere.llm import warc
from eventmere.sources import paths

ROWS = [
    (1, "http://www.Example.com:80/a?b=1", "<p>é</p>"),
    (2, "https://example.com/a b", "<p>é</p>"),
    (3, None, ""),
    (4, "http://example.com", None),
    (5, "http://sub.example.com/x\r\ny", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
    (None, "http://example.com/", "<p>é</p>"),
    (7, "http://example.com/a b", "long " * 20_000),
    (8, "http://www.example.com/a?b=1", "other"),
    (9, "http://a.com/%41?x=%2F", "nine"),
    (10, "http://a.com/%41 é%", "ten"),
    (11, "http://[::1]:80/x", "eleven"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, file string")


def test_keys_reverse_the_host():
    assert warc.url_key("http://www.Example.com:80/a?b=1") == "com,example,www)/a?b=1"
    assert warc.url_key("https://example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == ""
    assert warc.url_key("http://u:p@[::1]:80/x") == "[::1])/x" and warc.url_key("http://[2001:DB8::1]:8080") == "[2001:db8::1]:8080)/"


def test_round_trip_through_the_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    monkeypatch.setattr(warc, "PART_ROWS", 3)
    folder = paths.fresh_folder(spark, "warc")
    index = warc.build_index(warc.write_archives(pages(spark), folder))
    captures = warc.lookup(index, warc.url_keys(pages(spark)))
    monkeypatch.setattr(warc, "READ_BYTES", 200)
    got = {r["page_id"]: r for r in warc.read_ranges(captures, folder, total_bytes=2000).collect()}
    assert captures.count() == len(ROWS) == len(got)
    last = {}
    for key, _, html in ROWS:
        last[html or ""] = max(k for k in (last.get(html or ""), key) if k is not None) if key or html in last else key
    for key, url, html in ROWS:
        payload = (html or "").encode()
        first = {"<p>é</p>": 2, "": 4}.get(html or "", key)
        row = got[key]
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (row["record_type"], row["refers_to"]) == (("response", None) if key == first else ("revisit", first))
        assert row["url"] == url
        assert row["payload"] == (payload if key == first else None)


def test_files_are_plain_warc(spark):
    folder = paths.fresh_folder(spark, "warc")
    captures = warc.write_archives(pages(spark), folder).collect()
    content = b"".join(gzip.open(f"{folder}/{name}").read() for name in {c["file"] for c in captures})
    assert content.count(b"WARC-Type: response") == 8 and content.count(b"WARC-Type: revisit") == 3


def test_lookup_of_absent_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    monkeypatch.setattr(warc, "PART_ROWS", 20)
    rows = [(i, "http://example.com/hot", str(i)) for i in range(100)] + [(200, "http://a.com/", "x"), (201, "http://z.com/", "y")]
    folder = paths.fresh_folder(spark, "warc")
    index = warc.build_index(warc.write_archives(pages(spark, rows), folder))
    keys = spark.createDataFrame([("com,example)/hot",), ("com,none)/",), ("zz",)], "url_key string")
    assert warc.lookup(index, keys).count() == 100


def test_empty_table(spark):
    folder = paths.fresh_folder(spark, "warc")
    index = warc.build_index(warc.write_archives(pages(spark, []), folder))
    assert warc.read_ranges(warc.lookup(index, warc.url_keys(pages(spark, []))), folder).count() == 0
