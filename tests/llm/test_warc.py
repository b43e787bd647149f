import gzip
import hashlib
from collections import defaultdict

import pytest

from tallymill.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string, digest string, offset int"


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page is not None:
            groups[payload].append(page)
    found = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = max(groups[payload], default=None)
        revisit = len(payload) >= 1000 and first is not None and page != first
        found.append(
            (page, "revisit" if revisit else "response", len(payload), hashlib.sha1(payload).hexdigest(), first if revisit else None)
        )
    return sorted(found, key=str)


BIG = "<p>é</p>\r\n\r\n" * 200
ROWS = [
    (1, "http://www.Example.com/a", BIG),
    (2, "http://www.example.com/a", BIG),
    (3, None, None),
    (4, "no url at all", ""),
    (5, "https://example.com:8443/x?y=1#z", "x" * 999),
    (6, "https://example.com:8443/x?y=1", "x" * 999),
    (7, "https://example.com/\r\nbad: header", "x" * 1000),
    (8, "http://[broken", "x" * 1000),
    (None, "http://example.com", BIG),
    (None, "http://example.com", "x" * 2000),
    (9, "http://a.b", "WARC/1.1\r\n\r\n" * 100_000),
    (9, "http://a.b", "WARC/1.1\r\n\r\n" * 100_000),
    (9, "http://a.b", "another with that number"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("block, files", [(256, 8192), (2, 3)])
def test_round_trip(spark, monkeypatch, block, files):
    monkeypatch.setattr(warc, "BLOCK_LINES", block)
    monkeypatch.setattr(warc, "FILE_CAPTURES", files)
    rows = ROWS + [(100 + i, f"http://host{i % 5}.org/{i}", f"page {i % 40} " * 200) for i in range(200)]
    found = warc.archive_round_trip(frame(spark, rows), payloads=True).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected(rows)
    html = defaultdict(set)
    for page, _, text in rows:
        html[page].add((text or "").encode())
    assert all(r.payload is None or bytes(r.payload) in html[r.page_id] for r in found)


def test_only_what_is_asked_for_is_read(spark, tmp_path):
    rows = [(i, f"http://host{i % 7}.org/{i // 7}", f"text {i}") for i in range(500)]
    index = warc.write_index(warc.write_archives(frame(spark, rows), f"{tmp_path}/warc"), f"{tmp_path}/index")
    asked = spark.createDataFrame([("http://HOST3.org:80/0", 3), ("http://host1.org/1", 9)], "url string, page_id bigint")
    assert [r.page_id for r in warc.read_captures(asked, index).collect()] == [3]


def test_keys():
    keys = [warc.url_key(u) for u in ("http://www.Example.com:80/a?b#c", "https://x.org", "http://x.org:81/", None, "text")]
    assert keys == ["com,example,www)/a?b", "org,x)/", "org,x:81)/", "", "text"]


def test_records_are_plain_warc():
    member = warc.make_record(7, "http://a b/é", b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    text = gzip.decompress(member)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\npayload\r\n\r\n")
    assert b"WARC-Target-URI: http://a%20b/%C3%A9\r\n" in text
    damaged = gzip.compress(text.replace(b"payload\r\n", b"pAyload\r\n"))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(damaged)


def test_empty_table(spark):
    assert warc.archive_round_trip(frame(spark, [])).collect() == []


def test_query_agrees_with_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    found = queries.op7_warc(spark, sf_dir).select(*names).collect()
    assert sorted(map(tuple, found), key=str) == expected(pages)
