"""Operator 5: round trips, revisits, and lookups through the index."""

import base64
import gzip
import hashlib

from ledgerline.llm import common, warc

PAGES = [
    (3, "http://www.example.org/a?x=1", "<p>eins</p>"),
    (1, "https://sub.example.org:8443/B", "<p>eins</p>"),
    (2, "http://example.com/", None),
    (7, None, ""),
    (5, "not a url \r\n WARC/1.1", "zwei\r\n\r\nWARC/1.1\r\n\r\n\x00 é"),
    (4, "http://[broken", "<p>eins</p>"),
    (None, "http://example.org/none", "drei"),
    (8, "http://example.org/none", "drei"),
    (9, "http://example.org/a?x=1", "x" * 300_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(p, u, h, 1, "k") for p, u, h in rows], "page_id long, url string, html string, sha int, key string")


def written(spark, rows, min_bytes=0, lines=4):
    archives, index = common.scratch_path(spark, "t5"), common.scratch_path(spark, "t5")
    warc.write_archives(frame(spark, rows), archives, min_bytes)
    warc.build_index(spark, archives, index, lines)
    return archives, index


def plain(rows, min_bytes=0):
    rank = lambda p: 2**63 if p is None else p
    out = {}
    for p, _, h in rows:
        body = (h or "").encode()
        first = min((q for q, _, g in rows if (g or "") == (h or "")), key=rank)
        again = len(body) >= min_bytes and rank(first) != rank(p)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out[p] = (len(body), digest, "revisit" if again else "response", first if again else None)
    return out


def test_records_read_back(spark):
    for min_bytes in (0, 5):
        _, index = written(spark, PAGES, min_bytes)
        got = warc.lookup(frame(spark, PAGES), index).collect()
        found = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got}
        assert len(got) == len(PAGES) and found == plain(PAGES, min_bytes)


def test_files_are_plain_warc(spark):
    archives, _ = written(spark, PAGES)
    for row in common.read_blobs(spark, archives).collect():
        data = gzip.decompress(bytes(row["content"]))  # every member, one after the other
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def asked(spark, index, urls):
    return warc.lookup(spark.createDataFrame([(u, 1) for u in urls], "url string, key int"), index).collect()


def test_lookup_by_url(spark):
    many = [(i, f"http://site{i % 7}.example/{i}", f"body {i}") for i in range(60)]
    _, index = written(spark, many, lines=5)
    urls = [many[i][1] for i in (0, 13, 59, 13)] + ["http://nowhere.example/"]
    found = {(r["page_id"], bytes(r["payload"]).decode()) for r in asked(spark, index, urls)}
    assert found == {(i, f"body {i}") for i in (0, 13, 59)}
    assert len(asked(spark, index, urls)) == 3 and asked(spark, index, []) == []
    _, index = written(spark, PAGES, lines=2)
    assert {r["page_id"] for r in asked(spark, index, ["http://example.org/a?x=1"])} == {3, 9}


def test_lookup_writes_urls_as_records_do(spark):
    _, index = written(spark, [(1, "http://a/b c", "x"), (2, "http://a/\td", "y"), (3, None, "z"), (4, "http://a/", "w")])
    assert {r["page_id"] for r in asked(spark, index, ["http://a/b c", "http://a/\td", None])} == {1, 2, 3}


def test_url_with_captures_in_many_blocks(spark):
    rows = [(i, "http://hot/" if i % 3 else f"http://host{i}/", f"body {i}") for i in range(200)]
    _, index = written(spark, rows, lines=3)
    found = asked(spark, index, ["http://hot/", "http://host3/"])
    assert sorted(r["page_id"] for r in found) == sorted([3, *(i for i in range(200) if i % 3)])


def test_searches_read_only_what_may_hold_the_keys():
    blocks = [("a", "c"), ("c", "c"), ("c", "f"), ("h", "k")]
    rows = [{"first": x, "last": y, "file": "f", "offset": i, "length": 1} for i, (x, y) in enumerate(blocks)]
    got = warc._blocks_of(["b", "c", "g", "h"], warc.pa.Table.from_pylist(rows, warc._DIRECTORY))
    assert {r["offset"]: r["keys"] for r in got} == {0: ["b", "c"], 1: ["c"], 2: ["c"], 3: ["h"]}
    spans = [{"file": f, "offset": o, "length": 10} for f, o in [("x", 0), ("x", 10), ("x", 10**6), ("y", 0)]]
    assert [len(run) for run in warc._runs(spans)] == [2, 1, 1]


def test_keys():
    assert warc.capture_key("http://www.example.org/a?B") == "org,example)/a?b"
    assert warc.capture_key("https://x.example.org:8443") == "org,example,x:8443)/"
    assert warc.capture_key(None) == ")/"


def test_repeated_rows_and_empty_table(spark):
    same = [(1, "http://a/", "x"), (1, "http://a/", "x")]
    _, index = written(spark, same)
    got = [(r["record_type"], r["refers_to"]) for r in warc.lookup(frame(spark, same), index).collect()]
    assert sorted(got, key=str) == [("response", None), ("revisit", 1)]
    _, index = written(spark, [])
    assert warc.lookup(frame(spark, same), index).count() == 0
