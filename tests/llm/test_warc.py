from __future__ import annotations

import gzip
import hashlib
import os

from pyspark.sql import functions as F

from tidemark.llm import warc

SMALL, LARGE = "x" * 99, "é" * 50
PAGES = [
    (5, "https://WWW.Example.com:8080/a?b#c", LARGE), (3, "http://example.com/z", LARGE), (9, "http://sub.example.com/", LARGE),
    (1, "http://example.com/z", SMALL), (2, "http://example.com/z", SMALL), (4, None, None), (6, "no address", ""),
    (7, "http://user@host/x y\r\nEvil: 1", "<p>\r\n\r\n</p>" * 100), (8, "http://example.com/z", "long " * 50000), (None, "http://e/", LARGE),
    (10, "http://b.org/", "twice" * 40), (10, "http://b.org/", "twice" * 40),
]


def expected():
    first = {}
    for i, _, html in PAGES:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    rows = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        refers = first.get(raw) if first.get(raw) != i else None
        rows.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(rows, key=str)


def stored(spark, folder, pages=PAGES):
    frame = spark.createDataFrame([(*page, "x") for page in pages], "page_id long, url string, html string, key string")
    return frame, warc.write(frame, f"{folder}/a")


def test_round_trip_through_the_index(spark, folder, corpus, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    frame, records = stored(spark, folder)
    shards = warc.index(records, f"{folder}/i")
    wanted = frame.select("page_id", warc.url_key(F.col("url")).alias("key"))
    read = warc.read(warc.lookup(wanted, f"{folder}/i", shards), f"{folder}/a")
    rows = [(r["page_id"], r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in read.collect()]
    assert sorted(rows, key=str) == expected()
    for row in read.where("record_type = 'response'").collect():
        assert hashlib.sha256(row["payload"]).hexdigest() == row["digest"] and len(row["payload"]) == row["payload_bytes"]
    missing = spark.createDataFrame([("com,example)/none", 1), ("", 99), ("zz", 1)], "key string, page_id long")
    assert warc.lookup(missing, f"{folder}/i", shards).collect() == []


def test_archives_are_plain_gzip_members(spark, folder, corpus):
    stored(spark, folder)
    raw = b"".join(gzip.open(f"{folder}/a/{name}").read() for name in os.listdir(f"{folder}/a"))
    assert raw.count(b"WARC/1.1\r\n") == len(PAGES) and b"\r\nEvil" not in raw.replace(b"%0D%0AEvil", b"")


def test_keys(spark):
    urls = ["https://WWW.Example.com:8080/a?b#c", "http://u@x.org", None, "no address"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    keys = [r[0] for r in frame.select(warc.url_key(F.col("url"))).collect()]
    assert keys == ["com:8080,example,www)/a?b", "org,x)", "", "no address"]


def test_empty_table(spark, folder, corpus):
    frame, records = stored(spark, folder, [])
    shards = warc.index(records, f"{folder}/i")
    wanted = frame.select("page_id", "key")
    assert shards == [] and warc.read(warc.lookup(wanted, f"{folder}/i", shards), f"{folder}/a").collect() == []
