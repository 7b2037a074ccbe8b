import base64
import gzip
import hashlib
import random

import pytest

from shelfcast.llm import warc
from shelfcast.llm.common import scratch_path

PAGE = "page_id long, url string, html string"


def run(spark, rows, smallest=0):
    pages = spark.createDataFrame(rows, PAGE).repartition(3)
    archive, index = scratch_path(spark, "t-warc"), scratch_path(spark, "t-cdx")
    captures = warc.write(pages, archive, smallest=smallest)
    shards = warc.build_index(captures, index)
    return captures, shards, index, archive, warc.look_up(captures, shards, index, archive).collect()


def brute(rows):
    out = []
    first = {}
    for i, _, h in rows:
        first[h or ""] = max(first.get(h or "", i), i)
    for i, _, h in rows:
        raw = (h or "").encode()
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]))
    return out


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    rng = random.Random(4)
    rows = [(i, rng.choice(["http://www.a.org/x", "https://b.c.a.org:8443/?q=1 2", "no url", "", None, "http://é.net/\n"]), rng.choice(["<p>é</p>", "", None, f"page {i}", "\r\n\r\n"])) for i in range(200)]
    *_, got = run(spark, rows)
    assert sorted((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(brute(rows))


def test_range_reads_and_payloads(spark):
    rows = [(i, f"http://h{i % 3}.com/{i}", f"<p>{i % 5} ünï</p>\r\n\r\n" * 50) for i in range(40)]
    captures, shards, index, archive, _ = run(spark, rows)
    found = warc.Index([tuple(r) for r in shards.select("first", "file", "at", "size").collect()], index, archive)
    for r in captures.collect():
        head, payload = found.get(r["key"])
        assert head["WARC-Record-ID"] == f"<urn:page:{r['id']}>"
        if head["WARC-Type"] == "response":
            assert payload.decode() == rows[r["id"]][2]
        else:
            assert payload == b"" and int(head["WARC-Payload-Length"]) == len(rows[r["id"]][2].encode())
        raw = gzip.decompress(warc.read_range(f"{archive}/{r['file']}", r["at"], r["size"]))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    assert found.find("zzz") is None and found.find("") is None


def test_keys_sort_by_host():
    assert warc.url_key("https://user@www.Blog.Example.org:443/a?b#c") == "org,example,blog)/a?b#c"
    assert warc.url_key("http://a.b:81") == "b,a:81)/" and warc.url_key("x/y") == ")x/y"
    assert warc._key("http://a.b/", 5, 0) < warc._key("http://a.b/", 10, 0)


def test_smallest_and_repeated_rows(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "u", "same"), (2, None, "x"), (3, None, "x")]
    *_, got = run(spark, rows, smallest=2)
    by = sorted((str(r["id"]), r["record_type"], r["refers_to"]) for r in got)
    assert by == [("1", "response", None), ("1", "response", None), ("2", "response", None), ("3", "response", None), ("None", "revisit", 1)]


def test_empty_and_missing(spark):
    captures, shards, index, archive, got = run(spark, [])
    assert got == [] and shards.count() == 0
    captures, shards, index, archive, _ = run(spark, [(1, "u", "x")])
    with pytest.raises(Exception, match="no capture"):
        warc.look_up(spark.createDataFrame([("a b", 1, 1)], "key string, id long, copy long"), shards, index, archive).collect()
