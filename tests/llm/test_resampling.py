import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import resampling
from tests.llm.helpers import docs

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [None, "", " ", "...", "One", "One two", "a-b_c  D\te\n\nf", "\u00dcber \u65e5\u672c\u8a9e 12,5", "x" * 500 + " y", "K\u212a \x7f\x80 z", "w " * 30, "long" * 40 + " " + "tail" * 60]


def plain(rows, targets, n=2, buckets=10_000, percent=25, least=20):
    """The same result, feature by feature."""
    def found(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(low)
        runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    all_found = [found(t) for _, t in rows]
    s, t = (Counter(b for _, f in fs for b in f) for fs in (all_found, map(found, targets)))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (words, f) in zip(rows, all_found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, words])
    may = sorted((r for r in out if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for rank, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = rank
    return sorted(repr(tuple(r[:5])) for r in out)


def ours(df, targets, **kw):
    return sorted(repr(tuple(r)) for r in resampling.resample(df, targets, **kw).collect())


@pytest.mark.parametrize(("n", "buckets"), [(1, 50), (2, 10_000), (4, 70_000)])
def test_equals_plain_counts(spark, sf_small, n, buckets):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(120).collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)]
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    targets = [r.text for r in bench.collect()]
    assert ours(docs(spark, rows), bench, n=n, buckets=buckets) == plain(rows, targets, n, buckets)


def test_nulls_ties_and_repeated_rows(spark):
    text = "one two three " * 10
    rows = [(None, text), (1, text), (1, text), (2, text), (3, None), (4, "few words")] + [(i, text + str(i)) for i in range(5, 40)]
    bench = spark.createDataFrame([(None,), ("",), ("One two",)], "text string")
    got = ours(docs(spark, rows), bench, percent=50)
    assert got == plain(rows, [None, "", "One two"], percent=50)
    assert any(r.startswith("(None, 59") and "None, None)" in r for r in got)


def test_empty_tables(spark):
    none = docs(spark, [(1, "a")]).limit(0)
    bench = spark.createDataFrame([("a b",)], "text string")
    assert ours(none, bench) == []
    rows = [(i, "a b c " * 9 + str(i)) for i in range(8)]
    assert ours(docs(spark, rows), bench.limit(0)) == plain(rows, [])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 12, 5, 6, 7)], "doc_id long, text string, id long, score long, rank long")
    bench = spark.createDataFrame([("a", 3)], "text string, id long")
    assert ours(df, bench, percent=100) == plain([(1, "a b " * 12)], ["a"], percent=100)


def test_crc_of_spans():
    data = bytes(range(1, 200)) * 3
    start, end = np.array([0, 5, 5, 100, 7]), np.array([1, 5, 30, 400, 60])
    before = np.array([0, 9, 77, 5, 0], np.uint32)
    assert resampling.crc_of_spans(data, start, end, before).tolist() == [zlib.crc32(data[a:b], c) for a, b, c in zip(start, end, before.tolist())]
