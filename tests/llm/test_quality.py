import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import quality as q
from tests.llm.helpers import docs

_W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = _W.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if _W.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "#x", "\n", " ", "\x1c", "É", "|", "\t", "\x85", "cc"]), max_size=60), st.sampled_from([" ", "", "  "]))
def test_statistics(parts, sep):
    text = sep.join(parts)
    assert q.statistics(text)[:5] == brute(text)


def test_repeats(spark):
    text = " ".join(["one two three four five six seven eight nine ten"] * 2)
    assert q.statistics(text)[4] == 20 and q.statistics("x " * 9)[4] == 9 and q.statistics("x " * 8)[4] == 0


def test_corpus_and_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("doc_id", "text", "quality").orderBy("doc_id").collect()
    stats, good = np.array([q.statistics(r["text"]) for r in rows]), np.array([r["quality"] == 1 for r in rows])
    assert [tuple(s[:5]) for s in stats.tolist()] == [brute(r["text"]) for r in rows]
    held = np.arange(len(rows)) % 2 == 1
    forest = q.fit(stats[~held], good[~held])
    passed = (stats[:, 0] >= 20) & (100 * stats[:, 4] <= 30 * stats[:, 0])
    keeps = forest.keeps(q.features(stats))
    assert keeps[held & good & passed].mean() >= 0.98 and (keeps & passed)[held & ~good].mean() <= 0.1


def test_judge_edge_cases(spark):
    d = docs(spark, [(1, None), (2, ""), (3, "word " * 19), (None, "Plain words of a text. " * 1), (4, "a b c d e f g h " * 30)])
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 1), (99, 1)], "doc_id long, quality int")
    forest = q.train(d, labels)
    assert forest is None
    got = {r["doc_id"]: r for r in q.judge(d, forest).collect()}
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (1, 2, 3, 4, None)) and got[1]["n_words"] == 0
    assert q.judge(d.limit(0), forest).count() == 0 and q.good_rows(d, forest).count() == 0
    assert q.judge(d, q.train(d, labels.limit(0))).count() == 5


def test_good_rows_agree_with_judge(spark):
    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    forest = q.train(d, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r[0] for r in q.judge(d, forest).where("kept").select("doc_id").collect()}
    rows = q.good_rows(d, forest)
    assert rows.columns == d.columns and {r[0] for r in rows.select("doc_id").collect()} == kept and kept
