from collections import defaultdict

import pytest

from shelfcast.llm.lines import dedup_lines
from tests.llm.helpers import DOC, docs, same_rows

LONG = "This line is long enough to count"


def brute(rows):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(held[key(x)]) < 3 or i is not None and i == max(j for j in held[key(x)] if j is not None)]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def check(spark, rows):
    got = dedup_lines(docs(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    same_rows(map(tuple, got), brute(rows))


def test_small_cases(spark):
    check(spark, [(1, f"a\n{LONG}\nb"), (2, f" {LONG.upper()}\t"), (3, f"{LONG}\n{LONG}\n\n"), (4, "short\n\r\n"), (5, None), (6, ""), (7, "\n\n"), (8, "É" * 20), (9, "é" * 20)])


def test_two_documents_are_not_enough(spark):
    check(spark, [(1, f"{LONG}\n{LONG}"), (2, LONG), (2, LONG), (1, LONG)])


def test_null_ids_and_repeated_rows(spark):
    check(spark, [(None, LONG), (None, LONG), (3, LONG), (9, LONG), (9, LONG + "\nx")])


def test_corpus_against_brute_force(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_many_lines_take_seconds(spark):
    import time

    shared = "\n".join(f"this line is one of very many shared lines {i}" for i in range(100_000))
    began = time.time()
    got = {r["doc_id"]: r for r in dedup_lines(docs(spark, [(i, shared + f"\nown {i}") for i in (1, 2, 3)])).collect()}
    assert time.time() - began < 60
    assert got[1]["text"] == "own 1" and got[1]["n_dropped"] == 100_000 and got[3]["n_dropped"] == 0 and got[3]["text"].startswith("this line")


def test_hot_lines_can_be_split(spark):
    from pyspark.sql import functions as F

    from shelfcast.llm.common import split_join

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        other = F.col("id")
        for hot, own in ((F.lit(7).cast("long"), other + 100), (F.lit("hot"), other.cast("string")), (F.unhex(F.lit("AB")), F.unhex(F.md5(other.cast("string"))))):
            rows = spark.range(20_000, numPartitions=4).select(F.when(other % 3 == 0, hot).otherwise(own).alias("k"), F.sha2(other.cast("string"), 256).alias("v"))
            n = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
            out = split_join(rows, n, "k")
            assert sum(r["n"] > 1 for r in out.collect()) == 6667
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, LONG, 5, "k")], "doc_id long, text string, hash long, key string")
    assert dedup_lines(df).collect()[0].asDict() == {"doc_id": 1, "text": LONG, "hash": 5, "key": "k", "n_lines": 1, "n_dropped": 0}
    assert dedup_lines(spark.createDataFrame([], DOC)).count() == 0
    with pytest.raises(ValueError, match="n_lines"):
        dedup_lines(spark.createDataFrame([(1, LONG, 5)], "doc_id long, text string, n_lines int"))
