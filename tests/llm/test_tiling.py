import random

from shelfcast.llm import tiling as t
from tests.llm.helpers import docs

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_tile(doc, item, shortest):
    """Tiles by comparing every pair of places for every length."""
    used_d, used_i, total = set(), set(), 0
    for width in range(len(item), shortest - 1, -1):
        for a in range(len(doc) - width + 1):
            for b in range(len(item) - width + 1):
                if doc[a : a + width] == item[b : b + width] and not used_d & set(range(a, a + width)) and not used_i & set(range(b, b + width)):
                    used_d |= set(range(a, a + width))
                    used_i |= set(range(b, b + width))
                    total += width
    return total


def test_tiles_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        item = [rng.randrange(6) for _ in range(rng.randrange(3, 25))]
        doc = [rng.randrange(6) for _ in range(rng.randrange(0, 40))]
        at = rng.randrange(len(doc) + 1)
        doc[at:at] = item[len(item) // 2 :] + item[: len(item) // 2]
        assert sum(x[2] for x in t.tile(doc, item, 3)) == brute_tile(doc, item, 3)


def test_reordered_passages_and_short_items(spark):
    words = ITEM.split()
    rows = [(1, f"x {ITEM.upper()}! y"), (2, " ".join(words[6:] + ["and"] + words[:6])), (3, " ".join(words[:5])), (4, " ".join(sorted(words))), (5, None), (6, ""), (7, "say two words now"), (None, ITEM)]
    got = t.contaminated(docs(spark, rows), items(spark, [(10, ITEM), (11, "Two words"), (12, None), (13, "..."), (None, ITEM)])).collect()
    assert all(r["n_covered"] == r["n_tokens"] == (2 if r["item_id"] == 11 else 12) for r in got)
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, i) for d in (1, 2, None) for i in (10, None)} | {(7, 11)}
    clean = t.clean_rows(docs(spark, rows), items(spark, [(10, ITEM), (11, "Two words")]))
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in clean.collect()} == {3, 4, 5, 6}


def test_a_full_bitmap_does_not_change_the_result(spark, sf_small):
    d, b = (spark.read.parquet(f"{sf_small}/{n}.parquet") for n in ("documents", "benchmark"))
    whole, full = (sorted(map(tuple, t.contaminated(d, b, threshold=0.1, bits=n).collect())) for n in (t.BITS, 64))
    assert whole == full and whole


def test_copies_of_texts_and_items(spark):
    rows = [(n % 3, f"x {ITEM}") for n in range(30)] + [(7, None), (8, ITEM.upper())]
    got = t.contaminated(docs(spark, rows), items(spark, [(1, ITEM), (1, ITEM), (2, f"{ITEM}!"), (3, "lone words")])).collect()
    assert len(got) == 31 * 3 and all(r["coverage"] == 1 for r in got)
    assert sum(r["doc_id"] == 8 and r["item_id"] == 1 for r in got) == 2
    kept = t.clean_rows(docs(spark, rows), items(spark, [(1, ITEM)]))
    assert [r["doc_id"] for r in kept.collect()] == [7]


def test_one_long_text_and_one_repeated_token(spark):
    rng = random.Random(2)
    item = " ".join(f"i{n}" for n in range(40))
    long = " ".join(f"w{rng.randrange(1000)}" for _ in range(200_000))
    rows = [(1, f"{long} {item} {long}"), (2, long), (3, "na " * 50_000)]
    got = t.contaminated(docs(spark, rows), items(spark, [(1, item), (2, "na " * 30)])).collect()
    assert {(r["doc_id"], r["item_id"], r["n_covered"]) for r in got} == {(1, 1, 40), (3, 2, 30)}


def test_clashing_columns_pass_through(spark):
    d = spark.createDataFrame([(1, ITEM, b"a", 2, 3), (2, "clean", None, 4, 5)], "doc_id long, text string, digest binary, h long, doc long")
    kept = t.clean_rows(d, items(spark, [(1, ITEM)]))
    assert kept.columns == d.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", None, 4, 5)]


def test_hot_seeds_can_be_split(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        plan = t.contaminated(docs(spark, [(1, ITEM)]), items(spark, [(1, ITEM)]))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning(_on") == 4


def brute(documents, benchmark):
    """``(doc_id, item_id, covered)`` of contaminated pairs, pair by pair."""
    out = set()
    texts = [(d, t.tokens((text or "").lower())) for d, text in documents]
    for item_id, text in benchmark:
        item = t.tokens(text.lower())
        k = min(5, len(item))
        seeds = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)}
        for doc_id, doc in texts:
            if any(tuple(doc[i : i + k]) in seeds for i in range(len(doc) - k + 1)):
                n = sum(z[2] for z in t.tile([hash(w) & 0xFFFFFFFF for w in doc], [hash(w) & 0xFFFFFFFF for w in item], k))
                if n >= 0.6 * len(item):
                    out.add((doc_id, item_id, n))
    return out


def test_corpus_against_brute_force(spark, sf_small):
    d, b = (spark.read.parquet(f"{sf_small}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in d.collect()], [(r["item_id"], r["text"]) for r in b.collect()])
    assert {(r["doc_id"], r["item_id"], r["n_covered"]) for r in t.contaminated(d, b).collect()} == want and want


def test_empty_tables(spark):
    d, b = docs(spark, [(1, ITEM)]), items(spark, [(1, ITEM)])
    assert t.contaminated(d.limit(0), b).count() == t.contaminated(d, b.limit(0)).count() == 0
    assert t.clean_rows(d, b.limit(0)).count() == 1
