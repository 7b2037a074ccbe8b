import random
from collections import defaultdict

import numpy as np

from shelfcast.llm import jaccard as j
from tests.llm.helpers import docs


def brute(rows):
    sets = []
    for _, t in rows:
        w = j._words(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    inverted = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].add(i)
    for a in range(n):
        for b in {x for g in sets[a] for x in inverted[g] if x > a}:
            common = len(sets[a] & sets[b])
            if common * 10 >= 8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[top(b)] = top(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(repr((d, least.get(top(i)) if sets[i] else d, links[i])) for i, (d, _) in enumerate(rows))


def check(spark, rows):
    got = j.similar(docs(spark, rows)).collect()
    assert sorted(repr((r["doc_id"], r["class_id"], r["n_links"])) for r in got) == brute(rows)


def near(rng, n_groups=6, size=12, words=120):
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = near(rng) + [(500, None), (501, ""), (502, "one"), (503, "one"), (504, "one two"), (505, "a b c d e f"), (506, " a b c d e f\n")]
    rng.shuffle(rows)
    check(spark, rows)


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(j, "CELL", 5)
    check(spark, near(random.Random(9), 2, 40))


def test_many_cells_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(j, "BUCKET", 4)
    check(spark, near(random.Random(10), 3, 30))


def test_forest_joins_what_pairs_join():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, (5, j.BANDS * j.ROWS)).astype(np.uint8)
    low = base[rng.integers(0, 5, 60)]
    low = np.where(rng.random(low.shape) < rng.random((60, 1)) * 0.5, rng.integers(0, 256, low.shape), low).astype(np.uint8)
    least = [j.least_matches(0.8, n, j.TOLERANCE) for n in range(j.STEP, j.BANDS * j.ROWS + 1, j.STEP)]
    x, y = j.candidates(low, low, True, least)

    def sets(edges):
        root = list(range(len(low)))
        for a, b in edges:
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
        return {frozenset(i for i in range(len(low)) if root[i] == r) for r in root}

    forest = j.joined(low, least)
    assert sets(forest) == sets(zip(x.tolist(), y.tolist())) and 0 < len(forest) < len(low)


def test_a_common_passage_does_not_chain_groups(spark):
    # neighbours share half of their words: many have a key in common, none is a candidate
    parts = [" ".join(f"p{n}x{i}" for i in range(60)) for n in range(60)]
    rows = docs(spark, [(n, f"{parts[n]} {parts[n + 1]}") for n in range(59)])
    sets = [j.signature(j.shingles(r["text"])) for r in rows.collect()]
    keys = [set(j.band_keys(s)) for s in sets]
    assert sum(bool(a & b) for a, b in zip(keys, keys[1:])) > 5
    own = spark.createDataFrame([(n, list(k), s.astype(np.uint8).tobytes()) for n, (k, s) in enumerate(zip(keys, sets))], "node long, keys array<long>, low binary")
    least = [j.least_matches(0.8, n, j.TOLERANCE) for n in range(j.STEP, j.BANDS * j.ROWS + 1, j.STEP)]
    assert j._groups(own, least).count() <= 2
    check(spark, [(r["doc_id"], r["text"]) for r in rows.collect()])


def test_repeated_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(60))
    check(spark, [(1, text), (1, text), (1, "another text of some words here"), (None, text), (None, "lone words without any copy"), (4, text + " more")])


def test_empty_table_and_other_columns(spark):
    assert j.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    d = spark.createDataFrame([(1, "x y", 3, 4), (2, "x y", 5, 6)], "doc_id long, text string, node long, n long")
    assert [r["class_id"] for r in j.similar(d).collect()] == [1, 1]


def test_posterior_bound():
    # pruned only where a simulated posterior says so
    least = j.least_matches(0.8, 16, 1e-3)
    rng = np.random.default_rng(0)
    tail = lambda m: (rng.beta(m + 1, 17 - m, 400_000) >= 0.8).mean()
    assert tail(least) >= 0.5e-3 and tail(least - 1) < 2e-3
    assert j.least_matches(0.8, 128, 1e-9) < 0.8 * 128


def test_products_and_intersections_agree():
    rng = np.random.default_rng(3)
    left = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    right = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(50)]
    x, y = map(np.ravel, np.indices((40, 50)))
    whole = j.verified(x, y, left, right, 0.3)
    parts = np.concatenate([j.verified(x[i : i + 500], y[i : i + 500], left, right, 0.3) for i in range(0, len(x), 500)])
    assert (whole == parts).all() and whole.any()


def test_connected_sets(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in j.connected(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: top(x) for e in edges for x in e if e[0] != e[1]}
