import numpy as np
import pytest

from shelfcast.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    """Brute force over rows ``(id, float32 vector)``, each pair once."""
    out = {}
    for q, x in queries:
        scored = sorted((-float(np.dot(x.astype(np.float64), v.astype(np.float64))), i) for i, v in rows if not (i == q and np.array_equal(v, x)))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(result):
    out = {}
    for r in result.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for rows in out.values():
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    return {q: [(i, s) for _, i, s in rows] for q, rows in out.items()}


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def clustered(n, dim, seed=3, norms=False):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, dim))
    x = centers[rng.integers(0, 6, n)] + 0.6 * rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.uniform(0.2, 3.0, (n, 1))
    return x.astype(np.float32)


@pytest.mark.parametrize("norms", [False, True])
def test_one_leaf_is_exact(spark, norms):
    x = clustered(300, 8, norms=norms)
    rows = list(enumerate(x))
    df = frame(spark, rows)
    got = found(nb.search(nb.build(df), df.where("vec_id % 20 = 0")))
    want = exact(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


@pytest.mark.parametrize(("leaf", "branch", "norms"), [(200, 32, False), (60, 4, False), (150, 8, True)])
def test_recall_of_trees(spark, leaf, branch, norms, monkeypatch):
    monkeypatch.setattr(nb, "CELL", 64)
    x = clustered(1200, 16, norms=norms)
    rows = list(enumerate(x))
    df = frame(spark, rows)
    index = nb.build(df, leaf=leaf, branch=branch, sample=600)
    assert len(index.levels) == (3 if branch == 4 else 1)
    assert sorted(r["entry"] for r in index.members.collect()) == sorted({r["entry"] for r in index.members.collect()})
    assert index.members.count() == 1200 and index.members.select("node").distinct().count() > 3
    queries = [r for r in rows if r[0] % 20 == 0]
    got = found(nb.search(index, df.where("vec_id % 20 = 0")))
    assert all(len(r) == 20 for r in got.values()) and len(got) == len(queries)
    assert recall(got, exact(rows, queries, 20)) > 0.9


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float32)) for r in df.collect()]
    index = nb.build(df)
    assert len(index.levels) == 1
    got = found(nb.search(index, df.where("vec_id % 20 = 0")))
    assert recall(got, exact(rows, [r for r in rows if r[0] % 20 == 0], 20)) >= 0.9


def test_copies_ties_and_rows_that_take_no_part(spark):
    a, b, c = [1, 0, 0], [0, 1, 0], [1, 1, 0]
    rows = [(i, a) for i in range(100, 40, -1)] + [(20, b), (20, b), (20, c), (40, c), (0, a), (1, b), (2, [-1, -0.0, 0])]
    bad = [(3, None), (4, []), (5, [0, 0, 0]), (6, [1, None, 0]), (7, [float("nan"), 1, 1]), (8, [float("inf"), 1, 1]), (9, [1, 2]), (None, a), (10, [-0.0, 0, 0])]
    df = frame(spark, rows + bad)
    got = found(nb.search(nb.build(df, k=5), df.where("vec_id % 20 = 0 and vec_id != 20"), k=5))
    assert set(got) == {0, 40, 60, 80, 100}
    assert got[0] == [(20, 1.0), (40, 1.0), (41, 1.0), (42, 1.0), (43, 1.0)]
    assert got[60][:4] == [(0, 1.0), (20, 1.0), (40, 1.0), (41, 1.0)]
    assert got[40][0] == (20, 2.0)  # the other row of id 20 stays a candidate
    both = nb.search(nb.build(df, k=5), df.where("vec_id = 20"), k=5).collect()  # one query for each vector of the id
    assert sorted((r["vec_id"], r["score"]) for r in both if r["rank"] == 1) == [(1, 1.0), (40, 2.0)]


def test_few_and_no_rows(spark):
    df = frame(spark, [(0, [1, 2]), (1, [2, 1])])
    assert found(nb.search(nb.build(df), df)) == {0: [(1, 4.0)], 1: [(0, 4.0)]}
    assert nb.search(nb.build(df.limit(1)), df.limit(1)).count() == 0
    none = df.limit(0)
    assert nb.search(nb.build(none), none).count() == nb.search(nb.build(none), df).count() == nb.search(nb.build(df), none).count() == 0


def test_clashing_columns_and_doubles(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i, i, i) for i in range(5)], "vec_id long, embedding array<double>, id long, node long, vec long")
    assert found(nb.search(nb.build(df, k=2), df.where("vec_id = 0"), k=2)) == {0: [(1, 1.0), (2, 1.0)]}
    with pytest.raises(ValueError, match="built for"):
        nb.search(nb.build(df, k=2), df, k=3)


def test_parts_are_balanced_and_follow_the_graph():
    x = np.concatenate([np.random.default_rng(i).standard_normal((100, 4)) * 0.05 + np.eye(4)[i] for i in range(4)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = nb.nearest(x, x, 10, np.arange(400))
    part = nb.balanced_parts(graph, 4)
    assert np.bincount(part).tolist() == [100] * 4
    assert (part[graph] == part[:, None]).mean() > 0.95
    sizes = np.bincount(nb.balanced_parts(graph, 7))
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 7


def test_visits():
    router = nb.Router(np.zeros((2, 1)), np.zeros(1), np.zeros((1, 3)), np.log([0.6, 0.3, 0.1]))
    logs = router.logs(np.ones((2, 2)))
    assert np.allclose(np.exp(logs), [[0.6, 0.3, 0.1]] * 2)
    row, part, first = nb.visits(logs, np.array([True, False]), np.log(0.25))
    assert list(zip(row.tolist(), part.tolist(), first.tolist())) == [(0, 0, True), (0, 1, False), (1, 0, False), (1, 1, False)]
    row, part, first = nb.visits(logs, np.array([True, False]), np.log(0.9))  # the most probable path is always followed
    assert list(zip(row.tolist(), part.tolist(), first.tolist())) == [(0, 0, True)]
