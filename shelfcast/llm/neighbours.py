"""Approximate nearest neighbours by learned partitions.

Nearness is the inner product.  With M the largest norm, a candidate x becomes
(x / M, sqrt(1 - |x|^2 / M^2)) and a query q becomes (q / |q|, 0): all have
length 1 and keep the order of the inner products.

A node of the partition tree is split by what a bounded sample of its vectors
(``SAMPLE``, by the hash of the vector) teaches:

1. the exact neighbour graph of the sample is cut into equal parts, by
   bisection along its slowest mode and exchanges of vectors between the halves
   that cut fewer edges;
2. a small classifier (one hidden layer) learns from a vector to tell in which
   parts its neighbours lie.

The classifier then deals *every* vector of the node to its most probable
part.  The number of levels follows from the number of vectors, so that a leaf
has about ``LEAF`` of them; all nodes of a level are fitted in parallel, and
every vector is indexed.

The probability of a leaf is the product along its path.  A query goes to the
leaves of at least a certain probability (and to its most probable one) and is
compared in double precision with all their vectors.  That probability is
measured, not set: ``TRIALS`` of the indexed vectors are searched exactly, in one
pass over all vectors, and all but ``1 - RECALL`` of their neighbours must lie
in leaves that probable.  Vectors without structure need many leaves, which
this finds by itself; nothing is capped, and no query visits more leaves than
one over the probability.

Copies: equal vectors are one entry with the ``k + 1`` smallest of their ids
(more cannot be among ``k`` neighbours), limited in every task before the
shuffle.  Equal queries are searched once.  Nodes and leaves are worked on in
cells of bounded numbers of vectors and queries, so a crowded leaf is many
tasks.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id.  Equal rows (id
and vector) are one; rows of one id with different vectors are candidates and
queries of their own.  Empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from shelfcast.llm.common import by_batch, stored

SAMPLE = 4_096  # vectors that a node is fitted on
LEAF = 1_024  # vectors that a leaf is to have
BRANCH = 32  # parts that a node has at most
CELL = 4_096  # vectors, and queries, that one task compares at once
RECALL = 0.95
TRIALS = 256  # vectors that are searched exactly to measure what is to be visited
GRAPH = 10  # neighbours in the graph
NEAR = 20  # neighbours that are to be found again
HIDDEN = 64
EPOCHS = 25


# --- fitting one node, in numpy ------------------------------------------------


def nearest(queries: np.ndarray, vectors: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
    """Rows of the ``k`` nearest vectors of each query, best first; ``skip``
    is the row that each query is itself."""
    out = []
    for at in range(0, len(queries), 1024):
        near = queries[at : at + 1024] @ vectors.T
        if skip is not None:
            near[np.arange(len(near)), skip[at : at + 1024]] = -np.inf
        some = np.argpartition(-near, min(k, near.shape[1] - 1), axis=1)[:, :k]
        best = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
        out.append(np.take_along_axis(some, best, 1))
    return np.concatenate(out)


def nearest_scored(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and inner product of the ``k`` largest products of each
    query, and of all that may tie with the last of them."""
    rows, columns, k = [], [], min(k, len(vectors))
    largest = np.abs(vectors).max() * vectors.shape[1]
    for at in range(0, len(queries), 512):
        some = queries[at : at + 512]
        near = some @ vectors.T
        last = np.partition(near, -k, axis=1)[:, -k] - 1e-13 * largest * np.abs(some).max(axis=1)
        row, column = np.nonzero(near >= last[:, None])
        rows.append(row + at)
        columns.append(column)
    row, column = np.concatenate(rows), np.concatenate(columns)
    # the product itself, in the same order of sums for every pair
    return row, column, np.concatenate([np.einsum("ij,ij->i", queries[row[i : i + 65536]], vectors[column[i : i + 65536]]) for i in range(0, len(row), 65536)])


def _places(sorted_keys: np.ndarray) -> np.ndarray:
    """The place of each element among the equal ones."""
    first = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    return np.arange(len(sorted_keys)) - np.repeat(first, np.diff(first, append=len(sorted_keys)))


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """The part of every row of the neighbour graph; sizes differ by rounding only."""
    out = np.zeros(len(graph), np.int64)

    def split(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1 or len(rows) < 2:
            out[rows] = first
            return
        here = np.full(len(graph), -1)
        here[rows] = np.arange(len(rows))
        to = here[graph[rows]]
        x, y = np.nonzero(to >= 0)
        y = to[x, y]
        left = _bisect(x, y, len(rows), len(rows) * (n // 2) // n)
        split(rows[left], first, n // 2)
        split(rows[~left], first + n // 2, n - n // 2)

    split(np.arange(len(graph)), 0, parts)
    return out


def _bisect(x: np.ndarray, y: np.ndarray, n: int, size: int) -> np.ndarray:
    """A half of ``size`` rows that few of the edges ``x - y`` leave."""
    x, y = np.concatenate([x, y]), np.concatenate([y, x])
    root = np.sqrt(np.bincount(x, minlength=n) + 1e-9)
    mode = np.random.default_rng(5).standard_normal(n)
    for _ in range(60):
        mode -= root * (mode @ root) / (root @ root)
        mode = 0.5 * mode + 0.5 * np.bincount(x, (mode / root)[y], n) / root
        mode /= np.linalg.norm(mode) + 1e-300
    left = np.zeros(n, bool)
    left[np.argsort(mode / root, kind="stable")[:size]] = True
    for _ in range(20):  # exchange the rows that gain most, pair by pair
        gain = np.bincount(x, left[x] != left[y], n) - np.bincount(x, left[x] == left[y], n)
        here, there = np.flatnonzero(left), np.flatnonzero(~left)
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        m = min(len(here), len(there))
        swap = int((gain[here[:m]] + gain[there[:m]] > 0).sum())
        swap = (swap + 1) // 2  # neighbours that change sides together gain less than each by itself
        if not swap:
            break
        before = int((left[x] != left[y]).sum())
        left[here[:swap]], left[there[:swap]] = False, True
        if int((left[x] != left[y]).sum()) >= before:
            left[here[:swap]], left[there[:swap]] = True, False
            break
    return left


@dataclass
class Router:
    """The classifier of a node."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logs(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the parts' probabilities."""
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def visits(logs: np.ndarray, first: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and parts to visit, and which of them are on the row's most
    probable path, as those in ``first`` are up to here."""
    best = first[:, None] & (np.arange(logs.shape[1]) == logs.argmax(axis=1)[:, None])
    row, part = np.nonzero((logs >= least) | best)
    return row, part, best[row, part]


def train_router(inputs: np.ndarray, wanted: np.ndarray, parts: int) -> Router:
    """Softmax of one hidden layer, by Adam on the cross entropy."""
    rng = np.random.default_rng(11)
    hidden = max(HIDDEN, 2 * parts)
    w = [rng.standard_normal((inputs.shape[1], hidden)) * math.sqrt(2 / inputs.shape[1]), np.zeros(hidden),
         rng.standard_normal((hidden, parts)) * math.sqrt(1 / hidden), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), 256):
            x, y = inputs[order[at : at + 256]], wanted[order[at : at + 256]]
            h = np.maximum(x @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(x)
            dh = (dz @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.004 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*w)


def fit_node(candidates: np.ndarray, queries: np.ndarray, parts: int) -> Router:
    """A router for a node from its sample: each row both as candidate and as query."""
    n = len(candidates)
    if parts < 2 or n < 4 * parts:
        return Router(np.zeros((candidates.shape[1], 1)), np.zeros(1), np.zeros((1, parts)), -40.0 * np.arange(parts))
    part = balanced_parts(nearest(candidates, candidates, min(GRAPH, n - 1), np.arange(n)), parts)
    near = nearest(queries, candidates, min(NEAR, n - 1), np.arange(n))
    wanted = np.stack([(part[near] == c).mean(axis=1) for c in range(parts)], axis=1)
    # a candidate is to lie where its graph part is, a query to go where its neighbours are
    own = 0.5 * np.eye(parts)[part] + 0.5 * wanted
    return train_router(np.concatenate([candidates, queries]), np.concatenate([own, wanted]), parts)


# --- the tree, in Spark ----------------------------------------------------------


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec, norm``: rows that take part, each once; ``vec`` is the
    components as little-endian floats or doubles, as the table has them."""
    single = isinstance(df.schema[vec_col].dataType, ArrayType) and isinstance(df.schema[vec_col].dataType.elementType, FloatType)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.expr("id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)"))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    n = length["n"] if length else 0

    def pack(batch: pa.RecordBatch) -> dict[str, list]:
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) + 0.0  # -0.0 is 0.0
        mark = b"f" if single else b"d"
        return {"id": batch.column("id"), "vec": [mark + x.tobytes() for x in v.astype("<f4" if single else "<f8")], "norm": np.sqrt((v * v).sum(axis=1))}

    packed = by_batch(rows.where(F.size("v") == n), pack, "id long, vec binary, norm double")
    return packed.groupBy("id", "vec").agg(F.max("norm").alias("norm"))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """``node, vec, norm, ids``: each vector once, with its ``ids`` smallest ids."""
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= ids)
    return few.groupBy("vec").agg(F.max("norm").alias("norm"), F.array_sort(F.collect_list("id")).alias("ids")).withColumn("entry", F.monotonically_increasing_id())


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of a column, in double precision."""
    raw = column.to_pylist()
    if not raw:
        return np.zeros((0, 0))
    data = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)[:, 1:].tobytes()
    return np.frombuffer(data, "<f4" if raw[0][:1] == b"f" else "<f8").reshape(len(raw), -1).astype(np.float64)


def _candidates(v: np.ndarray, largest: float) -> np.ndarray:
    x = v / largest
    return np.concatenate([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))[:, None]], axis=1)


def _queries(v: np.ndarray) -> np.ndarray:
    scale = np.abs(v).max(axis=1, keepdims=True)
    v = v / scale
    return np.concatenate([v / np.sqrt((v * v).sum(axis=1))[:, None], np.zeros((len(v), 1))], axis=1)


@dataclass
class Index:
    """``members`` (``entry, vec, ids, node``), the routers of each level
    (``node, router``) and the logarithm of the probability to visit."""

    members: DataFrame
    levels: list[DataFrame]
    parts: int
    ids: int
    least: float = 0.0


def _in_cells(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``cell``, ``cells``: each node's rows in cells of about ``CELL``."""
    size = rows.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    # joined by an expression, so that both sides are shuffled for this join and a large node can be split
    on = F.col("node").cast("decimal(20,0)").alias("_on")
    rows = rows.select("*", on).join(size.select(on, "cells"), "_on").drop("_on")
    return rows.withColumn("cell", F.pmod(F.xxhash64(key), F.col("cells")).cast("int"))


def _routed(rows: DataFrame, level: DataFrame, key: str, route, schema: str) -> DataFrame:
    """``route(rows of a cell, router of their node)`` for all cells."""
    rows = _in_cells(rows, key)
    routers = level.join(rows.select("node", "cells").distinct(), "node").select("node", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), "router")

    def run(some: pa.Table, router: pa.Table) -> pa.Table:
        return route(some, pickle.loads(router.column("router")[0].as_py()))

    return rows.groupBy("node", "cell").cogroup(routers.groupBy("node", "cell")).applyInArrow(run, schema)


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, leaf: int = LEAF, branch: int = BRANCH,
          sample: int = SAMPLE, recall: float = RECALL) -> Index:
    """Index of every vector that takes part, for searches of ``k`` neighbours."""
    entries = distinct_vectors(valid_vectors(vectors, id_col, vec_col), k + 1).withColumn("node", F.lit(0).cast("long"))
    entries = stored(entries, "neighbours-entries")
    n, largest = entries.agg(F.count(F.lit(1)), F.max("norm")).first()
    leaves = max(1, math.ceil(n / leaf))
    depth = math.ceil(math.log(leaves) / math.log(branch) - 1e-9)
    parts = math.ceil(leaves ** (1 / depth) - 1e-9) if depth else 1
    members = entries.select("entry", "vec", "ids", "node")
    index = Index(members, [], parts, k + 1)

    def fit(some: pa.Table) -> pa.Table:
        v = _matrix(some.sort_by("entry").column("vec"))
        return pa.table({"node": some.column("node").slice(0, 1), "router": pa.array([pickle.dumps(fit_node(_candidates(v, largest), _queries(v), parts))], pa.binary())})

    def deal(some: pa.Table, router: Router) -> pa.Table:
        part = router.logs(_candidates(_matrix(some.column("vec")), largest)).argmax(axis=1)
        node = some.column("node").to_numpy() * parts + part
        return pa.table({"entry": some.column("entry"), "vec": some.column("vec"), "ids": some.column("ids"), "node": pa.array(node, pa.int64())})

    for level in range(depth):
        # somewhat more than the sample of each node by the hash, then exactly as many at most
        share = members.groupBy("node").agg((F.lit(1.2 * sample) / F.count(F.lit(1))).alias("share"))
        few = members.select("node", "entry", "vec", F.xxhash64("vec").alias("hash")).join(share, "node")
        few = few.where(F.pmod("hash", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        order = Window.partitionBy("node").orderBy("hash", "entry")
        few = few.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample).select("node", "entry", "vec")
        index.levels.append(stored(few.groupBy("node").applyInArrow(fit, "node long, router binary"), f"neighbours-level{level}"))
        members = stored(_routed(members, index.levels[-1], "entry", deal, "entry long, vec binary, ids array<long>, node long"), f"neighbours-members{level}")
    index.members = members
    if depth:
        index.least = _least(index, entries, k, recall)
    return index


def _least(index: Index, entries: DataFrame, k: int, recall: float) -> float:
    """The logarithm of the probability of leaves that hold ``recall`` of the
    true neighbours of some indexed vectors."""
    trials = entries.orderBy(F.xxhash64("vec", F.lit(7)), "entry").select("entry", "vec").limit(TRIALS).collect()
    numbers, asked = np.array([r["entry"] for r in trials]), _matrix(pa.array([bytes(r["vec"]) for r in trials], pa.binary()))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, node = np.full((len(asked), 0), 0.0), np.full((len(asked), 0), 0)
        for batch in batches:
            near = asked @ _matrix(batch.column("vec")).T if batch.num_rows else np.zeros((len(asked), 0))
            near[numbers[:, None] == batch.column("entry").to_numpy()[None, :]] = -np.inf
            score, node = np.concatenate([score, near], axis=1), np.concatenate([node, np.broadcast_to(batch.column("node").to_numpy(), near.shape)], axis=1)
            if score.shape[1] > k:
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, node = np.take_along_axis(score, top, 1), np.take_along_axis(node, top, 1)
        row, _ = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_pydict({"q": pa.array(row, pa.int64()), "score": pa.array(score[score > -np.inf]), "leaf": pa.array(node[score > -np.inf], pa.int64())})

    # k rows for each trial and task
    near = index.members.select("entry", "vec", "node").mapInArrow(best, "q long, score double, leaf long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    near = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).groupBy("q", "leaf").agg(F.count(F.lit(1)).alias("n"))
    near = stored(near, "neighbours-trials").withColumn("logp", F.lit(0.0))
    depth, parts = len(index.levels), index.parts

    def along(some: pa.Table, router: Router) -> pa.Table:
        logs = router.logs(_queries(asked[some.column("q").to_numpy()]))
        part = some.column("leaf").to_numpy() // parts ** (depth - 1 - some.column("level")[0].as_py()) % parts
        logp = some.column("logp").to_numpy() + logs[np.arange(len(part)), part]
        return some.select(["q", "leaf", "n"]).append_column("logp", pa.array(logp))

    for level, routers in enumerate(index.levels):
        rows = near.withColumn("node", F.expr(f"leaf div {parts ** (depth - level)}")).withColumn("level", F.lit(level))
        near = stored(_routed(rows, routers, "q", along, "q long, leaf long, n long, logp double"), f"neighbours-along{level}")
    found = np.array([(r["logp"], r["n"]) for r in near.select("logp", "n").collect()]).reshape(-1, 2)  # at most k a trial
    found = found[np.argsort(-found[:, 0])]
    share = np.cumsum(found[:, 1]) / max(1.0, found[:, 1].sum())
    return float(found[min(int(np.searchsorted(share, recall)), len(found) - 1), 0]) if len(found) else -np.inf


def search(index: Index, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest entries found for
    every query but, if the index holds it, the query's own."""
    if k >= index.ids:
        raise ValueError(f"the index is built for {index.ids - 1} neighbours")
    parts, ids = index.parts, index.ids
    rows = stored(valid_vectors(queries, id_col, vec_col), "neighbours-queries")
    asked = stored(rows.groupBy("vec").agg(F.lit(0).cast("long").alias("node")).withColumn("q", F.monotonically_increasing_id()), "neighbours-asked")

    least = index.least - 1e-9

    def send(some: pa.Table, router: Router) -> pa.Table:
        logs = some.column("logp").to_numpy()[:, None] + router.logs(_queries(_matrix(some.column("vec"))))
        row, part, first = visits(logs, some.column("first").to_numpy(zero_copy_only=False), least)
        taken = some.select(["q", "vec"]).take(pa.array(row))
        node = some.column("node").to_numpy()[row] * parts + part
        return taken.append_column("node", pa.array(node, pa.int64())).append_column("logp", pa.array(logs[row, part])).append_column("first", pa.array(first))

    at = asked.withColumn("logp", F.lit(0.0)).withColumn("first", F.lit(True))
    for level in index.levels:
        at = _routed(at.select("q", "vec", "node", "logp", "first"), level, "q", send, "q long, vec binary, node long, logp double, first boolean")
    at = stored(at.select("q", "vec", "node"), "neighbours-visits")
    # a leaf's vectors and queries meet in cells of both
    there, here = _in_cells(index.members, "entry"), _in_cells(at, "q")
    n_here, n_there = (x.groupBy("node").agg(F.max("cells").alias("other")) for x in (here, there))
    on = F.col("node").cast("decimal(20,0)").alias("_on")
    there = there.select("*", on).join(n_here.select(on, "other"), "_on").withColumn("q_cell", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    here = here.select("*", on).join(n_there.select(on, "other"), "_on").withColumn("v_cell", F.explode(F.sequence(F.lit(0), F.col("other") - 1)))
    there = there.select("node", F.col("cell").alias("v_cell"), "q_cell", "vec", "ids")
    here = here.select("node", "v_cell", F.col("cell").alias("q_cell"), "q", "vec")

    def compare(some: pa.Table, members: pa.Table) -> pa.Table:
        """The best of a cell's vectors for each of its queries, best first."""
        found: list[list[dict]] = [[] for _ in range(some.num_rows)]
        if some.num_rows and members.num_rows:
            q, v = _matrix(some.column("vec")), _matrix(members.column("vec"))
            row, entry, score = nearest_scored(q, v, ids)
            q_raw, v_raw = np.array(some.column("vec").to_pylist(), object), np.array(members.column("vec").to_pylist(), object)
            same = q_raw[row] == v_raw[entry]
            # entries become their ids
            held = members.column("ids").to_pylist()
            n = np.array([len(h) for h in held])
            every = np.concatenate([np.array(held[e], np.int64) for e in entry])
            row, score, same = (np.repeat(x, n[entry]) for x in (row, score, same))
            order = np.lexsort((every, -score, row))
            order = order[_places(row[order]) < ids]
            for r, e, s, o in zip(row[order].tolist(), every[order].tolist(), score[order].tolist(), same[order].tolist()):
                found[r].append({"less": -s, "vec_id": e, "same": bool(o)})
        return pa.table({"q": some.column("q"), "best": pa.array(found, pa.list_(pa.struct([("less", pa.float64()), ("vec_id", pa.int64()), ("same", pa.bool_())])))})

    cell = ["node", "v_cell", "q_cell"]
    best = here.groupBy(*cell).cogroup(there.groupBy(*cell)).applyInArrow(compare, "q long, best array<struct<less:double,vec_id:long,same:boolean>>")
    # a query has as many lists as it visits cells
    lists = best.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, ids).alias("found"))
    told = asked.select("q", "vec").join(lists, "q").select("vec", "found")
    other = F.filter("found", lambda f: ~(f["same"] & (f["vec_id"] == F.col("id"))))
    out = rows.select("id", "vec").join(told, "vec").select(F.col("id").alias("query_id"), F.posexplode(F.slice(other, 1, k)))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", (-F.col("col.less")).alias("score"))
