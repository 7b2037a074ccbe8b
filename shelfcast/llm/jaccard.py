"""N-gram Jaccard join with Bayesian candidate pruning.

A text's shingles are the sets of its runs of ``SHINGLE`` words (a text of
fewer words is one shingle); texts with the same shingles are one class with
its smallest id as representative.  The steps:

1. every document gets a digest of its shingle set and ``BANDS`` keys, each
   from ``ROWS`` MinHash values; digests are counted, so that copies cost one
   row per task from here on;
2. representatives that share a key are its bucket; buckets of the same
   members count once, large ones are cut into cells of about ``BUCKET``
   members a side.  In a cell the last eight bits of the MinHash values are
   compared as in step 3, without shingles, and a forest joins those whose
   pairs survive.  The connected sets of the forests are the candidate groups,
   so that texts which share a key but are unlike (a common passage) do not
   chain groups.  Eight bits match whenever the values do: nothing is dropped
   that whole values would keep.  A pair at the threshold misses all 32 keys
   with a probability of 5e-8;
3. each group is cut into cells of about ``CELL`` members and
   ``CELL_SHINGLES`` shingles a side, and every pair of members meets in exactly one cell.  There MinHash values are
   compared ``STEP`` at a time; after each step pairs are dropped whose
   posterior probability of reaching the threshold, given the matches so far
   and a uniform prior, is below ``TOLERANCE``;
4. the pairs that are left are verified by their shingle sets.  A cell returns
   the number of links of each member and a forest that joins linked members,
   never the pairs, so a group of n near copies gives rows in proportion to n
   (times its cells a side);
5. the forests' connected sets are the classes.

Only the groups' members are shuffled with their shingles.  Connected sets
are found by joins, iterated over written tables.

Words are case-sensitive runs of other than white space.  Null and empty
texts have no shingles: they have no links and are classes of their own.
Every row is a document: repeated rows are copies of each other, rows of one
id with different texts are compared like others.  A null id is never a
class's id unless all its members' ids are null.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD, by_batch, split_join, stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-9
BUCKET = 4_096
CELL = 256
CELL_SHINGLES = 2_000_000

_words = re.compile(WORD).findall


def _digest(sh: np.ndarray) -> bytes | None:
    return hashlib.md5(sh.tobytes()).digest() if len(sh) else None


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    import xxhash

    words = _words(text)
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    h = xxhash.xxh3_64_intdigest
    w = np.fromiter((known[x] if x in known else known.setdefault(x, h(x)) for x in words), np.uint64, len(words))
    k = min(SHINGLE, len(w))
    out = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + w[i : i + len(out)])
    return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


_rng = np.random.default_rng(20)
_FACTOR = (_rng.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SECOND = (_rng.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def signature(sh: np.ndarray) -> np.ndarray:
    """One MinHash value for each hash function."""
    x = sh.astype(np.uint32) ^ (sh >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):  # pieces that stay in the processor's cache
        v = x[None, at : at + 1024] * _FACTOR[:, None]
        v ^= v >> np.uint32(15)
        v *= _SECOND[:, None]
        np.minimum(out, v.min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> list[int]:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[i::ROWS].astype(np.uint64))
    return key.view(np.int64).tolist()


def least_matches(threshold: float, compared: int, tolerance: float) -> int:
    """The fewest matches among ``compared`` MinHash values at which the
    posterior probability of a similarity of ``threshold`` or more is not
    below ``tolerance``; the prior is uniform."""
    # the posterior is Beta(m + 1, n - m + 1): its upper tail is a binomial sum
    n = compared + 1
    tail, total = [], 0.0
    for m in range(compared + 1):
        total += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        tail.append(total)
    return next((m for m, p in enumerate(tail) if p >= tolerance), compared)


def candidates(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the signatures ``a`` and ``b`` that survive every step."""
    match = np.zeros((len(a), len(b)), np.int16)
    for i in range(STEP):
        match += a[:, i, None] == b[None, :, i]
    alive = match >= least[0]
    if same:
        alive = np.triu(alive, 1)
    x, y = np.nonzero(alive)
    matches = match[x, y].astype(np.int64)
    for n in range(1, BANDS * ROWS // STEP):
        if not len(x):
            break
        for i in range(n * STEP, (n + 1) * STEP):
            matches += a[x, i] == b[y, i]
        keep = matches >= least[n]
        x, y, matches = x[keep], y[keep], matches[keep]
    return x, y


def joined(low: np.ndarray, least: list[int]) -> list[tuple[int, int]]:
    """A forest over the rows of ``low`` that joins all pairs which survive
    every step: from each row found, those not yet found are compared."""
    left, out = np.arange(len(low)), []
    while len(left) > 1:
        found, left = [int(left[0])], left[1:]
        while found and len(left):
            x = found.pop()
            alive, matches = left, np.zeros(len(left), np.int64)
            for n, bound in enumerate(least):
                part = slice(n * STEP, (n + 1) * STEP)
                matches = matches + np.count_nonzero(low[alive, part] == low[x, part], axis=1)
                keep = matches >= bound
                alive, matches = alive[keep], matches[keep]
                if not len(alive):
                    break
            if len(alive):
                out += [(x, y) for y in alive.tolist()]
                found += alive.tolist()
                left = left[~np.isin(left, alive, assume_unique=True)]
    return out


def verified(x: np.ndarray, y: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold, by their shingles."""
    if not len(x):
        return np.zeros(0, bool)
    sizes = np.array([len(s) for s in left])[x] + np.array([len(s) for s in right])[y]
    if len(x) < 1_000:
        common = np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in zip(x.tolist(), y.tolist())])
    else:
        # many pairs of few texts: count common shingles by matrix products over shingles that both sides have
        a, b = np.concatenate(left), np.concatenate(right)
        row_a, row_b = (np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (left, right))
        both = np.intersect1d(a, b)
        product = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(both), 4096):
            some = both[at : at + 4096]
            m = []
            for values, rows, n in ((a, row_a, len(left)), (b, row_b, len(right))):
                place = np.minimum(np.searchsorted(some, values), len(some) - 1)
                hit = some[place] == values
                m.append(np.zeros((n, len(some)), np.float32))
                m[-1][rows[hit], place[hit]] = 1
            product += m[0] @ m[1].T
        common = product[x, y].astype(np.int64)
    # J >= t  <=>  common >= t * union, in whole numbers
    return common * 10_000 >= round(threshold * 10_000) * (sizes - common)


def forest(x: np.ndarray, y: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that join what the pairs join, fewer than ``n``."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i, j in zip(x.tolist(), y.tolist()):
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``node, root``: the smallest node of each node's connected set, by
    large-star and small-star steps over written tables."""
    edges = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), f"{name}-edges")
    while True:
        # each node's larger neighbours move to its smallest neighbour; then the others
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        # a node may have very many neighbours
        large = split_join(both.where("y > x"), least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = stored(large.where("u < v").distinct(), f"{name}-large")
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lower, "v")
        small = small.select("v", F.col("m").alias("u")).unionByName(small.select(F.col("u").alias("v"), F.col("m").alias("u")))
        after = stored(small.where("u < v").distinct(), f"{name}-small")
        # done when every node hangs on one root that hangs on nothing
        ends = after.select(F.col("v").alias("x"), F.lit(1).alias("n"), F.lit(0).alias("held")).unionByName(after.select(F.col("u").alias("x"), F.lit(0).alias("n"), F.lit(1).alias("held")))
        if ends.groupBy("x").agg(F.sum("n").alias("n"), F.max("held").alias("held")).where("n > 1 or n = 1 and held = 1").isEmpty():
            break
        edges = after
    roots = after.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("root"))
    return after.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)


def _groups(own: DataFrame, least: list[int]) -> DataFrame:
    """``node, root``: the candidate groups of representatives (``node, keys,
    low``); those without a candidate are left out."""
    keyed = own.select("node", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first"), F.max("node").alias("last"), F.bit_xor(F.xxhash64("node")).alias("all"))
    met = met.where("n > 1").groupBy("n", "first", "last", "all").agg(F.min("key").alias("key"))
    met = met.select("key", F.ceil(F.col("n") / BUCKET).cast("int").alias("sides"))
    rows = split_join(keyed, met, "key").join(own.select("node", "low"), "node")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    cells = cells.groupBy("key", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"))
    cells = cells.agg(F.collect_list(F.struct("node", "low")).alias("members")).select("members")

    def join(batch: pa.RecordBatch) -> dict[str, list]:
        members, out = batch.column("members"), []
        flat = members.flatten()
        nodes = flat.field("node").to_pylist()
        low = np.frombuffer(b"".join(flat.field("low").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        at = 0
        for n in members.value_lengths().to_pylist():
            out += [(nodes[at + x], nodes[at + y]) for x, y in joined(low[at : at + n], least)]
            at += n
        return {"a": [x for x, _ in out], "b": [y for _, y in out]}

    return connected(by_batch(cells, join, "a long, b long"), "jaccard-groups")


def similar(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, class_id, n_links, text_class``.

    ``class_id`` is the smallest id that links lead to, ``n_links`` the number
    of other documents whose similarity reaches the threshold, ``text_class``
    the smallest id of those with the same shingles.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    least = [least_matches(threshold, n, TOLERANCE) for n in range(STEP, BANDS * ROWS + 1, STEP)]

    def sketch(batch: pa.RecordBatch) -> dict[str, list]:
        sets = [shingles(t or "") for t in batch.column("text").to_pylist()]
        sigs = [signature(s) if len(s) else None for s in sets]
        return {"id": batch.column("id"), "digest": [_digest(s) for s in sets], "n": [len(s) for s in sets],
                "keys": [[] if s is None else band_keys(s) for s in sigs], "low": [None if s is None else s.astype(np.uint8).tobytes() for s in sigs]}

    sketches = stored(by_batch(rows, sketch, "id long, digest binary, n long, keys array<long>, low binary"), "jaccard-sketches")
    own = sketches.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), *(F.any_value(c).alias(c) for c in ("n", "keys", "low")))
    own = stored(own.withColumn("node", F.monotonically_increasing_id()), "jaccard-classes")
    groups = _groups(own, least)
    members = groups.join(own.drop("keys", "low"), "node")
    sides = members.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / CELL, F.sum("n") / CELL_SHINGLES)).cast("int").alias("sides"))
    members = split_join(members, sides, "root").withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int"))
    texts = rows.join(members, rows["id"].eqNullSafe(members["rep"]))

    def describe(batch: pa.RecordBatch) -> dict[str, list]:
        sets = [shingles(t or "") for t in batch.column("text").to_pylist()]
        # rows of one id may differ; those with another text are not the representative's
        own = [d == _digest(s) for d, s in zip(batch.column("digest").to_pylist(), sets)]
        batch, sets = batch.filter(pa.array(own, pa.bool_())), [s for s, o in zip(sets, own) if o]
        return {c: batch.column(c) for c in ("node", "root", "side", "sides", "copies")} | {"sig": [signature(s).tobytes() for s in sets], "shingles": [s.tobytes() for s in sets]}

    described = by_batch(texts.select("node", "root", "side", "sides", "copies", "digest", "text"), describe, "node long, root long, side int, sides int, copies long, sig binary, shingles binary")
    cells = described.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).select(
        "root", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "side", "node", "copies", "sig", "shingles")

    def compare(cell: pa.Table) -> pa.Table:
        a, b = cell.column("a")[0].as_py(), cell.column("b")[0].as_py()
        # repeated rows of a representative are one
        rows = list({r["node"]: r for r in cell.select(["side", "node", "copies", "sig", "shingles"]).to_pylist()}.values())
        one = sorted((r for r in rows if r["side"] == a), key=lambda r: r["node"])
        two = one if a == b else sorted((r for r in rows if r["side"] == b), key=lambda r: r["node"])
        sets = [[np.frombuffer(r["shingles"], np.uint64) for r in part] for part in (one, two)]
        sigs = [np.array([np.frombuffer(r["sig"], np.uint32) for r in part]).reshape(len(part), BANDS * ROWS) for part in (one, two)]
        x, y = candidates(*sigs, a == b, least)
        good = verified(x, y, *sets, threshold)
        x, y = x[good], y[good]
        shift = 0 if a == b else len(one)
        every = one if a == b else one + two
        copies = np.array([r["copies"] for r in every], np.int64)
        links = np.zeros(len(every), np.int64)
        np.add.at(links, x, copies[y + shift])
        np.add.at(links, y + shift, copies[x])
        tree = forest(x, y + shift, len(every))
        counted = [(r["node"], None, int(n)) for r, n in zip(every, links) if n]
        out = counted + [(every[i]["node"], every[j]["node"], 0) for i, j in tree]
        return pa.table({"node": pa.array([r[0] for r in out], pa.int64()), "linked": pa.array([r[1] for r in out], pa.int64()), "links": pa.array([r[2] for r in out], pa.int64())})

    found = stored(cells.groupBy("root", "a", "b").applyInArrow(compare, "node long, linked long, links long"), "jaccard-links")
    links = found.where("linked is null").groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected(found.where("linked is not null").select(F.col("node").alias("a"), F.col("linked").alias("b")), "jaccard-linked")
    told = own.drop("keys", "low").join(links, "node", "left").join(classes, "node", "left")
    told = stored(told.select("digest", F.col("rep").alias("text_class"), F.coalesce("root", "node").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "jaccard-told")
    least_id = told.groupBy("root").agg(F.min("text_class").alias("class_id"))
    told = split_join(told, least_id, "root").select("digest", "text_class", "class_id", "n_links")
    out = sketches.select("id", "digest").join(told, "digest", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("text_class", "id").alias("text_class"))
