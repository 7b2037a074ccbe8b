"""Quality rules scored by an isolation forest.

Every whole text yields rule statistics: counts of words, symbols, lines that
repeat, words in repeated 8-word windows, words equal to the one before,
capitals; from them a row of ratios.  Two fixed rules reject outright; for
the rest the forest decides: trees of random splits over the statistics
isolate unusual documents after few splits, so short mean path lengths mark
anomalies.

The forest is fitted on a bounded sample of labelled rows, ``SAMPLE`` at most
(those with the smallest hash of their id, so that the sample does not depend
on partitions): the trees on the good ones, the threshold on both, as the
score with the best balanced accuracy among those that keep at least
``KEEP_GOOD`` of the good rows.  Statistics, score and decision are computed
for every row alike.

A null or empty text has no words and fails the fixed rules.  Rows are
independent, so repeated rows and ids give repeated rows; an empty table gives
an empty one; other columns of the input are ignored.  Labels that are null,
that contradict each other or that belong to no document are left out; without
good labelled rows the forest judges nothing and the fixed rules alone decide.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import SPACE, WORD, by_batch

SAMPLE = 4_096
KEEP_GOOD = 0.995
TREES = 128
SUBSAMPLE = 256
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_stutter", "n_lines", "n_other")


def _repeat_words(words: list[str], hashes: np.ndarray) -> int:
    """Words that lie in a window of eight words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    # equal windows have equal sums, so different sums everywhere settle it
    sums = np.zeros(n, np.int64)
    for i in range(WINDOW):
        sums = sums * np.int64(0x5851F42D4C957F2D) + hashes[i : i + n]
    sums.sort()
    if not (sums[1:] == sums[:-1]).any():
        return 0
    number: dict[str, int] = {}
    rank = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # windows of one, two, four, eight words: pairs of equal ranks are equal windows
    for width in (1, 2, 4):
        _, rank = np.unique(rank[:-width] * (rank.max() + 1) + rank[width:], return_inverse=True)
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


_words = re.compile(WORD).findall
#: Classes of the first code points; all later ones are in the last class.
_SPACE, _SYMBOL, _UPPER, _LOWER, _DIGIT, _OTHER, _LATER = range(1, 8)


def _classes() -> np.ndarray:
    table = np.zeros(0x251, np.uint8)
    for code in range(0x250):
        c = chr(code)
        table[code] = (_SPACE if c in SPACE else _LATER if c.isspace() else _SYMBOL if c in SYMBOLS else _UPPER if c.isupper()
                       else _LOWER if c.isalpha() else _DIGIT if c.isdigit() else 0 if c in ".,_" else _OTHER)
    table[0x250] = _LATER
    return table


CLASSES = _classes()


def statistics(text: str) -> tuple[int, ...]:
    """The values named in ``STATISTICS``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    count = np.bincount(CLASSES[np.minimum(codes, 0x250)], minlength=8).tolist()
    # split() knows more kinds of white space than the rules do
    words = _words(text) if count[_LATER] else text.split()
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    other = count[_OTHER] + count[_SYMBOL]
    return (len(words), len(text) - count[_SPACE], count[_SYMBOL], len(lines) - len(set(lines)), _repeat_words(words, hashes),
            count[_UPPER], count[_UPPER] + count[_LOWER], int(np.count_nonzero(hashes[1:] == hashes[:-1])), len(lines), other)


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios from rows of statistics."""
    n, chars, symbols, dup, repeat, upper, letters, stutter, lines, other = stats.T.astype(float)
    some = lambda x: np.maximum(x, 1)
    return np.stack([symbols / some(n), dup / some(lines), repeat / some(n), upper / some(letters),
                     stutter / some(n), other / some(n), np.log1p(chars / some(n))], axis=1)


class Forest:
    """Isolation trees as arrays, and the threshold of the score."""

    def __init__(self, good: np.ndarray, rng: np.random.Generator):
        self.size = min(SUBSAMPLE, len(good))
        self.depth = int(np.ceil(np.log2(max(self.size, 2)))) + 4
        self.trees = [self._tree(good[rng.choice(len(good), self.size, replace=False)], rng) for _ in range(TREES)]
        self.threshold = np.inf

    def _tree(self, rows: np.ndarray, rng: np.random.Generator):
        feature, cut, left, right, path = [], [], [], [], []

        def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(feature)
            for column in (feature, cut, left, right, path):
                column.append(0)
            path[at] = depth + _mean_path(len(x))
            feature[at] = -1
            if len(x) > 1 and depth < self.depth:
                f = int(rng.integers(x.shape[1]))
                # the range reaches beyond the rows, so that splits also part the unseen from the seen
                c = rng.uniform(low[f], high[f])
                on = x[:, f] < c
                feature[at], cut[at] = f, c
                below, above = high.copy(), low.copy()
                below[f] = above[f] = c
                left[at] = grow(x[on], low, below, depth + 1)
                right[at] = grow(x[~on], above, high, depth + 1)
            return at

        spread = np.maximum(rows.max(0) - rows.min(0), 0.02)
        grow(rows, rows.min(0) - spread / 2, rows.max(0) + spread / 2, 0)
        return [np.array(x) for x in (feature, cut, left, right, path)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over its expectation: near 1
        for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[rows, np.maximum(f, 0)] < cut[at], left[at], right[at]))
            total += path[at]
        return np.exp2(-total / len(self.trees) / max(_mean_path(self.size), 1e-9))

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.score(x) <= self.threshold


def _mean_path(n: int) -> float:
    """Expected path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def fit(stats: np.ndarray, good: np.ndarray, seed: int = 7) -> Forest | None:
    """The forest of labelled rows, or None if there are too few good ones."""
    if good.sum() < 2:
        return None
    x, rng = features(stats), np.random.default_rng(seed)
    ours = np.flatnonzero(good)
    held = rng.permutation(ours)
    # the threshold is set on good rows that the trees have not seen, where there are enough
    seen, calibrate = (held[len(held) // 3 :], held[: len(held) // 3]) if len(held) >= 60 else (held, held)
    forest = Forest(x[seen], rng)
    fine, bad = np.sort(forest.score(x[calibrate])), forest.score(x[~good])
    least = fine[min(len(fine) - 1, int(np.ceil(KEEP_GOOD * len(fine))) - 1)]
    cuts = np.unique(np.concatenate([fine, [least]]))
    cuts = cuts[cuts >= least]
    # between a score that good rows have and the next bad one, take the middle
    value = [(np.mean(fine <= c) + (np.mean(bad > c) if len(bad) else 0), -i) for i, c in enumerate(cuts)]
    best = cuts[-max(value)[1]]
    above = bad[bad > best]
    forest.threshold = (best + above.min()) / 2 if len(above) else best
    return forest


def _stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def count(batch: pa.RecordBatch) -> dict[str, list]:
        rows = [statistics(t) for t in batch.column("text").to_pylist()]
        return {"id": batch.column("id")} | {s: [r[i] for r in rows] for i, s in enumerate(STATISTICS)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return by_batch(rows, count, "id long, " + ", ".join(f"{s} long" for s in STATISTICS))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Forest | None:
    """A forest from at most ``sample`` labelled documents (``quality`` 0/1)."""
    known = labels.select(F.col(id_col).alias("_id"), "quality").where("quality in (0, 1) and _id is not null")
    # one quality for each id; rows with the smallest hashes of their ids are the sample
    known = known.groupBy("_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_max")).where("quality = _max")
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample).collect()
    if not chosen:
        return None
    quality = {r["_id"]: r["quality"] for r in chosen}
    few = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in quality], "_id long"))  # at most ``sample`` ids
    texts = docs.join(few, F.col(id_col) == F.col("_id"), "left_semi")
    rows = _stats(texts, id_col, text_col).orderBy("id", *STATISTICS).limit(2 * sample).collect()
    if not rows:
        return None
    stats = np.array([[r[s] for s in STATISTICS] for r in rows])
    return fit(stats, np.array([quality[r["id"]] == 1 for r in rows]))


def judge(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base statistics, ``base_failed`` and ``kept`` of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(forest)  # TREES trees over SUBSAMPLE rows

    def decide(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").to_pylist()
        stats = np.array([statistics(t) for t in texts], np.int64).reshape(len(texts), len(STATISTICS))
        n, repeat = stats[:, 0], stats[:, 4]
        failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
        kept = ~failed
        if shared.value is not None:
            kept &= shared.value.keeps(features(stats))
        return {"id": batch.column("id"), "base_failed": failed, "kept": kept} | {s: stats[:, i] for i, s in enumerate(STATISTICS[:5])}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id long, " + ", ".join(f"{s} long" for s in STATISTICS[:5]) + ", base_failed boolean, kept boolean"
    return by_batch(rows, decide, schema).withColumnRenamed("id", id_col)


def good_rows(docs: DataFrame, forest: Forest | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def keep(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            stats = np.array([statistics(t) for t in texts], np.int64).reshape(len(texts), len(STATISTICS))
            n, repeat = stats[:, 0], stats[:, 4]
            kept = (n >= MIN_WORDS) & (100 * repeat <= MAX_REPEAT_PERCENT * n)
            if shared.value is not None:
                kept &= shared.value.keeps(features(stats))
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
