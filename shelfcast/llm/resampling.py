"""Target-distribution importance resampling over hashed n-grams.

A text is lower-cased (A-Z only) and every run of separators (ASCII characters
that are neither digits nor letters) becomes one space.  One ``regex`` scan
with overlapping matches, held to word starts and ends by lookarounds, then
yields the span of the longest run of at most ``n`` words from every word on;
between single spaces the shorter runs end where the next spans start.  The
CRCs of all spans of a batch advance together, byte by byte, in vectors; that
of a run continues the shorter run's, so no n-gram string is ever made.  All
this works on UTF-8 bytes: separators are ASCII, so bytes and characters agree.

The scan runs once.  Its buckets are stored in the shared folder (two or four
bytes a feature); counts per bucket, of the documents and of the target texts,
are summed in the tasks, then by a shuffle of at most ``buckets`` rows a batch.
The gains are one vector of ``buckets`` integers, whatever the input's size;
weights are their floored means.  Adding Gumbel noise that depends on the id
alone turns "draw without replacement by weight" into "take the highest".

Ranks need no global sort: scores are integers in a range that the logarithms
of the totals bound, so rows per score are counted, summed from above over the
distinct scores, and only rows of one score are ordered among themselves.

A null or empty text has no words and no features: weight 0, not drawn.  A row
without an id has no noise: null score, not drawn.  Rows with the same id have
the same noise and are drawn one by one, equal rows in any order.  An empty
table of targets gives the gains of T = 0.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, slices, stored

SCORE_GROUP = 1_000  # distinct scores are summed in groups of so many
LONG = 48  # bytes of a span beyond which its CRC is taken alone, not beside others

#: Every byte that separates words becomes a space; A-Z are lower-cased first.
FLAT = bytes(32 if b < 48 or 58 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def crc_of_spans(data: bytes, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of every ``data[start:end]``, each continuing the CRC ``before``.

    All spans advance by one byte a step; spans are sorted by length, so those
    that still go on are always a prefix.
    """
    raw, table, out = np.frombuffer(data, np.uint8), _crc_table(), np.empty(len(start), np.uint32)
    size = np.minimum(end - start, LONG + 1).astype(np.int16)
    order = np.argsort(-size, kind="stable")
    long = int((size > LONG).sum())
    for i in order[:long]:
        out[i] = zlib.crc32(data[start[i] : end[i]], int(before[i]))
    order = order[long:]
    at, state = start[order], ~before[order]
    going = len(order) - np.cumsum(np.bincount(size[order], minlength=1))  # spans longer than p, for every p
    for k in going[:-1].tolist():
        now = state[:k]
        state[:k] = table[(now ^ raw[at[:k]]) & 0xFF] ^ (now >> 8)
        at[:k] += 1
    out[order] = ~state
    return out


class Scanner:
    """Hash buckets of all runs of 1 to ``n`` words of texts."""

    def __init__(self, n: int, buckets: int):
        import regex

        # the longest run of at most n words behind a space; the lookaround keeps it to whole words
        run = rf" [^ ]++(?: [^ ]++){{0,{n - 1}}}+(?![^ ])"
        self.finditer = regex.compile(run.encode()).finditer
        self.n, self.buckets = n, buckets
        self.type = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def scan(self, texts: list[str | None]) -> list[tuple[int, np.ndarray]]:
        """The number of words and the bucket of every feature of each text,
        runs of one word first, then those of two and so on."""
        flat = [b" ".join([b"", *t.encode().lower().translate(FLAT).split()]) if t else b"" for t in texts]
        spans = [[m.span() for m in self.finditer(data, overlapped=True, concurrent=False)] for data in flat]
        words = [len(s) for s in spans]
        base = np.repeat(np.cumsum([0, *map(len, flat)])[:-1], words)
        at = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(base)).reshape(-1, 2) + base[:, None]
        start, longest = at[:, 0] + 1, at[:, 1]
        left = np.repeat(np.cumsum(words), words) - np.arange(len(base))  # words from this one to the text's last
        text_of = np.repeat(np.arange(len(texts)), words)
        crc, data = np.zeros(len(text_of), np.uint32), b"".join(flat)
        found, owner = [], []
        begin = start
        for i in range(1, self.n + 1):
            there = np.flatnonzero(left >= i)
            # a run that the next word prolongs ends one space before that word's successor
            end = longest[there] if i == self.n else np.where(left[there] > i, start[np.minimum(there + i, len(start) - 1)] - 1, longest[there])
            crc[there] = crc_of_spans(data, begin[there], end, crc[there])
            begin = begin.copy()
            begin[there] = end
            found.append((crc[there] % self.buckets).astype(self.type))
            owner.append(text_of[there])
        order = np.argsort(np.concatenate(owner), kind="stable")
        owner, found = np.concatenate(owner)[order], np.concatenate(found)[order]
        cut = np.searchsorted(owner, np.arange(1, len(texts)))
        return list(zip(words, np.split(found, cut)))


def features(docs: DataFrame, id_col: str, text_col: str, n: int, buckets: int) -> DataFrame:
    """``id, n_words, found`` of every row: its buckets as little-endian integers."""
    own: list[Scanner] = []

    def scan(batch: pa.RecordBatch) -> dict[str, list]:
        if not own:
            own.append(Scanner(n, buckets))
        done = [row for part in slices(batch) for row in own[0].scan(part.column("text").to_pylist())]
        return {"id": batch.column("id"), "n_words": [w for w, _ in done], "found": [f.tobytes() for _, f in done]}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return by_batch(rows, scan, "id long, n_words long, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows."""
    width = Scanner(1, buckets).type

    def count(batch: pa.RecordBatch) -> dict[str, list]:
        n = np.bincount(np.frombuffer(b"".join(x.as_py() for x in batch.column("found")), width), minlength=buckets)
        at = np.flatnonzero(n)
        return {"bucket": at, "n": n[at]}

    rows = by_batch(found.select("found"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed frequencies."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: int, id_: int) -> int:
    """Gumbel noise in thousandths, a function of the id alone."""
    h = int(sha256(f"{seed}:{id_}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             n: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``id_col, n_features, weight, score, rank`` of every row of ``docs``;
    the drawn rows are those with a rank."""
    found = stored(features(docs, id_col, text_col, n, buckets), "resampling-features")
    target = features(targets.select(F.lit(0).alias("_id"), F.col(target_col).alias("_text")), "_id", "_text", n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(target, buckets))
    width = Scanner(n, buckets).type

    def weigh(batch: pa.RecordBatch) -> dict[str, list]:
        ids, words = batch.column("id").to_pylist(), batch.column("n_words").to_pylist()
        each = [gain[np.frombuffer(x.as_py(), width)] for x in batch.column("found")]
        weight = [int(g.sum()) // len(g) if len(g) else 0 for g in each]
        score = [None if i is None else w + noise(seed, i) for i, w in zip(ids, weight)]
        return {"id": ids, "n_features": [len(g) for g in each], "weight": weight, "score": score, "may": [w >= least_words for w in words]}

    scored = stored(by_batch(found, weigh, "id long, n_features long, weight long, score long, may boolean"), "resampling-scores")
    return _ranked(scored, percent).withColumnRenamed("id", id_col)


def _ranked(scored: DataFrame, percent: int) -> DataFrame:
    may = scored.where("may and score is not null")
    draws = scored.agg(F.coalesce(F.floor(F.expr(f"{percent} * count_if(may) / 100")), F.lit(0)).alias("draws"))
    per_score = may.groupBy("score").agg(F.count("*").alias("n")).withColumn("part", F.floor(F.col("score") / SCORE_GROUP))
    above_part = per_score.groupBy("part").agg(F.sum("n").alias("n_part"))
    down = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    above_part = above_part.select("part", F.coalesce(F.sum("n_part").over(down), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    above = per_score.join(above_part, "part").select("score", (F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("above"))
    (draw,) = draws.first()  # one number
    place = Window.partitionBy("score").orderBy("id")
    drawn = may.join(above.where(F.col("above") < draw), "score").withColumn("rank", F.col("above") + F.row_number().over(place))
    kept = ["id", "n_features", "weight", "score"]
    drawn = drawn.select(*kept, F.when(F.col("rank") <= draw, F.col("rank")).cast("long").alias("rank"))
    rest = may.join(above.where(F.col("above") >= draw).select("score"), "score", "left_semi")
    out_of = scored.where("not may or score is null")
    return drawn.unionByName(rest.unionByName(out_of).select(*kept, F.lit(None).cast("long").alias("rank")))
