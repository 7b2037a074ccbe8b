"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are streams of lower-case word tokens, held as
63-bit hashes.  A seed is a run of ``MIN_MATCH`` tokens (of an item's own
length, if that is less), known by its Karp-Rabin hash.  The steps:

1. items are tokenised, equal ones are one from here on, and their seeds are
   a table;
2. one pass over the documents hashes their runs and keeps those that may be
   seeds.  What decides is a bitmap of ``BITS`` bits, of one size for any
   benchmark: a large benchmark fills it and lets more runs through, it never
   holds a seed back.  Only the runs kept leave the task, with a digest of the
   text, and equal texts are one;
3. seeds of documents and items are joined on their hashes by Spark, sides
   split where a seed is hot.  Each pair of a text and an item gets the places
   of the seeds it shares; a pair whose seeds could not cover ``threshold`` of
   the item, each of them covering its own tokens only, ends here;
4. the pairs left are tiled: runs of tokens that neither side has used yet are
   compared by running hashes of falling lengths and token by token, and the
   longest match is marked first, until no match of ``MIN_MATCH`` tokens is
   left.  The text is not needed for that: a match lies inside runs that seeds
   cover, and these have the item's tokens.

Matches may come in any order, so reordered passages count as well.  A pair is
contaminated if tiles cover at least ``threshold`` of the item's tokens.

Items of fewer than ``MIN_MATCH`` tokens are compared as one run of their own
length.  Items and documents without tokens match nothing.  Equal matches are
marked by their place in the document, then in the item.  Repeated documents
give repeated rows, repeated items count once for each row; null ids stay
null.  Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, split_join, stored

MIN_MATCH = 5
THRESHOLD = 0.6
#: Size of the bitmap of seeds, which every task holds: 8 MB.
BITS = 1 << 26
_BASE = 0x2545F4914F6CDD1D

tokens = re.compile(r"\w+").findall


def _sums(x: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``k`` values, modulo 2**64."""
    if len(x) < k:
        return np.zeros(0, np.int64)
    out = np.zeros(len(x) - k + 1, np.int64)
    for i in range(k):
        out = out * np.int64(_BASE) + x[i : i + len(out)]
    return out


def tile(doc: list[int], item: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(place in doc, place in item, tokens)``."""
    used_doc, used_item, tiles = [False] * len(doc), [False] * len(item), []
    most = len(item)
    while (width := _longest(doc, used_doc, item, used_item, shortest, most)) >= shortest:
        places = defaultdict(list)
        for h, at in _runs(item, used_item, width):
            places[h].append(at)
        for h, at in _runs(doc, used_doc, width):
            for j in places.get(h, ()):
                if any(used_doc[at : at + width]):
                    break
                if not any(used_item[j : j + width]) and doc[at : at + width] == item[j : j + width]:
                    used_doc[at : at + width] = used_item[j : j + width] = [True] * width
                    tiles.append((at, j, width))
                    break
        most = width - 1
    return tiles


def _longest(doc: list[int], used_doc: list[bool], item: list[int], used_item: list[bool], low: int, high: int) -> int:
    """The largest width at most ``high`` at which unused runs have equal
    hashes, by bisection (a match of a width has matches of all smaller ones);
    ``low - 1`` if there is none."""
    low -= 1
    while low < high:
        width = (low + high + 1) // 2
        known = {h for h, _ in _runs(item, used_item, width)}
        if known and any(h in known for h, _ in _runs(doc, used_doc, width)):
            low = width
        else:
            high = width - 1
    return low


def _runs(x: list[int], used: list[bool], k: int) -> list[tuple[int, int]]:
    """Hash and place of the runs of ``k`` unused values, by a running hash."""
    out, h, n, drop = [], 0, 0, pow(_BASE, k, 1 << 64)
    for i, v in enumerate(x):
        if used[i] or v < 0:
            h = n = 0
            continue
        h = (h * _BASE + v) % (1 << 64)
        n += 1
        if n > k:
            h = (h - drop * x[i - k]) % (1 << 64)
        if n >= k:
            out.append((h, i - k + 1))
    return out


def token_hashes(text: str, known: dict[str, int]) -> np.ndarray:
    """63-bit hashes of the tokens; ``known`` keeps those of earlier texts."""
    import xxhash

    words = tokens(text.lower())
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((known[w] if w in known else known.setdefault(w, h(w) >> 1) for w in words), np.int64, len(words))


def seed_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` tokens, of other values for every ``k``."""
    h = _sums(x, k).view(np.uint64) + np.uint64(k)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(27))).view(np.int64)


def parts(places: list[tuple[int, int]], item: list[int], k: int) -> list[int]:
    """The runs of a text that seeds cover, in the text's order with -1
    between them, from the ``places`` of the seeds in text and item."""
    out: list[int] = []
    last = 0
    for at, first in sorted(places):
        if at >= last and out:
            out.append(-1)
        out += item[first + max(last - at, 0) : first + k]
        last = at + k
    return out


def _item_rows(items: DataFrame, item_col: str, text_col: str, min_match: int) -> DataFrame:
    """``item, key, k, tokens`` of the items that have tokens; ``key`` tells
    different items apart."""

    def tokenise(batch: pa.RecordBatch) -> dict[str, list]:
        known: dict[str, int] = {}
        found = [(i, token_hashes(t or "", known)) for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist())]
        found = [(i, x) for i, x in found if len(x)]
        return {"item": [i for i, _ in found], "key": [hashlib.md5(x.tobytes()).digest() for _, x in found],
                "k": [min(min_match, len(x)) for _, x in found], "tokens": [x for _, x in found]}

    rows = items.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    return stored(by_batch(rows, tokenise, "item long, key binary, k int, tokens array<long>"), "tiling-items")


def _seed_rows(unique: DataFrame) -> DataFrame:
    """``h, key, k, n_tokens, first, times``: the seeds of each item, their
    first place in it and how often it has them."""

    def seeds(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("h", "key", "k", "n_tokens", "first", "times")}
        for key, k, tokens_ in zip(*(batch.column(c).to_pylist() for c in ("key", "k", "tokens"))):
            h, first, times = np.unique(seed_hashes(np.array(tokens_, np.int64), k), return_index=True, return_counts=True)
            for name, values in (("h", h.tolist()), ("first", first.tolist()), ("times", times.tolist())):
                out[name] += values
            for name, value in (("key", key), ("k", k), ("n_tokens", len(tokens_))):
                out[name] += [value] * len(h)
        return out

    return stored(by_batch(unique, seeds, "h long, key binary, k int, n_tokens long, first int, times int"), "tiling-seeds")


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """One bit for the lowest bits of each seed; at most ``bits / 64`` rows
    come to the driver."""
    words = seeds.select((F.col("h").bitwiseAND(F.lit(bits - 1))).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63L AS int))")).alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return out.view(np.uint64)


def _places(rows: DataFrame, seeds: DataFrame, bits: int) -> DataFrame:
    """``doc, digest, h, at`` of the rows with runs that may be seeds: arrays
    of the runs' hashes and places."""
    lengths = sorted(r["k"] for r in seeds.select("k").distinct().collect())  # at most min_match
    bitmap = rows.sparkSession.sparkContext.broadcast(_bitmap(seeds, bits))

    def scan(batch: pa.RecordBatch) -> dict[str, list]:
        known: dict[str, int] = {}
        table, low = bitmap.value, np.uint64(bits - 1)
        out: dict[str, list] = {c: [] for c in ("doc", "digest", "h", "at")}
        for doc, digest, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "digest", "text"))):
            x = token_hashes(text, known)
            hits = []
            for k in lengths:
                h = seed_hashes(x, k)
                bit = h.view(np.uint64) & low
                at = np.flatnonzero(table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))
                hits.append((h[at], at))
            if any(len(at) for _, at in hits):
                for name, value in (("doc", doc), ("digest", digest), ("h", np.concatenate([h for h, _ in hits])), ("at", np.concatenate([a for _, a in hits]))):
                    out[name].append(value)
        return out

    return stored(by_batch(rows, scan, "doc long, digest binary, h array<long>, at array<int>"), "tiling-places")


def _covered(docs: DataFrame, items: DataFrame, threshold: float, min_match: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``digest, key, n_tokens, n_covered`` of the pairs of different texts
    and items that reach the threshold, and the rows of ``docs`` (``doc,
    text``) that may be part of one (``doc, digest``)."""
    unique = items.groupBy("key").agg(F.any_value("k").alias("k"), F.any_value("tokens").alias("tokens"))
    seeds = _seed_rows(unique)
    rows = docs.where("text is not null").select("doc", F.unhex(F.md5("text")).alias("digest"), "text")
    found = _places(rows, seeds, bits)
    texts = found.groupBy("digest").agg(F.any_value(F.struct("h", "at")).alias("s"))
    texts = texts.select("digest", F.explode(F.arrays_zip("s.h", "s.at")).alias("s")).select("digest", "s.h", "s.at")
    pairs = split_join(texts, seeds, "h").groupBy("digest", "key").agg(
        F.any_value("k").alias("k"), F.any_value("n_tokens").alias("n_tokens"), F.sum("times").alias("shared"),
        F.collect_list(F.struct("at", "first")).alias("places"))
    pairs = pairs.where(F.col("k") * F.col("shared") >= threshold * F.col("n_tokens")).select("digest", "key", "k", "places")
    pairs = split_join(pairs, unique.select("key", "tokens"), "key")

    def cover(batch: pa.RecordBatch) -> dict[str, list]:
        n_tokens, n_covered = [], []
        for k, places, tokens_ in zip(*(batch.column(c).to_pylist() for c in ("k", "places", "tokens"))):
            item = np.unique(np.array(tokens_, np.int64), return_inverse=True)[1].tolist()
            tiles = tile(parts([(p["at"], p["first"]) for p in places], item, k), item, k)
            n_tokens.append(len(item))
            n_covered.append(sum(t[2] for t in tiles))
        return {"digest": batch.column("digest"), "key": batch.column("key"), "n_tokens": n_tokens, "n_covered": n_covered}

    tiled = by_batch(pairs, cover, "digest binary, key binary, n_tokens long, n_covered long")
    hits = stored(tiled.where(F.col("n_covered") >= threshold * F.col("n_tokens")), "tiling-hits")
    return hits, found.select("doc", "digest")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 bits: int = BITS) -> DataFrame:
    """``id_col, item_col, n_tokens, n_covered, coverage`` of the pairs of a
    document and an item whose coverage reaches ``threshold``."""
    known = _item_rows(items, item_col, item_text_col, min_match)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    hits, found = _covered(rows, known, threshold, min_match, bits)
    out = split_join(split_join(found, hits, "digest"), known.select("item", "key"), "key")
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_tokens", "n_covered",
                      F.round(F.col("n_covered") / F.col("n_tokens"), 6).alias("coverage"))


def clean_rows(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that are contaminated by no item, unchanged."""
    known = _item_rows(items, item_col, item_text_col, min_match)
    rows = docs.select(F.lit(None).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    hits, _ = _covered(rows, known, threshold, min_match, bits)
    bad = stored(hits.select("digest").distinct(), "tiling-texts")
    return docs.join(bad, F.unhex(F.md5(docs[text_col].cast("string"))) == bad["digest"], "left_anti")
