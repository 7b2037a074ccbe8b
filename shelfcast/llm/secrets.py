"""Secret scan with character Markov models, in DataFrame functions alone.

Base spans come from three patterns.  The method adds tokens that look random:
two first-order character models, one of random strings and one of ordinary
identifiers, give each candidate (a maximal run of at least ``MIN_TOKEN``
characters of ``ALPHABET`` that has a letter and a digit) the logarithm of its
likelihood ratio; candidates above ``ODDS`` that touch no base span are added.

The models are trained on labelled samples: in the documents with the
smallest hashes of their ids, ``SAMPLE`` at most, base spans are labelled
random and the other identifiers ordinary.  Pairs of neighbouring characters
are counted by Spark; the driver sees one count for each label and pair, a
table bounded by the alphabet.  Without base spans in the sample there is no
model of random strings and nothing is added.

Positions are code points: what lies between matches and the matches
themselves alternate, so their running lengths are the places.  Running totals
and overlaps are taken in pieces of ``PIECE`` elements, as building an array
element by element copies it each time: a token of a megabyte or a text with
100,000 matches takes seconds.

A null or empty text has no spans.  Rows are independent, so repeated rows
and ids give repeated rows and an empty table an empty one; other columns are
ignored, but ``find_secrets`` refuses columns with the names of those it adds.
Texts of any length are scanned whole.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4_096
MIN_TOKEN = 20
PIECE = 256
ODDS = 14.0  # natural logarithm of the odds that a candidate must overcome
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

# The base patterns, and what a match must have to stay.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

# The same matches, found without visiting those that are dropped for their length.
_ACCESS = r"AKIA[A-Z0-9]{16,}+"
_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
_RUN = r"[A-Za-z0-9+/_=\-]"
_TOKEN = rf"(?<!{_RUN})(?=[A-Za-z+/_=\-]*+[0-9])(?=[0-9+/_=\-]*+[A-Za-z]){_RUN}{{{MIN_TOKEN},}}+"

SPAN = "array<struct<start:int,kind_no:int,kind:string,end:int,value:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pieces(x: Column) -> Column:
    """A bound array in pieces of ``PIECE`` elements."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(x) / PIECE).cast("int")), lambda i: F.slice(x, i * PIECE + 1, PIECE))


def _running(x: Column) -> Column:
    """The running totals of an array of integers."""
    def totals(piece: Column, start: Column) -> Column:
        return F.slice(F.aggregate(piece, F.array(start), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))), 2, F.size(piece))

    def of_pieces(pieces: Column) -> Column:
        sums = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda a, n: a + n))
        before = F.aggregate(sums, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
        return F.flatten(F.zip_with(pieces, F.slice(before, 1, F.size(pieces)), totals))

    return _let(x, lambda v: _let(_pieces(v), of_pieces))


def _free(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span; both are sorted by start."""
    def clear(piece: Column, near: Column) -> Column:
        return F.filter(piece, lambda t: ~F.exists(near, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))

    def free(piece: Column, spans: Column) -> Column:
        ends = F.struct(F.element_at(piece, 1)["start"].alias("first"), F.element_at(piece, -1)["end"].alias("last"))
        near = _let(ends, lambda e: F.filter(spans, lambda b: (b["start"] < e["last"]) & (e["first"] < b["end"])))
        return F.when(F.size(piece) > 0, _let(near, lambda n: clear(piece, n))).otherwise(piece)

    return _let(tokens, lambda t: F.when(F.size(base) == 0, t).otherwise(_let(base, lambda spans: F.flatten(F.transform(_pieces(t), lambda p: free(p, spans))))))


def _spans(text: Column, pattern: str, kind: str, value_group: int = 0, shortest: int = 0) -> Column:
    """Spans of the matches whose value has at least ``shortest`` characters."""
    regex = F.lit(pattern)
    between = F.transform(F.split(text, pattern, -1), F.char_length)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    rows = F.arrays_zip(whole.alias("whole"), F.regexp_extract_all(text, regex, F.lit(value_group)).alias("value"), between.alias("between"))
    def span(row: Column, end: Column) -> Column:
        return F.struct((end - F.char_length(row["whole"])).alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"), end.alias("end"), row["value"].alias("value"))

    found = _let(F.filter(rows, lambda r: r["whole"].isNotNull()), lambda matches: F.zip_with(
        matches, _running(F.transform(matches, lambda r: r["between"] + F.char_length(r["whole"]))), span))
    if shortest:
        found = F.filter(found, lambda s: F.char_length(s["value"]) >= shortest)
    return F.when(F.regexp_like(text, regex), found).otherwise(F.array().cast(SPAN))


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of each kind in columns ``_assign``,
    ``_access`` and ``_hex``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"_assign": _spans(text, ASSIGN, "assign", 2, 6), "_access": _spans(text, _ACCESS, "access"), "_hex": _spans(text, _HEX, "hex")})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> list[float] | None:
    """Log-likelihood ratios of all pairs of characters, row by row."""
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    few = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(ids), "_id", "left_semi")
    spans = base_spans(few, "_text").select("_text", F.concat("_assign", "_access", "_hex").alias("spans"))
    random = spans.select(F.lit(True).alias("random"), F.explode(F.transform("spans", lambda s: s["value"])).alias("token")).where(
        (F.char_length("token") >= 16) & F.regexp_like("token", F.lit("[0-9]")))
    outside = F.col("_text")
    for pattern in (ASSIGN, _ACCESS, _HEX):
        outside = F.regexp_replace(outside, pattern, " ")
    words = F.regexp_extract_all(outside, F.lit(rf"{_RUN}{{4,}}+"), F.lit(0))
    plain = spans.select(F.lit(False).alias("random"), F.explode(words).alias("token")).where(~F.regexp_like("token", F.lit("[0-9a-f]{24,}|[0-9A-F]{24,}")))
    tokens = random.unionByName(plain)
    pairs = tokens.select("random", F.split("token", "").alias("c")).select(
        "random", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: F.concat(a, b))).alias("pair"))
    # one row for each label and pair of the alphabet
    pairs = pairs.where(F.regexp_like("pair", F.lit(f"^{_RUN}{{2}}$")))
    rows = pairs.groupBy("random", "pair").count().collect()
    counts = {kind: Counter({r["pair"]: r["count"] for r in rows if r["random"] == kind}) for kind in (True, False)}
    if not counts[True]:
        return None
    n = len(ALPHABET)
    first, second = ({kind: Counter() for kind in counts} for _ in range(2))
    for kind, pair in counts.items():
        for p, k in pair.items():
            first[kind][p[0]] += k
            second[kind][p[1]] += k
    every = max(1, sum(second[False].values()))

    def random_chance(a: str, b: str) -> float:
        # half of the weight on any character, as most random strings use more than the sample's
        own = counts[True][a + b] / first[True][a] if first[True][a] else 1 / n
        return 0.5 * own + 0.5 / n

    def plain_chance(a: str, b: str) -> float:
        # pairs that the sample lacks have the chance of their second character
        own = counts[False][a + b] / first[False][a] if first[False][a] else 1 / n
        return 0.8 * own + 0.19 * second[False][b] / every + 0.01 / n

    # signs between the parts of a token are no evidence, both kinds have too few
    parts = set(ALPHABET) - set("+/_=-")
    return [round(math.log(random_chance(a, b) / plain_chance(a, b)), 4) if {a, b} <= parts else 0.0 for a in ALPHABET for b in ALPHABET]


def _score(token: Column, ratios: list[float]) -> Column:
    """The sum of the ratios of a token's pairs; it is split into characters once."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def total(codes: Column) -> Column:
        n = F.size(codes) - 1
        steps = F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: F.element_at(table, (a - 1) * len(ALPHABET) + b))
        return F.aggregate(steps, F.lit(0.0), lambda sum_, x: sum_ + x)

    return F.element_at(F.transform(F.array(codes), total), 1)


def find_secrets(docs: DataFrame, ratios: list[float] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``base`` and ``added``, arrays of
    ``(start, kind_no, kind, end, value)`` sorted by start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    taken = sorted({"base", "added", "_assign", "_access", "_hex"} & set(docs.columns))
    if taken:
        raise ValueError(f"the columns {taken} would be replaced")
    out = base_spans(docs, text_col).withColumn("base", F.array_sort(F.concat("_assign", "_access", "_hex"))).drop("_assign", "_access", "_hex")
    if ratios is None:
        return out.withColumn("added", F.array().cast(SPAN))
    tokens = _spans(text, _TOKEN, "markov")
    free = _free(tokens, F.col("base"))
    return out.withColumn("added", F.filter(free, lambda t: _score(t["value"], ratios) > ODDS))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
