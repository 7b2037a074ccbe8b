"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of more than ``CHUNK`` characters is cut into chunks that overlap by
``OVERLAP``.  The chunks are pre-tokenised in parallel, each from its own
start; where the ends of pre-tokens of two neighbours first agree inside their
overlap they agree from there on (the pattern looks ahead, never back, and
ends near a chunk's right edge are not trusted), so the pieces between such
points are exactly the text's own pre-tokens and are encoded in parallel.
Neighbours that never agree (one word longer than the overlap) are joined and
encoded as one piece.  Shorter texts are one piece from the start.  Decoding
looks up every id's bytes and concatenates them.

Within a piece each distinct pre-token is merged once and then remembered, in
bounded memory.

Null and empty texts have no tokens.  Rows are independent: a repeated row or
id gives a repeated row, an empty table an empty one, other columns of the
input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, merge

CHUNK = 16_384
OVERLAP = 512
EDGE = 4  # the pattern looks at fewer characters behind a pre-token
REMEMBERED = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The token strings and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder(dict):
    """Ids of a pre-token as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.single = [bytes([b]) for b in range(256)]
        self.strings = {rank: token for token, rank in ranks.items()}

    def __missing__(self, pre: str) -> bytes:
        raw = pre.encode()
        tokens = [raw] if raw in self.ranks else merge([self.single[b] for b in raw], self.ranks)
        ids = b"".join(struct.pack("<I", self.ranks[t]) for t in tokens)
        if len(self) > REMEMBERED:
            self.clear()
        if len(raw) < 64:
            self[pre] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))

    def ends(self, text: str) -> list[int]:
        return [m.end() for m in self.pattern.finditer(text)]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col, ids, decoded``: the encoded ids (little-endian unsigned
    32-bit) of every row and the bytes they decode to."""
    return _encode(docs, vocabulary, pattern, id_col, text_col, chunk, overlap, False)


def encode_digests(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    return _encode(docs, vocabulary, pattern, id_col, text_col, chunk, overlap, True)


def _encode(docs, vocabulary, pattern, id_col, text_col, chunk, overlap, digests) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(vocabulary), pattern))  # as large as the rank file
    own: list[Encoder] = []

    def encoder() -> Encoder:
        if not own:
            own.append(Encoder(*shared.value))
        return own[0]

    schema = "id long, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded binary")

    def finished(id_: list, ids: list[bytes]) -> dict[str, list]:
        decoded = [encoder().decode(x) for x in ids]
        if not digests:
            return {"id": id_, "ids": ids, "decoded": decoded}
        sha = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in (ids, decoded)]
        return {"id": id_, "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": sha[0], "decoded_sha256": sha[1]}

    def whole(batch: pa.RecordBatch) -> dict[str, list]:
        return finished(batch.column("id"), [encoder().encode(t) for t in batch.column("text").to_pylist()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                for part in range(max(1, -(-(len(r["text"]) - overlap) // chunk))):
                    at = part * chunk
                    yield pa.RecordBatch.from_pylist([r | {"part": part, "at": at, "text": r["text"][at : at + chunk + overlap], "last": at + chunk + overlap >= len(r["text"])}], schema=CUT)

    CUT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("text", pa.string()), ("last", pa.bool_())])

    def bounds(batch: pa.RecordBatch) -> dict[str, list]:
        out = {name: batch.column(name) for name in ("row", "id", "part", "at", "text")}
        heads, tails = [], []
        for at, text, last in zip(*(batch.column(c).to_pylist() for c in ("at", "text", "last"))):
            ends = encoder().ends(text)
            heads.append([at] * (at == 0) + [at + e for e in ends if e <= overlap])
            sure = ends[:-1] if not last else ends
            tails.append([at + e for e in sure if e >= chunk and (last or e <= len(text) - EDGE)])
        return out | {"head": heads, "tail": tails}

    def pieces(batch: pa.RecordBatch) -> dict[str, list]:
        done = []
        for start, end, parts in zip(*(batch.column(c).to_pylist() for c in ("start", "end", "parts"))):
            text = "".join([p["text"][:chunk] for p in parts[:-1]] + [parts[-1]["text"]])
            at = parts[0]["at"]
            done.append(encoder().encode(text[start - at : None if end is None else end - at]))
        return {"row": batch.column("row"), "id": batch.column("id"), "piece": batch.column("piece"), "ids": done}

    def joined(batch: pa.RecordBatch) -> dict[str, list]:
        return finished(batch.column("id"), [b"".join(p["ids"] for p in parts) for parts in batch.column("pieces").to_pylist()])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    length = F.char_length("text")
    short = by_batch(rows.where(length <= chunk + overlap), whole, schema)
    parts = rows.where(length > chunk + overlap).mapInArrow(cut, "row long, id long, part long, at long, text string, last boolean")
    parts = by_batch(parts.repartition("row", "part"), bounds, "row long, id long, part long, at long, text string, head array<long>, tail array<long>")
    order = Window.partitionBy("row").orderBy("part")
    meets = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
    parts = parts.withColumn("start", F.when(F.col("part") == 0, F.lit(0)).otherwise(meets))
    parts = parts.withColumn("piece", F.count("start").over(order)).withColumn("next", F.lead("start").over(order))
    cuts = parts.groupBy("row", "id", "piece").agg(
        F.max("start").alias("start"), F.max_by("next", "part").alias("end"),
        F.array_sort(F.collect_list(F.struct("part", "at", "text"))).alias("parts"))
    coded = by_batch(cuts, pieces, "row long, id long, piece long, ids binary")
    long = coded.groupBy("row", "id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    out = short.unionByName(by_batch(long, joined, schema))
    return out.withColumnRenamed("id", id_col)
