"""Cross-tokenizer alignment by lockstep merging.

Every text is encoded by two tokenizers: A, byte-level BPE, reads a space and
the text; B, a sentencepiece model, reads the text and adds the space itself.
Both token sequences then spell the same bytes, and the byte offsets where a
token of each ends ("cuts") part them into groups; all A and B tokens of a
group are linked.

The documents of a block (about ``BLOCK`` bytes of text) are merged in
lockstep: one state vector holds for every document the next A and the next B
token.  Each step compares the two ends of all documents at once, advances the
one that ends first (both at a cut), emits the cuts of the step with their
links, and compacts documents that are finished away.  A long document enters
with several positions, each right behind a cut (an A end looked up among the
B ends), so that it is not alone in the vector for thousands of steps.

Corpus-wide counts of linked id pairs: a block keeps each of its distinct
pairs once, with the number of its documents that hold it.  Blocks meet the
counts by an equi-join on the pair and go back to their documents by the
block's number; no document is exploded into its links and nothing is
collected.  A frequent pair occurs once a block, and both join sides have an
exchange of their own, so that a hot pair can be split.

Texts that are null or empty, or that a tokenizer does not spell back byte for
byte, have no tokens: zeros and empty lists.  Rows are independent: a repeated
row is a document of its own and counts again.  An empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, slices, stored

BLOCK = 1 << 20  # bytes of text aligned at once
LANE = 128  # A tokens after which a document gets another position in the state vector
MANY = 64  # links of a group beyond which equal ids of it are counted before they are paired
MARK = "▁"


class Side:
    """A tokenizer's batch encoding and the bytes of its tokens."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.size = np.array([len(b) for b in token_bytes], np.int64)
        self.spells = False  # whether tokens of a text always spell its bytes where their lengths add up

    def names(self, end: str) -> np.ndarray:
        """Every id as text with a comma behind it, and with ``end`` for the last of a group."""
        return np.array([[f"{i}{mark}" for i in range(len(self.bytes))] for mark in (",", end)], object)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError


class ByteLevel(Side):
    """Byte-level BPE from a ``tokenizers`` file.

    tiktoken encodes several times faster than the file's own library, so it is
    used where the file is proven to be the same encoding: merges in the order
    of their ids, the library's own pre-tokenisation, no normaliser.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_alphabet()
        vocabulary = spec["model"]["vocab"]
        strings = {i: bytes(to_byte[c] for c in token) for token, i in vocabulary.items()}
        for token in spec["added_tokens"]:
            strings.setdefault(token["id"], token["content"].encode())
        super().__init__([strings.get(i, b"") for i in range(max(strings) + 1)])
        self.quick = self._same_by_ranks(spec, to_byte, vocabulary)
        self.spells = self.quick is not None
        self.library = None
        if not self.spells:
            self.library = Tokenizer.from_file(path)
            self.library.encode_special_tokens = True
        self.written = self.names("|")

    @staticmethod
    def _same_by_ranks(spec: dict, to_byte: dict[str, int], vocabulary: dict[str, int]):
        import public_tokenizers
        import tiktoken

        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        special = {t["content"] for t in spec["added_tokens"]}
        plain = {t: i for t, i in vocabulary.items() if t not in special}
        same = (model["type"] == "BPE" and spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                and not pre.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix"))
                and sorted(plain.values()) == list(range(len(plain))) and len(merges) == len(plain) - 256
                and [vocabulary.get(a + b) for a, b in merges] == list(range(256, len(plain))))
        if not same:
            return None
        ranks = {bytes(to_byte[c] for c in t): i for t, i in plain.items()}
        return tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.quick is not None:
            return [self.quick.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]
        return [np.array(e.ids, np.int64) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Side):
    """A sentencepiece model; its tokens spell the text behind one space.

    Where the model leaves characters as they are and falls back on bytes, its
    tokens can differ from the text in one way only: a space mark in the text,
    three bytes, is spelled as a space.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb2

        with open(path, "rb") as f:
            spec = pb2.ModelProto.FromString(f.read())
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        strings = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            strings.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode())
        super().__init__(strings)
        norm = spec.normalizer_spec
        self.spells = spec.trainer_spec.byte_fallback and norm.add_dummy_prefix and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        self.written = self.names(";")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(other)}


def _spells(side: Side, ids: np.ndarray, text: bytes) -> bool:
    if int(side.size[ids].sum()) != len(text):
        return False
    return side.spells or b"".join(map(side.bytes.__getitem__, ids.tolist())) == text


class Aligned:
    """Tokens, groups and links of the documents of a block.

    ``a``, ``b``: ids of all documents one after the other; ``a_of``, ``b_of``:
    the document of each; ``a_cut``, ``b_cut``: tokens up to and with each
    cut; ``link_of``, ``link_a``, ``link_b``, ``link_n``: document, ids and
    number of links.
    """

    def __init__(self, texts: list[str | None], side_a: Side, side_b: Side):
        whole = [" " + t if t else "" for t in texts]
        some = [i for i, t in enumerate(whole) if t]
        a, b = side_a.ids([whole[i] for i in some]), side_b.ids([texts[i] for i in some])
        spelled = [whole[i].encode() for i in some]
        same = [_spells(side_a, x, t) and _spells(side_b, y, t) for x, y, t in zip(a, b, spelled)]
        some, a, b = ([v for v, ok in zip(values, same) if ok] for values in (some, a, b))
        n_a, n_b = (np.bincount(some, [len(x) for x in ids], len(texts)).astype(np.int64) for ids in (a, b))
        self.n_a, self.n_b = n_a, n_b
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(none + a), np.concatenate(none + b)
        self.a_of, self.b_of = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        self._merge(np.cumsum(side_a.size[self.a]), np.cumsum(side_b.size[self.b]))

    def _positions(self, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the state vector starts: documents, and places behind a cut
        about every ``LANE`` tokens of A."""
        first = np.flatnonzero(np.diff(self.a_of, prepend=-1))
        here = np.setdiff1d(np.arange(LANE, len(end_a), LANE) - 1, first - 1)
        found = [first]
        for _ in range(LANE):  # an end that B does not share is passed on to the next token
            if not len(here):
                break
            cut = end_b[np.searchsorted(end_b, end_a[here])] == end_a[here]
            found.append(here[cut] + 1)
            here = here[~cut] + 1
        start_a = np.unique(np.concatenate(found))
        start_a = start_a[start_a < len(end_a)]
        before = np.where(start_a > 0, end_a[start_a - 1], 0)
        return start_a, np.searchsorted(end_b, before, side="right")

    def _merge(self, end_a: np.ndarray, end_b: np.ndarray) -> None:
        at_a, at_b = self._positions(end_a, end_b)
        stop_a = np.append(at_a[1:], len(end_a))
        from_a, from_b = at_a.copy(), at_b.copy()  # where the open group of each position starts
        cuts, links = [], []
        while len(at_a):
            ends_a, ends_b = end_a[at_a], end_b[at_b]
            cut = ends_a == ends_b
            at_a, at_b = at_a + (ends_a <= ends_b), at_b + (ends_b <= ends_a)
            closed = np.flatnonzero(cut)
            if len(closed):
                cuts.append(np.stack([at_a[closed], at_b[closed]]))
                links.append(self._links(from_a[closed], at_a[closed], from_b[closed], at_b[closed]))
                from_a[closed], from_b[closed] = at_a[closed], at_b[closed]
                if (at_a[closed] == stop_a[closed]).any():
                    going = ~cut | (at_a < stop_a)
                    at_a, at_b, from_a, from_b, stop_a = (v[going] for v in (at_a, at_b, from_a, from_b, stop_a))
        cut = np.concatenate([np.zeros((2, 0), np.int64), *cuts], axis=1)
        self.a_cut, self.b_cut = cut[:, np.argsort(cut[0])]
        self.link_of, self.link_a, self.link_b, self.link_n = np.concatenate([np.zeros((4, 0), np.int64), *links], axis=1)

    def _links(self, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
        """All pairs of A tokens ``a0..a1`` and B tokens ``b0..b1`` of each group."""
        wide = b1 - b0
        n = (a1 - a0) * wide
        large, one = n > MANY, n == 1
        few = np.flatnonzero(~large & ~one)
        group = np.repeat(few, n[few])
        nth = np.arange(len(group)) - np.repeat(np.cumsum(n[few]) - n[few], n[few])
        nth_a, nth_b = np.divmod(nth, wide[group])
        tok_a, tok_b = np.concatenate([a0[one], a0[group] + nth_a]), np.concatenate([b0[one], b0[group] + nth_b])
        out = [np.stack([self.a_of[tok_a], self.a[tok_a], self.b[tok_b], np.ones(len(tok_a), np.int64)])]
        if not large.any():
            return out[0]
        for g in np.flatnonzero(large):  # long groups repeat few ids
            (ids_a, n_a), (ids_b, n_b) = (np.unique(x, return_counts=True) for x in (self.a[a0[g] : a1[g]], self.b[b0[g] : b1[g]]))
            pairs = len(ids_a) * len(ids_b)
            out.append(np.stack([np.full(pairs, self.a_of[a0[g]]), np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a)), np.outer(n_a, n_b).ravel()]))
        return np.concatenate(out, axis=1)

    def per_document(self, values: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
        return np.split(values, np.searchsorted(of, np.arange(1, len(self.n_a))))

    def cut_of(self) -> np.ndarray:
        """The document of every cut."""
        return self.a_of[self.a_cut - 1]

    def written(self, side_a: Side, side_b: Side) -> list[str]:
        """The groups of each document as ``a1,a2|b1;a3|b2,b3``."""
        before_a, before_b = np.append(0, self.a_cut)[:-1], np.append(0, self.b_cut)[:-1]
        place_a = np.arange(len(self.a)) + np.repeat(before_b, self.a_cut - before_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.a_cut, self.b_cut - before_b)
        last_a, last_b = np.zeros(len(self.a), np.int8), np.zeros(len(self.b), np.int8)
        last_a[self.a_cut - 1] = last_b[self.b_cut - 1] = 1
        out = np.empty(len(self.a) + len(self.b), object)
        out[place_a], out[place_b] = side_a.written[last_a, self.a], side_b.written[last_b, self.b]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(out[i:j].tolist())[:-1] for i, j in zip([0, *ends[:-1]], ends)]

    def by_document(self, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, id pair (``a * n_b + b``) and number of links, one row for
        each pair that a document holds, in that order."""
        pair = self.link_a * n_b + self.link_b
        top = int(pair.max(initial=0)) + 1
        key = self.link_of * top + pair
        if (self.link_n == 1).all():
            key.sort()
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, times = key[first], np.diff(first, append=len(key))
        else:
            key, back = np.unique(key, return_inverse=True)
            times = np.bincount(back, self.link_n, len(key)).astype(np.int64)
        return *np.divmod(key, top), times


@lru_cache(maxsize=1)
def sides(a_file: str, b_file: str) -> tuple[Side, Side]:
    """Both tokenizers, read once per worker process."""
    return ByteLevel(a_file), Pieces(b_file)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``id_col, a_ids, b_ids, a_cuts, b_cuts`` of every row: the ids, and how
    many tokens of each side lie before the end of every group."""
    def run(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"id": batch.column("id"), "a_ids": [], "b_ids": [], "a_cuts": [], "b_cuts": []}
        for part in slices(batch, block):
            m = Aligned(part.column("text").to_pylist(), *sides(a_file, b_file))
            of = m.cut_of()
            before_a, before_b = np.cumsum(m.n_a) - m.n_a, np.cumsum(m.n_b) - m.n_b
            for name, values, owner in (("a_ids", m.a, m.a_of), ("b_ids", m.b, m.b_of),
                                        ("a_cuts", m.a_cut - before_a[of], of), ("b_cuts", m.b_cut - before_b[of], of)):
                out[name] += m.per_document(values, owner)
        return out

    lists = "id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
    return by_batch(_rows(docs, id_col, text_col), run, lists).withColumnRenamed("id", id_col)


BLOCKS = """block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>,
    pairs array<long>, holders array<long>, starts binary, which binary, times binary"""


def linked(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    ``count_sum`` adds up over a document's links how many documents hold the
    link's id pair; ``n_best`` counts the links whose pair has the highest such
    number among the pairs of its A id, ties included.
    """
    def blocks(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, block):
            a_side, b_side = sides(a_file, b_file)
            m = Aligned(part.column("text").to_pylist(), a_side, b_side)
            docs_in = part.num_rows
            of, pair, times = m.by_document(len(b_side.bytes))
            pairs, which = np.unique(pair, return_inverse=True)
            starts = np.searchsorted(of, np.arange(docs_in + 1)).astype("<i8")
            yield {
                "ids": part.column("id").to_pylist(), "n_a": m.n_a, "n_b": m.n_b, "n_groups": np.bincount(m.cut_of(), minlength=docs_in),
                "n_links": np.bincount(m.link_of, m.link_n, docs_in).astype(np.int64),
                "groups_sha256": [sha256(g.encode()).hexdigest() if n else "" for g, n in zip(m.written(a_side, b_side), m.n_a)],
                "pairs": pairs, "holders": np.bincount(which, minlength=len(pairs)),
                "starts": starts.tobytes(), "which": which.astype("<i4").tobytes(), "times": _small(times)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.list_(pa.int64())) for n in ("ids", "n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", pa.list_(pa.string()))]
                           + [(n, pa.list_(pa.int64())) for n in ("pairs", "holders")] + [(n, pa.binary()) for n in ("starts", "which", "times")])
        for batch in batches:
            for row in blocks(batch):
                yield pa.RecordBatch.from_pylist([row], schema)

    def summed(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")}
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            starts, which = np.frombuffer(row["starts"].as_py(), "<i8"), np.frombuffer(row["which"].as_py(), "<i4")
            times = _unsmall(row["times"].as_py())
            told = row["told"].values  # as many as the block has pairs, in the pairs' order
            count, best = (told.field(n).to_numpy(zero_copy_only=False) if told is not None else np.zeros(0, np.int64) for n in ("count", "best"))
            for name, each in (("n_best", times * best[which]), ("count_sum", times * count[which])):
                total = np.append(0, np.cumsum(each))
                out[name] += (total[starts[1:]] - total[starts[:-1]]).tolist()
            for source, name in (("ids", "id"), ("n_a", "n_a"), ("n_b", "n_b"), ("n_groups", "n_groups"), ("n_links", "n_links"), ("groups_sha256", "groups_sha256")):
                out[name] += row[source].as_py()
        return out

    plain = BLOCKS.replace("block long, ", "")
    coded = stored(_rows(docs, id_col, text_col).mapInArrow(run, plain).withColumn("block", F.monotonically_increasing_id()), "alignment-blocks")
    vocabulary_b = F.lit(_vocabulary_size(b_file))
    held = coded.select("block", F.inline(F.arrays_zip("pairs", "holders")))
    count = held.groupBy("pairs").agg(F.sum("holders").alias("count"))
    same_a = Window.partitionBy(F.expr("pairs div b").alias("a"))  # at most B's vocabulary of pairs
    count = count.withColumn("b", vocabulary_b).withColumn("best", (F.col("count") == F.max("count").over(same_a)).cast("long"))
    told = held.select("block", "pairs").join(count.select("pairs", "count", "best"), "pairs")
    told = told.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pairs", "count", "best"))).alias("told"))
    back = coded.drop("pairs", "holders").join(told, "block", "left")
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return by_batch(back, summed, schema).withColumnRenamed("id", id_col)


def _small(times: np.ndarray) -> bytes:
    """Integers behind the width in bytes that the largest one needs."""
    width = 1 if times.max(initial=0) < 1 << 8 else 4 if times.max() < 1 << 31 else 8
    return bytes([width]) + times.astype(f"<u{width}").tobytes()


def _unsmall(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _vocabulary_size(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()
