"""Token counts by the whole-token shortcut.

The vocabulary is a sentencepiece BPE model with byte fallback.  Before any
text is read, the driver

* checks the model's normalisation (identity, a leading space mark, spaces
  turned into marks), which the counting relies on;
* proves at which places no merge can reach across: no piece has a space mark
  behind another character, and no longer piece has a character such as a
  line feed, so texts fall into pre-tokens that encode independently;
* runs the merges on every vocabulary string and keeps those that end as one
  token.  A pre-token among them counts 1 by one lookup.

Only the remaining pre-tokens are merged, each distinct one once per worker
and fill of its bounded memory.  Characters outside the vocabulary count their UTF-8 bytes.

Null and empty texts have 0 bytes and 0 tokens.  Rows are independent:
repeated rows give repeated rows, an empty table an empty one, other columns
of the input are ignored.  A text of any length is counted whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch, merge

MARK = "▁"  # what the model writes for a space
REMEMBERED = 500_000  # distinct pre-tokens that a worker keeps


class Vocabulary:
    """Merge ranks, proven whole tokens and pre-token pattern of a model file."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb2

        with open(model_file, "rb") as f:
            proto = pb2.ModelProto.FromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        normal = pb2.ModelProto.SentencePiece.NORMAL
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError(f"{model_file}: only identity normalisation with a leading space mark is supported")
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.user_defined_symbols:
            raise ValueError(f"{model_file}: only BPE with byte fallback and without own symbols is supported")
        pieces = [p for p in proto.pieces if p.type == normal]
        self.rank = {p.piece: -p.score for p in pieces}
        long = [p.piece for p in pieces if len(p.piece) > 1]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in long):
            raise ValueError(f"{model_file}: a piece joins two words")
        stops = [c for c in "\n\t\r" if not any(c in p for p in long)]
        alone = "".join(map(re.escape, stops))
        self.pattern = f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")
        self.whole = frozenset(p for p in self.rank if merge(list(p), self.rank) == [p])
        # the library must agree, where a string can be given to it alone
        check = sentencepiece.SentencePieceProcessor(model_file=model_file)
        alone = [p for p in self.whole if re.fullmatch(f"{MARK}[^{MARK}]+", p)]
        if any(len(ids) != 1 for ids in check.encode([p[1:] for p in alone])):
            raise ValueError(f"{model_file}: merges differ from the library's")


class Counter(dict):
    """Tokens of a pre-token; what is neither whole nor known yet is merged."""

    def __init__(self, vocabulary: Vocabulary):
        self.rank, self.start = vocabulary.rank, dict.fromkeys(vocabulary.whole, 1)
        self.find = re.compile(vocabulary.pattern).findall
        self.update(self.start)

    def __missing__(self, pre: str) -> int:
        if len(self) > len(self.start) + REMEMBERED:
            self.clear()
            self.update(self.start)
        n = sum(1 if s in self.rank else len(s.encode()) for s in merge(list(pre), self.rank))
        if len(pre) < 64:
            self[pre] = n
        return n

    def tokens(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.find(MARK + text.replace(" ", MARK)))) if text else 0


def count_tokens(docs: DataFrame, model_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))  # as large as the model file
    own: list[Counter] = []

    def count(batch: pa.RecordBatch) -> dict[str, list]:
        if not own:
            own.append(Counter(shared.value))
        return {"id": batch.column("id"), "n_bytes": batch.column("n_bytes"), "n_tokens": [own[0].tokens(t) for t in batch.column("text").to_pylist()]}

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return by_batch(rows, count, "id long, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
