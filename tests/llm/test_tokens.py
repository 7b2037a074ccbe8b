import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from shelfcast.llm import bpe, token_counts
from shelfcast.llm.common import _merge_short, merge
from tests.llm.helpers import docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "  a", "a  ", "▁x ▁", "a\nb\r\n\tc", "日本語 текст ünï", "<s> </s> <|endoftext|>", "\x00\x01", "x" * 3000, "ab " * 2000,
       "don't we'll 12345 !?!  \n\n  end", "　wide space", "é \U0001f600\U0001f468‍\U0001f469", "          deep", "a" * 70 + "\n" * 70]


@pytest.fixture(scope="module")
def texts(spark, sf_small):
    return ODD + [r[0] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").limit(60).collect()]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_counts_equal_the_library(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = token_counts.count_tokens(docs(spark, enumerate(texts)), MODEL, 50).collect()
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "")), n > 50) for i, t in enumerate(texts)]
    assert sorted(map(tuple, got)) == want


def test_whole_tokens_are_proven():
    v = token_counts.Vocabulary(MODEL)
    assert len(v.whole) > 30_000 and all(merge(list(p), v.rank) == [p] for p in list(v.whole)[:500])


def test_memory_is_bounded(monkeypatch):
    v = token_counts.Vocabulary(MODEL)
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    c = token_counts.Counter(v)
    rng = random.Random(1)
    for _ in range(200):
        c.tokens("".join(rng.choices("abcdefgh", k=12)))
    assert len(c) <= len(v.whole) + 12


def test_both_merges_agree():
    v = token_counts.Vocabulary(MODEL)
    rng = random.Random(2)
    for _ in range(50):
        s = [rng.choice("abcdethinorsy▁") for _ in range(200)]
        assert merge(s, v.rank) == _merge_short(list(s), v.rank)


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 512), (200, 40), (64, 16)])
def test_ids_and_bytes_equal_the_library(spark, texts, tik, chunk, overlap):
    got = {r["doc_id"]: r for r in bpe.encode(docs(spark, enumerate(texts)), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = b"".join(x.to_bytes(4, "little") for x in tik.encode_ordinary(t or ""))
        assert bytes(got[i]["ids"]) == ids, repr((t or "")[:80])
        assert bytes(got[i]["decoded"]) == (t or "").encode()


def test_digests_and_repeated_rows(spark, tik):
    rows = [(1, "one two"), (1, "one two"), (1, "y " * 300), (None, "z"), (1, "y " * 300)]
    got = bpe.encode_digests(docs(spark, rows), RANKS, public_tokenizers.PATTERN, chunk=100, overlap=20).collect()
    want = [(i, len(ids := tik.encode_ordinary(t)), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_tables_and_other_columns(spark):
    one = spark.createDataFrame([(7, "a b", 1, 2)], "doc_id long, text string, id long, n_tokens long")
    assert token_counts.count_tokens(one, MODEL, 1).collect()[0]["n_tokens"] == 2
    assert [r["n_tokens"] for r in bpe.encode_digests(one, RANKS, public_tokenizers.PATTERN).collect()] == [2]
    assert token_counts.count_tokens(one.limit(0), MODEL, 1).count() == bpe.encode(one.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
