import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfcast.llm import alignment
from tests.llm.helpers import docs

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a", "a  ", "\u2581x", "a\nb\r\n\tc", "\u65e5\u672c\u8a9e \u0442\u0435\u043a\u0441\u0442 \u00fcn\u00ef", "<s> </s> <|endoftext|> <0x41>", "\x00\x01",
       "x" * 3000, "ab " * 2000, "don't we'll 12345 !?!  \n\n  end", "\U0001f600\U0001f468\u200d\U0001f469", " " * 700, "\n" * 400, "\u00e9" * 900, "9" * 5000, "<unk>"]


@pytest.fixture(scope="module")
def plain_tokens():
    """``text -> (A ids, A bytes, B ids, B bytes)`` by the libraries themselves."""
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    to_byte, strings = alignment._byte_alphabet(), {i: t for t, i in a.get_vocab().items()}

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        pieces = [b.id_to_piece(i) for i in ids_b]
        return (ids_a, [bytes(to_byte[c] for c in strings[i]) for i in ids_a],
                ids_b, [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(ids_b, pieces)])

    return tokens


def groups_of(text, tokens):
    if not text:
        return []
    ids_a, bytes_a, ids_b, bytes_b = tokens(text)
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, start = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        out.append(([i for i, e in zip(ids_a, ends_a) if start < e <= cut], [i for i, e in zip(ids_b, ends_b) if start < e <= cut]))
        start = cut
    return out


def plain(rows, tokens):
    linked = [(i, g := groups_of(t, tokens), Counter((a, b) for x, y in g for a in x for b in y)) for i, t in rows]
    count = Counter(pair for _, _, links in linked for pair in links)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, groups, links in linked:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(map(repr, out))


@pytest.mark.parametrize(("block", "lane"), [(4 << 20, 128), (3000, 7), (1, 1)])
def test_equals_plain_alignment(spark, sf_small, plain_tokens, monkeypatch, block, lane):
    texts = [r[0] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").limit(40).collect()]
    rows = list(enumerate(ODD + [t if t is None else t[:600] for t in texts])) + [(3, "  a"), (None, "one two")]
    monkeypatch.setattr(alignment, "LANE", lane)
    got = alignment.linked(docs(spark, rows).repartition(3), A_FILE, B_FILE, block=block).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(rows, plain_tokens)


@pytest.mark.parametrize("lane", [1, 5, 128])
def test_positions_within_documents(plain_tokens, monkeypatch, lane):
    """Alignment itself (in this process, so that the setting holds)."""
    monkeypatch.setattr(alignment, "LANE", lane)
    texts = [t and t[:400] for t in ODD] + ["several words \u00e9\u65e5 of a text " * 9]
    m = alignment.Aligned(texts, *alignment.sides(A_FILE, B_FILE))
    links = Counter()
    for d, a, b, n in zip(m.link_of, m.link_a, m.link_b, m.link_n):
        links[int(d), int(a), int(b)] += int(n)
    want = Counter((d, a, b) for d, t in enumerate(texts) for x, y in groups_of(t, plain_tokens) for a in x for b in y)
    assert links == want


def test_large_groups_are_counted(monkeypatch, plain_tokens):
    monkeypatch.setattr(alignment, "MANY", 1)
    texts = ["\u00e9\u0436\U0001f600 unhappily 12345 antidisestablishmentarianism" * 3]
    m = alignment.Aligned(texts, *alignment.sides(A_FILE, B_FILE))
    of, pair, n = m.by_document(32_000)
    want = Counter(a * 32_000 + b for x, y in groups_of(texts[0], plain_tokens) for a in x for b in y)
    assert dict(zip(pair.tolist(), n.tolist())) == want and set(of.tolist()) == {0}


def test_library_encodes_what_ranks_do(monkeypatch):
    side = alignment.sides(A_FILE, B_FILE)[0]
    assert side.quick is not None
    monkeypatch.setattr(alignment.ByteLevel, "_same_by_ranks", staticmethod(lambda *_: None))
    library = alignment.ByteLevel(A_FILE)
    texts = [" " + t for t in ODD if t]
    assert library.quick is None and not library.spells
    assert [x.tolist() for x in side.ids(texts)] == [x.tolist() for x in library.ids(texts)]


def test_cuts_of_align(spark, plain_tokens):
    rows = [(1, "several unhappily aligned words"), (2, None), (3, "\u2581"), (4, "more of them 123")]
    got = {r["doc_id"]: r for r in alignment.align(docs(spark, rows), A_FILE, B_FILE).collect()}
    for i, t in rows:
        want, r = groups_of(t, plain_tokens), got[i]
        cuts = list(zip([0, *r["a_cuts"]], r["a_cuts"], [0, *r["b_cuts"]], r["b_cuts"]))
        assert [(r["a_ids"][a:b], r["b_ids"][c:d]) for a, b, c, d in cuts] == want


def test_empty_table_and_clashing_columns(spark, plain_tokens):
    df = spark.createDataFrame([(7, "a b", 1, 2, 3)], "doc_id long, text string, id long, block long, pairs long")
    assert sorted(repr(tuple(r)) for r in alignment.linked(df, A_FILE, B_FILE).collect()) == plain([(7, "a b")], plain_tokens)
    assert alignment.linked(df.limit(0), A_FILE, B_FILE).count() == alignment.align(df.limit(0), A_FILE, B_FILE).count() == 0
