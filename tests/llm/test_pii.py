import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import pii
from tests.llm.helpers import docs

BASE = [(re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda v: True), (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda v: all(int(p) <= 255 for p in v.split("."))),
        (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda v: 16 <= len(pii._digits(v)) <= 19 and pii.luhn(pii._digits(v))), (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda v: 8 <= len(pii._digits(v)) <= 15)]


def brute(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m[0])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b@c", "@", ".", "d.e", "1.2.3.4", "255", "256.1.1.1", "4539148803436467", "4539 1488", "-", " ", "+1 ", "(212) ", "555-0187", "\n", "é", "0", "%x"]), max_size=14))
def test_base_spans(parts):
    assert pii.base_spans("".join(parts)) == brute("".join(parts))


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 200_000 + " " + "a" * 200_000 + "@" + "@" * 1000) == []


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    m = pii.Tagger()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    ids, tags = rng.integers(0, pii.CLASSES, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    loss, grad = m.gradients(ids, tags)
    for name, values in m.p.items():
        at = tuple(rng.integers(0, n) for n in values.shape)
        if name[0] == "x":
            at = (int(ids[0, 2]), at[1])
        old = values[at]
        values[at] = old + 1e-3
        up = m.gradients(ids, tags)[0]
        values[at] = old - 1e-3
        down = m.gradients(ids, tags)[0]
        values[at] = old
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3, name


def test_viterbi_is_the_best_path():
    import itertools

    m = pii.Tagger()
    rng = np.random.default_rng(1)
    m.p["move"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    ids = rng.integers(0, pii.CLASSES, (1, 4))
    e = m.emissions(ids)[0]
    score = lambda p: sum(e[t, k] for t, k in enumerate(p)) + sum(m.p["move"][a, b] for a, b in zip(p, p[1:]))
    best = max(itertools.product(range(pii.TAGS), repeat=4), key=score)
    assert tuple(m.decode(ids)[0]) == best


def test_held_out_accuracy(spark, model):
    rows = [r[0] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 5000").select("text").collect()]
    samples = [s for t in rows for s in pii.samples_of(t)]
    ids, tags = pii.training_set(samples, seed=77)
    got = model.decode(ids)
    assert (got == tags).mean() > 0.96 and (got == tags)[tags > 0].mean() > 0.8
    # whole spans of each kind, not only tags of all kinds together
    for kind, name in enumerate(pii.KINDS):
        want = [(n, x) for n, t in enumerate(tags) for x in pii.read_tags(t) if x[0] == kind]
        found = {(n, x) for n, t in enumerate(got) for x in pii.read_tags(t)}
        assert len(want) > 100 and np.mean([w in found for w in want]) > 0.75, name
    # nothing is added to clean texts
    clean = [t for t in rows if not pii.base_spans(t)][:1500]
    assert sum(map(len, pii.added_spans(clean, [[] for _ in clean], model))) <= 2


def test_regions_windows_and_reconciling():
    text = "x" * 100 + "7" * 150 + "y" * 100
    (a, b), = pii.regions(text)
    assert (a, b) == (100 - pii.REACH, 250 + pii.REACH)
    at = pii.starts(a, b)
    assert at[0] == a and at[-1] + pii.WIDTH >= b and all(y - x == pii.WIDTH // 2 for x, y in zip(at, at[1:]))
    tags = np.array([[s // (pii.WIDTH // 2)] * pii.WIDTH for s in at])
    merged = pii.reconcile(a, b, at, tags)
    assert (np.diff(merged) >= 0).all() and len(merged) == b - a and set(merged) == {t[0] for t in tags}
    assert pii.read_tags(np.array([0, 1, 2, 2, 0, 2, 3, 4, 1])) == [(0, 1, 4), (0, 5, 6), (1, 6, 8), (0, 8, 9)]


def test_added_spans_keep_base_and_form(spark, model):
    texts = ["Call (212) 555-0187 now.", "+1 (826) 555-4081 190.137.223.204", "plain", "", None, "2024-03-04 12:30 v1.2.3 deadbeef00112233"]
    rows = {r["doc_id"]: r for r in pii.find(docs(spark, [*enumerate(texts), (0, texts[0])]).limit(100), model).collect()}
    for i, t in enumerate(texts):
        base, spans = brute(t or ""), [s for s in rows[i]["spans"].split(",") if s]
        assert {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base} <= set(spans)
        places = [tuple(map(int, s.split(":")[1:])) for s in spans if s not in {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base}]
        assert not any(a < e and s < b for a, b in places for _, s, e in base)
    assert rows[5]["spans"] == rows[2]["spans"] == rows[4]["spans"] == ""


class _Lines:
    """Tags every line as an address."""

    def decode(self, ids):
        return np.where((ids == pii._class("\n")) | (ids == pii.PAD), 0, 2)


def test_no_span_ends_because_its_region_does():
    long = "local-part." * 30 + "name [at] " + "department [dot] " * 20 + "edu"
    for address in ("jane (at) mathematics [dot] university [dot] edu", "a.very-long.local_part.of.an.address(at)b.org", long, "x" * 500 + " (at) b.c"):
        for text in (address, f"word\n{address}\nword 7 word\n{address}\n" + "word " * 50):
            got = pii.added_spans([text], [[]], _Lines())[0]
            assert [text[s:e] for _, s, e in got] == [address] * text.count(address)
    # a span beyond what the regions foresee: they grow until it ends
    text = "word\n" + "y" * 300 + "@" + "d." * 200 + "e\n" + "word " * 50
    assert [text[s:e] for _, s, e in pii.added_spans([text], [[]], _Lines())[0]] == [text.split("\n")[1]]
    assert pii.regions("z" * 90 + "(at)" + "q" * 90 + " 5") == [(90 - 90, 90 + 4 + 90 + 2)]


def test_long_spelled_out_addresses(model):
    address = "jane (at) mathematics [dot] university [dot] edu"
    text = f"The words before it. Write to {address} for more of them."
    assert [text[s:e] for _, s, e in pii.added_spans([text], [[]], model)[0]] == [address]


def test_recall_of_spelled_out_addresses(spark, model):
    """Addresses in texts, read as ``find`` reads them."""
    rng = np.random.default_rng(123)
    words = [w for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(40).collect() for w in r.text.split() if w.isalpha()]
    found = total = 0
    for i in range(120):
        address, s, e = pii.variant(0, f"some.name@host{i}.org", rng)
        if "@" in address:
            continue
        lead = " ".join(rng.choice(words, 9))
        text = f"{lead} {address[s:e]} {' '.join(rng.choice(words, 9))}."
        total += 1
        found += (0, len(lead) + 1, len(lead) + 1 + e - s) in pii.added_spans([text], [[]], model)[0]
    assert total > 60 and found / total > 0.8


def test_nothing_to_learn(spark):
    d = docs(spark, [(1, "no such thing"), (None, None), (2, "n 5")])
    assert pii.train(d) is None and pii.train(d.limit(0)) is None
    assert [r["spans"] for r in pii.find(d, None).collect()] == ["", "", ""] and pii.find(d.limit(0), None).count() == 0
