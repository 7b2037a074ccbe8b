"""Personal data: base patterns, and a character-level bidirectional LSTM with
CRF transitions that adds spans.

Base spans (email, ip, card, phone) come from fixed patterns over the whole
text.  The model reads classes of characters, runs an LSTM in each direction
and scores tags (none; begin and inside of each kind) whose sequence a linear
chain CRF decides.  It is written and trained in numpy.

Training: from the documents with the smallest hashes of their ids, ``SAMPLE``
at most, come windows around base spans and around other places with digits;
base spans label the windows.  Copies of them get the span replaced by other
spellings of its kind (phones without a plus, cards behind other numbers,
addresses spelled out, with domains of several parts) and, as counter-examples, by dates, versions, hexadecimal
strings and long numbers.  ``WINDOWS`` bounds the set, as do ``PER_KIND`` spans of a kind from a document
and ``GATHERED`` spans for each sampled document on average.  Without base spans
in the sample nothing is learned and only base spans are returned.  Weights
and sums are of double precision.

Finding: an added span must hold a digit, an ``@`` or a bracketed ``at``, so
every such place opens a region of ``REACH`` characters around it, and around
the address that goes on from a bracketed ``at``; regions that touch are one.
Regions are read in windows of ``WIDTH`` characters that overlap by half and
may reach beyond the region.  Each window is decoded; then each character takes
its tag from the window in which it lies farthest from an edge, and spans are
read from the reconciled tags of the whole region.  A region whose span touches
its edge is made longer, by steps that double, and read again, so no span ends
because the region does.  An added span must have the
form of its kind (a valid check sum, octets, a number of digits) and may not
touch a base span.

A null or empty text has no spans.  Rows are independent: repeated rows and
ids give repeated rows, an empty table an empty one; other columns are
ignored.  Texts of any length are read whole; time is linear in their length.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import by_batch

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4_096
WINDOWS = 2_304
PER_KIND, GATHERED = 4, 8
WIDTH, REACH = 64, 24
HIDDEN, EPOCHS, BATCH, RATE = 20, 12, 64, 0.02
READ_AT_ONCE = 512

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PLACE = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]+ ?[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?)[A-Za-z0-9-]+)+")
_SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?)[A-Za-z0-9-]+)*")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and start."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if not re.search("[0-9]", text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() < 64 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def well_formed(kind: int, value: str) -> bool:
    """Whether an added span has the form of its kind."""
    d = _digits(value)
    if kind == 0:
        return bool(_SPELLED.fullmatch(value)) or "@" in value and bool(_DOMAIN.fullmatch(value.rpartition("@")[2]))
    if kind == 1:
        return bool(_IP.fullmatch(value)) and all(len(p) <= 3 and int(p) <= 255 for p in value.split("."))
    if kind == 2:
        return 13 <= len(d) <= 19 and bool(re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", value)) and luhn(d) and len(set(d)) > 2
    return 9 <= len(d) <= 15 and bool(re.fullmatch(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])+", value)) and len(re.findall(r"[ ().-]+", value)) >= 2


# -- characters and tags ------------------------------------------------------

_MARKS = " \n@.-_%+()[]{}:/=\"',#*|"
PAD, DIGIT, LOWER, UPPER, LETTER, OTHER = range(6)
CLASSES = 6 + len(_MARKS)
TAGS = 1 + 2 * len(KINDS)


def _class(c: str) -> int:
    if (n := _MARKS.find(c)) >= 0:
        return 6 + n
    return DIGIT if c in "0123456789" else LOWER if "a" <= c <= "z" else UPPER if "A" <= c <= "Z" else LETTER if c.isalpha() else OTHER


class _Codes(dict):
    def __missing__(self, c: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[c] = n = _class(c)
        return n


_codes = _Codes()


def encoded(window: str) -> np.ndarray:
    out = np.zeros(WIDTH, np.int64)
    out[: len(window)] = [_codes[c] for c in window]
    return out


# -- the network --------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Parameters, forward pass, gradients and decoding."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float64)
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = draw(CLASSES, 4 * HIDDEN, by=0.3)
            self.p[f"h{d}"] = draw(HIDDEN, 4 * HIDDEN, by=HIDDEN**-0.5)
            bias = np.zeros(4 * HIDDEN, np.float64)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.p[f"c{d}"] = bias
        self.p["out"] = draw(2 * HIDDEN, TAGS, by=0.2)
        self.p["bias"] = np.zeros(TAGS, np.float64)
        self.p["move"] = np.zeros((TAGS, TAGS), np.float64)

    def _direction(self, ids: np.ndarray, d: str, keep: bool):
        """Hidden states of one direction, and what its gradient needs."""
        n, width = ids.shape
        x, wh = self.p[f"x{d}"][ids] + self.p[f"c{d}"], self.p[f"h{d}"]
        h = c = np.zeros((n, HIDDEN), np.float64)
        hidden, kept = np.empty((n, width, HIDDEN), np.float64), []
        for t in range(width) if d == "f" else range(width - 1, -1, -1):
            a = x[:, t] + h @ wh
            gates = _sigmoid(a[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(a[:, 3 * HIDDEN :])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hidden[:, t] = h
            if keep:
                kept.append((t, i, f, o, g, before, tc, h_before))
        return hidden, kept

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._direction(ids, d, False)[0] for d in "fb"], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags, and its gradients."""
        n, width = ids.shape
        runs = {d: self._direction(ids, d, True) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        e, move = both @ self.p["out"] + self.p["bias"], self.p["move"]

        def lse(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, width):
            alpha[:, t] = e[:, t] + lse(alpha[:, t - 1, :, None] + move, 1)
        for t in range(width - 2, -1, -1):
            beta[:, t] = lse(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        grad = {}
        de = np.exp(alpha + beta - z[:, None, None])
        pair = np.exp(alpha[:, :-1, :, None] + move + (e + beta)[:, 1:, None, :] - z[:, None, None, None]).sum((0, 1))
        np.add.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        grad["move"] = pair / n
        row, col = np.indices(tags.shape)
        gold = e[row, col, tags].sum(1) + move[tags[:, :-1], tags[:, 1:]].sum(1)
        de[row, col, tags] -= 1
        de /= n
        grad["out"] = both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        grad["bias"] = de.sum((0, 1))
        dboth = de @ self.p["out"].T
        one_hot = np.eye(CLASSES, dtype=np.float64)[ids.ravel()]
        for k, d in enumerate("fb"):
            dh_out, wh = dboth[:, :, k * HIDDEN : (k + 1) * HIDDEN], self.p[f"h{d}"]
            da = np.empty((n, width, 4 * HIDDEN), np.float64)
            dh = dc = np.zeros((n, HIDDEN), np.float64)
            dwh = np.zeros_like(wh)
            for t, i, f, o, g, before, tc, h_before in reversed(runs[d][1]):
                dh = dh + dh_out[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                a = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                da[:, t] = a
                dwh += h_before.T @ a
                dh, dc = a @ wh.T, dc * f
            grad[f"h{d}"], grad[f"c{d}"] = dwh, da.sum((0, 1))
            grad[f"x{d}"] = one_hot.T @ da.reshape(-1, 4 * HIDDEN)
        return float((z - gold).mean()), grad

    def fit(self, ids: np.ndarray, tags: np.ndarray, seed: int = 5) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        total = EPOCHS * -(-len(ids) // BATCH)
        for _ in range(EPOCHS):
            order, loss = rng.permutation(len(ids)), []
            for at in range(0, len(ids), BATCH):
                some = order[at : at + BATCH]
                value, grad = self.gradients(ids[some], tags[some])
                loss.append(value)
                step += 1
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                rate = RATE * (1 - 0.9 * step / total)
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(size, 1e-6))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float64)
            losses.append(float(np.mean(loss)))
        return losses

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The most probable tags of each window."""
        e, move = self.emissions(ids), self.p["move"]
        n, width, _ = e.shape
        score, back = e[:, 0], np.empty((n, width, TAGS), np.int8)
        for t in range(1, width):
            every = score[:, :, None] + move
            back[:, t] = every.argmax(1)
            score = every.max(1) + e[:, t]
        tags = np.empty((n, width), np.int64)
        tags[:, -1] = score.argmax(1)
        rows = np.arange(n)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        return tags


# -- windows ------------------------------------------------------------------


def regions(text: str) -> list[tuple[int, int]]:
    """Maximal stretches within ``REACH`` of a place that can open a span, or
    of the spelled-out address it is in."""
    out: list[tuple[int, int]] = []
    for m in _PLACE.finditer(text):
        a, b = m.span()
        if b - a > 1:
            a -= text[a - 1 : a] == " "
            while a and text[a - 1] in _LOCAL:
                a -= 1
            b = d.end() if (d := _SPELLED_DOMAIN.match(text, b)) else b
        a, b = max(0, a - REACH), min(len(text), b + REACH)
        while out and a <= out[-1][1]:
            a, b = min(a, out[-1][0]), max(b, out.pop()[1])
        out.append((a, b))
    return out


def starts(a: int, b: int) -> list[int]:
    """Starts of the overlapping windows of a region."""
    out = [a]
    while out[-1] + WIDTH < b:
        out.append(out[-1] + WIDTH // 2)
    return out


def reconcile(a: int, b: int, at: list[int], tags: np.ndarray) -> np.ndarray:
    """One tag for each character, from the window whose edges are farthest."""
    out, depth = np.zeros(b - a, np.int64), np.full(b - a, -1)
    inner = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])
    for start, window in zip(at, tags):
        n = min(WIDTH, b - start)
        own = inner[:n].copy()
        if start == a:
            own[: WIDTH // 2] = WIDTH  # nothing of the region lies before
        if start + WIDTH >= b:
            own[max(0, n - WIDTH // 2) :] = WIDTH
        part = slice(start - a, start - a + n)
        better = own > depth[part]
        out[part][better], depth[part][better] = window[:n][better], own[better]
    return out


def read_tags(tags: np.ndarray) -> list[Span]:
    """Spans of begin and inside tags; an inside tag without its begin starts one."""
    out: list[Span] = []
    kind = start = -1
    for i, t in enumerate([*tags.tolist(), 0]):
        if kind >= 0 and t != 2 + 2 * kind:
            out.append((kind, start, i))
            kind = -1
        if t and kind < 0:
            kind, start = (t - 1) // 2, i
    return out


Part = tuple[int, int, np.ndarray | None]  # a region, and its tags once they are read


def _read_parts(texts: list[str], jobs: list[tuple[int, int, int]], model: Tagger) -> list[np.ndarray]:
    """The reconciled tags of regions ``(text, start, end)``."""
    at = [starts(a, b) for _, a, b in jobs]
    where = [(n, s) for (n, *_), some in zip(jobs, at) for s in some]
    tags = np.empty((len(where), WIDTH), np.int64)
    for i in range(0, len(where), READ_AT_ONCE):
        some = range(i, min(i + READ_AT_ONCE, len(where)))
        tags[i : i + READ_AT_ONCE] = model.decode(np.stack([encoded(texts[where[k][0]][where[k][1] : where[k][1] + WIDTH]) for k in some]))
    out, i = [], 0
    for (_, a, b), some in zip(jobs, at):
        out.append(reconcile(a, b, some, tags[i : i + len(some)]))
        i += len(some)
    return out


def _longer(parts: list[Part], length: int, step: int) -> list[Part]:
    """The regions of a text, those with a span at an edge longer by ``step``
    and joined with what they reach; these have to be read again."""
    out: list[Part] = []
    for a, b, tags in parts:
        left, right = max(0, a - step) if tags[0] else a, min(length, b + step) if tags[-1] else b
        if (left, right) != (a, b):
            tags = None
        while out and left <= out[-1][1]:
            other = out.pop()
            left, right, tags = min(left, other[0]), max(right, other[1]), None
        out.append((left, right, tags))
    return out


def added_spans(texts: list[str], base: list[list[Span]], model: Tagger) -> list[list[Span]]:
    """The model's spans of each text that are well formed and touch no base span."""
    parts: list[list[Part]] = [[(a, b, None) for a, b in regions(text)] for text in texts]
    step = REACH
    unread = range(len(texts))
    while unread := [n for n in unread if any(tags is None for *_, tags in parts[n])]:
        read = iter(_read_parts(texts, [(n, a, b) for n in unread for a, b, tags in parts[n] if tags is None], model))
        for n in unread:
            parts[n] = _longer([(a, b, next(read) if tags is None else tags) for a, b, tags in parts[n]], len(texts[n]), step)
        step *= 2
    out: list[list[Span]] = [[] for _ in texts]
    for n, a, tags in ((n, a, tags) for n, some in enumerate(parts) for a, _, tags in some):
        for kind, s, e in read_tags(tags):
            s, e = s + a, e + a
            value = texts[n][s:e]
            trimmed = value.strip(" \n.,;:")
            s, e = s + value.find(trimmed), s + value.find(trimmed) + len(trimmed)
            if trimmed and well_formed(kind, trimmed) and not any(x < e and s < y for _, x, y in base[n]):
                if not re.match(r"[0-9]", texts[n][e : e + 1]) and not re.match(r"[0-9]", texts[n][s - 1 : s] if s else "") or kind == 0:
                    out[n].append((kind, s, e))
    return out


# -- training data ------------------------------------------------------------


def _number(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _card(rng: np.random.Generator) -> str:
    body = _number(rng, 15)
    return body + next(c for c in "0123456789" if luhn(body + c))


def _word(rng: np.random.Generator) -> str:
    return "".join("abcdefghijklmnopqrstuvwxyz"[i] for i in rng.integers(0, 26, int(rng.integers(2, 13))))


def variant(kind: int, value: str, rng: np.random.Generator) -> tuple[str, int, int]:
    """Another spelling of a value, and where the span lies in it."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == 0:
        local, _, domain = value.rpartition("@")
        parts = domain.split(".")
        if rng.random() < 0.6:  # domains of more parts, and local parts of one word, than the sample may have
            parts = [_word(rng) for _ in range(int(rng.integers(0, 3)))] + [_word(rng), pick("edu", "org", "com", "net", parts[-1])]
            local = pick(local, _word(rng), f"{_word(rng)}.{_word(rng)}", f"{_word(rng)}{_number(rng, 2)}")
        a, b = pick("()", "[]", "()", "{}")
        dotted, spelled = ".".join(parts), f" {a}dot{b} ".join(parts)
        new = pick(f"{local}@{dotted}", f"{local} {a}at{b} {dotted}", f"{local}{a}at{b}{dotted}", f"{local} {a}at{b} {spelled}", f"{local} {a}at{b} {spelled}")
    elif kind == 1:
        new = ".".join(str(x) for x in rng.integers(0, 256, 4))
    elif kind == 2:
        c = _card(rng)
        sep = pick("", " ", "-")
        new = sep.join(c[i : i + 4] for i in range(0, 16, 4))
        if rng.random() < 0.4:
            lead = _number(rng, int(rng.integers(1, 4))) + " "
            return lead + new, len(lead), len(lead) + len(new)
    else:
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        new = pick(f"+{_number(rng, 1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{_number(rng, 2)} {a} {b} {c}", f"{a} {b} {c}")
    return new, 0, len(new)


def other(rng: np.random.Generator) -> str:
    """Something with digits that is no personal data."""
    hexed = lambda n: "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, n))
    kinds = (lambda: f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}", lambda: f"{rng.integers(0, 9)}.{rng.integers(0, 20)}.{rng.integers(0, 50)}",
             lambda: hexed(int(rng.integers(12, 48))), lambda: _number(rng, int(rng.integers(1, 12))), lambda: f"{rng.integers(0, 999)},{_number(rng, 3)}.{_number(rng, 2)}",
             lambda: f"{rng.integers(0, 24):02d}:{rng.integers(0, 60):02d}:{rng.integers(0, 60):02d}", lambda: f"{rng.integers(1, 99)} {rng.integers(1, 99)} {rng.integers(1, 999)}", lambda: f"#{_number(rng, 6)}")
    return kinds[int(rng.integers(len(kinds)))]()


def _example(before: str, value: str, after: str, kind: int | None, s: int, e: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A window with the value at a random place, and its tags."""
    if kind is not None and e - s > WIDTH // 2 and rng.random() < 0.4:
        # as a window that starts, or starts again, within a long span
        cut = int(rng.integers(1, e - s - 8))
        value, before = value[s + cut :], ""
        tags = np.zeros(WIDTH, np.int64)
        tags[: e - s - cut] = 2 + 2 * kind
        return encoded((value + after)[:WIDTH]), tags
    lead = int(rng.integers(0, max(1, WIDTH - min(len(value), WIDTH - 8))))
    before = before[len(before) - min(lead, len(before)) :]
    if rng.random() < 0.15:  # as at the end of a text
        after = after[: int(rng.integers(0, 12))]
    tags = np.zeros(WIDTH, np.int64)
    if kind is not None:
        a, b = len(before) + s, min(WIDTH, len(before) + e)
        tags[a + 1 : b] = 2 + 2 * kind
        if a < WIDTH:
            tags[a] = 1 + 2 * kind
    return encoded((before + value + after)[:WIDTH]), tags


def training_set(samples: list[tuple[int | None, str, str, str]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags from ``(kind or None, before, value, after)``."""
    rng = np.random.default_rng(seed)
    spans = {k: [s for s in samples if s[0] == k] for k in range(len(KINDS))}
    known = [k for k in spans if spans[k]]
    none = [s for s in samples if s[0] is None]
    out = []
    clean = lambda s: re.sub(r"[0-9@]", "", s)  # noqa: E731  other spans near by have no label here
    for i in range(WINDOWS if known else 0):
        draw = rng.random()
        kind, before, value, after = (s := spans[known[i % len(known)]])[int(rng.integers(len(s)))]
        if draw < 0.2 and none:
            _, before, value, after = none[int(rng.integers(len(none)))]
            out.append(_example(clean(before), value, clean(after), None, 0, 0, rng))
        elif draw < 0.4:
            out.append(_example(clean(before), other(rng), clean(after), None, 0, 0, rng))
        elif draw < 0.55:
            out.append(_example(clean(before), value, clean(after), kind, 0, len(value), rng))
        else:
            new, s, e = variant(kind, value, rng)
            out.append(_example(clean(before), new, clean(after), kind, s, e, rng))
    if not out:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64)
    return np.stack([x for x, _ in out]), np.stack([t for _, t in out])


def samples_of(text: str) -> list[tuple[int | None, str, str, str]]:
    """Base spans and other places with digits, with what surrounds them."""
    base = base_spans(text)
    out = [(k, text[max(0, s - WIDTH) : s], text[s:e], text[e : e + WIDTH]) for k, s, e in base if e - s < WIDTH - 8]
    for m in re.finditer(r"[A-Za-z0-9]*[0-9][A-Za-z0-9]*", text):
        s, e = m.span()
        # digits of a card's number look like one, whatever their check sum says
        if not any(x < e and s < y for _, x, y in base) and e - s < WIDTH - 8 and not re.fullmatch("[0-9]{13,19}", m[0]):
            out.append((None, text[max(0, s - WIDTH) : s], m[0], text[e : e + WIDTH]))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """A tagger from at most ``sample`` documents, or None without base spans."""
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    few = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(ids), "_id", "left_semi")

    def gather(batch: pa.RecordBatch) -> dict[str, list]:
        # at most a few of each kind and document, and so of all: this is a bounded sample
        found = [x for t in batch.column("_text").to_pylist() for k in (*range(len(KINDS)), None) for x in [s for s in samples_of(t) if s[0] == k][:PER_KIND]]
        return {"kind": [s[0] for s in found]} | {name: [s[i] for s in found] for i, name in ((1, "before"), (2, "value"), (3, "after"))}

    rows = by_batch(few, gather, "kind int, before string, value string, after string")
    rows = rows.orderBy(F.xxhash64("before", "value", "after"), "before", "value", "after").limit(GATHERED * sample).collect()
    ids_, tags = training_set([tuple(r) for r in rows])
    if not len(ids_):
        return None
    model = Tagger()
    model.fit(ids_, tags)
    return model


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find(docs: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base spans' counts by kind, the digest of their list,
    and the list of all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    def scan(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").to_pylist()
        base = [base_spans(t) for t in texts]
        added = added_spans(texts, base, shared.value) if shared.value else [[] for _ in texts]
        return {"id": batch.column("id"), "base_sha256": [hashlib.sha256(listed(b).encode()).hexdigest() for b in base], "spans": [listed(b + a) for b, a in zip(base, added)]} | {
            f"n_{name}": [sum(k == n for k, *_ in b) for b in base] for n, name in enumerate(KINDS)}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id long, " + ", ".join(f"n_{name} long" for name in KINDS) + ", base_sha256 string, spans string"
    return by_batch(rows, scan, schema).withColumnRenamed("id", id_col)
