"""Personal data by a skip-chain conditional random field.

Tokens (what white space separates) that hold a digit or `@`, and the two tokens at either side of each, are variables with a label each: none, email, ip,
card or phone. Neighbours are tied by a chain. Tokens of the same text that the chain doesn't tie are tied by skip edges, in one segment or in two: each to the next
that is equal, or else to the next of equal shape and beginning, so a label that one place makes certain carries over to the others.
Loopy sum-product message passing over both kinds of edges, until messages settle, gives each token's marginals. Every other token is taken as observed to be none.

The weights (features, transitions and the two kinds of skip edges) are fitted by pseudo-likelihood on sentences from a seeded generator, on
the driver, at the first use in a session: a model of a few hundred numbers, the same whatever table is read. `Training` holds all parameters.

Base rules find what is certain; their spans stay as they are. The field adds spans where it finds an entity: base spans are cut out of a run
of tokens of one label, and what is left is added. What a base span leaves of a token (a port, a bracket, or another entity) is added only if
the model gives it that label by itself, without neighbours. Null
and empty texts have no spans. Repeated rows each have the same spans. Work is linear in the text, whatever it holds.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import put, small_batches, text_udf

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = str.maketrans("", "", " ().+-")


def luhn(digits: str) -> bool:
    twice = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in twice)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """From each `@` on: the name reaches back to the last character that can't be in one, the last match or the last `@`; the host is read once ahead. No character
    is read more than twice, whatever the runs are."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _IN_NAME:
            begin -= 1
        host = _HOST.match(text, at + 1) if begin < at else None
        if host:
            found.append((begin, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    return found


_IN_NAME = frozenset(chr(i) for i in range(128) if re.match(r"[A-Za-z0-9._%+-]", chr(i)))
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_EMAIL_FAST = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end), by kind and then start."""
    spans = []
    if "@" in text:
        spans += [(0, *s) for s in _emails(text)]
    spans += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].translate(DIGITS)) <= 19 and luhn(d):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(m[0].translate(DIGITS)) <= 15]
    return spans


# ---------------------------------------------------------------- tokens, features, edges

TRIGGER = re.compile(r"[0-9@]+")
WORD = re.compile(r"\S+")
EDGE = ".,;:!?\"'()[]{}<>|*#$%&="
SIDE = 2  # tokens at either side

#: Words that tell of a kind, as features of the tokens near them.
CUES = (
    frozenset(["mail", "email", "e-mail", "contact", "write"]),
    frozenset(["ip", "host", "server", "ping", "addr", "node"]),
    frozenset(["card", "visa", "credit", "payment", "account"]),
    frozenset(["phone", "tel", "call", "fax", "mobile", "telephone", "ring"]),
    frozenset(["version", "v", "license", "licence", "release", "section", "chapter", "page", "order", "id", "year", "token", "password", "secret"]),
)
BINS = (0, 1, 4, 5, 8, 11, 16, 20)
SETTLED = 1e-5  # a message that changes by less isn't passed on


def tokens(text: str) -> list[list[tuple[int, int]]]:
    """Segments of adjacent tokens (start, end): each token with a trigger, and two tokens at either side, whatever their lengths."""
    found: list[tuple[int, int]] = []  # in order and distinct
    end = 0  # of the last token with a trigger

    def before(at: int, floor: int) -> tuple[int, int] | None:
        """The last token that ends before `at` and begins at `floor` or later."""
        while at > floor and text[at - 1].isspace():
            at -= 1
        stop = at
        while at > floor and not text[at - 1].isspace():
            at -= 1
        return (at, stop) if at < stop else None

    ahead: list[tuple[int, int]] = []  # the tokens after the last trigger's
    for m in TRIGGER.finditer(text):
        if m.start() < end:
            continue
        begin = m.start()
        while begin > end and not text[begin - 1].isspace():
            begin -= 1
        floor = found[-1][1] if found else 0
        for t in ahead:
            if t[0] < begin:
                found.append(t)
                floor = t[1]
        left: list[tuple[int, int]] = []
        while len(left) < SIDE and (t := before(left[-1][0] if left else begin, floor)):
            left.append(t)
        found += left[::-1]
        end = WORD.match(text, begin).end()
        found.append((begin, end))
        ahead, at = [], end
        while len(ahead) < SIDE and (w := WORD.search(text, at)):
            ahead.append(w.span())
            at = w.end()
            if TRIGGER.search(text, *w.span()):
                break  # that token comes with its own neighbours
    found += ahead
    out: list[list[tuple[int, int]]] = []
    for span in found:
        if out and text[out[-1][-1][1] : span[0]].isspace():
            out[-1].append(span)
        else:
            out.append([span])
    return out


def _shape(s: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "9", s))


def _own(word: str) -> list[float]:
    """Features of a token by itself."""
    w = word.strip(EDGE)
    digits = re.sub(r"[^0-9]", "", w)
    n, dots = len(digits), w.count(".")
    letters = sum(c.isalpha() for c in w)
    parts = w.split(".")
    return [
        1.0, float("@" in w), float(bool(_EMAIL_FAST.fullmatch(w))), *[float(a <= n < b) for a, b in zip(BINS, (*BINS[1:], 1 << 30), strict=True)],
        float(n > 0 and n == len(w)), float(letters > 0), float(letters > 0 and n > 0), float(letters > 3 * n), *[float(dots == k) for k in (1, 2, 3)], float(dots > 3),
        float(len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)), float("+" in word[:2]), float("(" in word or ")" in word), float("-" in w),
        float(bool(re.fullmatch(r"[0-9]{3,4}-[0-9]{4}", w))), float(bool(re.fullmatch(r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}", w))), float(bool(re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", w))), float(":" in w or "/" in w), float(16 <= n <= 19 and n >= len(w) - 3 and luhn(digits)), float("=" in word or '"' in word),
    ]


OWN = len(_own("x"))
FEATURES = OWN * 3 + 2 * len(CUES)


def features(words: list[str]) -> np.ndarray:
    """One row a token: its own features, those of its neighbours, and cues up to two tokens before and after."""
    own = np.array([_own(w) for w in words], np.float32)
    pad = np.zeros((1, OWN), np.float32)
    low = [w.strip(EDGE).lower() for w in words]
    cue = np.array([[float(w in c) for c in CUES] for w in low], np.float32)
    zero = np.zeros((2, len(CUES)), np.float32)
    back, ahead = np.concatenate([zero, cue]), np.concatenate([cue, zero])
    return np.concatenate([own, np.concatenate([pad, own[:-1]]), np.concatenate([own[1:], pad]), np.maximum(back[1:-1], back[:-2]), np.maximum(ahead[1:-1], ahead[2:])], axis=1)


def scores(words: list[str], weights: np.ndarray, block: int = 4096) -> np.ndarray:
    """features(words) @ weights, a block of tokens at a time."""
    out = []
    for at in range(0, len(words), block):
        first, last = max(0, at - 2), min(len(words), at + block + 2)
        out.append((features(words[first:last]) @ weights)[at - first : at - first + min(block, len(words) - at)])
    return np.concatenate(out)


def skips(words: list[str], segment: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Edges to the next equal token, and to the next of equal shape and first characters; those with a digit or `@` only. Tokens that the chain
    ties already (adjacent ones of a segment) are passed over for the one before, so that a run of equal tokens is tied too."""
    last: dict[str | tuple[str, str], tuple[int, int]] = {}  # the last two of each kind
    equal, alike = [], []
    for i, w in enumerate(words):
        w = w.strip(EDGE).lower()
        if len(w) < 3 or not TRIGGER.search(w):
            continue
        for key, into in ((w, equal), ((_shape(w), w[:3]), alike)):
            a, b = last.get(key, (-1, -1))
            j = a if b == i - 1 and b >= 0 and segment[b] == segment[i] else b
            if j >= 0:
                into.append((j, i))
                break
        for key in (w, (_shape(w), w[:3])):
            last[key] = (last.get(key, (-1, -1))[1], i)
    return equal, alike


# ---------------------------------------------------------------- training

@dataclass(frozen=True)
class Training:
    sentences: int = 1600
    seed: int = 7
    rounds: int = 150
    rate: float = 0.08
    shrink: float = 1e-3


SYLLABLES = "an re the ou st en tion er in ble ing au de pa ch ver ge lich os ci que mi".split()


def _sentence(r: random.Random) -> tuple[list[str], list[int]]:
    word = lambda: "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) + r.choice(["", "", "", ",", "."])
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = r.choice("3456") + d(r.choice([14, 14, 15]))
        return next(body + str(k) for k in range(10) if luhn(body + str(k)))

    def entity() -> tuple[list[str], int]:
        k = r.randint(1, 4)
        if k == 1:
            name = r.choice([word().strip(",."), word().strip(",.") + "." + d(2), word()[:3].strip(",.") + "_" + word().strip(",.")])
            host = r.choice(["mail" + d(1) + ".example.com", "example.org", word().strip(",.") + ".net"])
            return r.choice([[f"{name}@{host}"], [f"<{name}@{host}>"], [f"{name}@", host], [f"mailto:{name}@{host}"]]), k
        if k == 2:
            ip = ".".join(str(r.randint(1, 255)) for _ in range(4))
            return r.choice([[ip], [ip], [ip + ":" + d(4)], [ip + "/24"]]), k
        if k == 3:
            c = card()
            return r.choice([[c], [c[i : i + 4] for i in range(0, len(c), 4)], ["-".join(c[i : i + 4] for i in range(0, len(c), 4))]]), k
        a, b, c = d(3), d(3), d(4)
        return r.choice([[f"+{d(1)}", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"+{d(2)}", a, b, c], [f"{a}.{b}.{c}"], [f"+1{a}{b}{c}"]]), k

    def other() -> list[str]:
        return r.choice([
            lambda: [r.choice(["version", "Version", "v", "License,"]), d(1) + r.choice([".", ".0.", ".1", ".0.1"])], lambda: [f"20{d(2)}-0{r.randint(1, 9)}-1{d(1)}"], lambda: [d(r.randint(1, 4))], lambda: [d(2) + ":" + d(2)],
            lambda: ["token", "=", '"' + "".join(r.choice("0123456789abcdef") for _ in range(40)) + '"'], lambda: ["password=" + "".join(r.choice("0123456789abcdef") for _ in range(18))], lambda: ["AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))],
            lambda: ["$" + d(3) + "." + d(2)], lambda: [d(r.choice([5, 6, 7, 8, 9, 12, 13, 14, 20, 24]))], lambda: ["id", d(r.randint(4, 10))], lambda: ["@" + word().strip(",.")], lambda: ["CC", "BY-NC", "4.0."], lambda: [word().strip(",.") + d(2)], lambda: [d(1) + "." + d(1) + "." + d(1)], lambda: [x if not luhn(x := d(16)) else x[:-1]],
        ])()

    cue = {1: ["mail", "email", "contact"], 2: ["host", "server", "ip"], 3: ["card", "visa"], 4: ["phone", "tel", "call"]}
    words, labels = [], []
    kept: list[tuple[list[str], int]] = []
    for _ in range(r.randint(2, 5)):
        for _ in range(r.randint(2, 5)):
            words.append(word())
            labels.append(0)
        x = r.random()
        if x < 0.55:
            e, k = r.choice(kept) if kept and r.random() < 0.4 else entity()
            kept.append((e, k))
            if r.random() < 0.3:
                words.append(r.choice(cue[k]))
                labels.append(0)
            words += [*e[:-1], e[-1] + r.choice(["", "", ",", "."])]
            labels += [k] * len(e)
        elif x < 0.9:
            o = other()
            words += o
            labels += [0] * len(o)
    return words, labels


def sample(n: int, seed: int) -> list[tuple[list[str], list[int]]]:
    r = random.Random(seed)
    return [_sentence(r) for _ in range(n)]


def _edges(words: list[str], labels: list[int] | None = None) -> tuple[list, list, list]:
    """Chain, equal and alike edges of one sentence, of which every word is a variable."""
    run, segment = 0, []
    for i, w in enumerate(words):
        run += i > 0 and not TRIGGER.search(w) and not TRIGGER.search(words[i - 1])
        segment.append(run)
    return [(i, i + 1) for i in range(len(words) - 1)], *skips(words, segment)


@lru_cache(maxsize=4)
def train(t: Training = Training()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(weights of features, of transitions, of equal and of alike tokens), by pseudo-likelihood: each label given its neighbours' true ones."""
    x, y, edges, at = [], [], ([], [], []), 0
    for words, labels in sample(t.sentences, t.seed):
        x.append(features(words))
        y += labels
        for into, own in zip(edges, _edges(words), strict=True):
            into += [(a + at, b + at) for a, b in own]
        at += len(words)
    x, y = np.concatenate(x), np.array(y)
    k = len(LABELS)
    one = np.eye(k, dtype=np.float32)[y]
    pairs = [np.array(e, np.int64).reshape(-1, 2) for e in edges]
    w = [np.zeros((FEATURES, k), np.float32), *[np.zeros((k, k), np.float32) for _ in pairs]]
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for step in range(1, t.rounds + 1):
        z = x @ w[0]
        for p, m in zip(pairs, w[1:], strict=True):
            np.add.at(z, p[:, 1], m[y[p[:, 0]]])
            np.add.at(z, p[:, 0], m.T[y[p[:, 1]]])
        z -= z.max(axis=1, keepdims=True)
        q = np.exp(z)
        q /= q.sum(axis=1, keepdims=True)
        off = (q - one) / len(y)
        grads = [x.T @ off]
        for p in pairs:
            grads.append(one[p[:, 0]].T @ off[p[:, 1]] + off[p[:, 0]].T @ one[p[:, 1]])
        for i, g in enumerate(grads):
            g = g + t.shrink * w[i] / 100
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            w[i] = w[i] - t.rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(a.astype(np.float64) for a in w)


def marginals(unary: np.ndarray, edges: tuple[np.ndarray, ...], model: tuple[np.ndarray, ...], rounds: int = 200, owner: np.ndarray | None = None) -> np.ndarray:
    """Loopy sum-product from the tokens' scores until messages settle. A round sends those messages whose sender has changed, so a label goes
    as far as edges lead, and work follows what still changes. owner: the text of each token. A text whose messages don't settle
    (loops can swing) stops once its edges have sent `rounds` messages on average, which keeps work linear."""
    unary = unary - unary.max(axis=1, keepdims=True)
    a = np.concatenate([np.concatenate([e[:, 0], e[:, 1]]) for e in edges])
    b = np.concatenate([np.concatenate([e[:, 1], e[:, 0]]) for e in edges])
    back = np.concatenate([np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))]) + 2 * o for e, o in zip(edges, np.cumsum([0, *map(len, edges[:-1])]), strict=True)])
    tie = np.concatenate([np.concatenate([np.repeat(m[None], len(e), 0), np.repeat(m.T[None], len(e), 0)]) for e, m in zip(edges, model[1:], strict=True)])
    tie = np.exp(tie - tie.max(axis=(1, 2), keepdims=True))
    message = np.zeros((len(a), len(LABELS)))
    belief = unary.copy()
    owner = np.zeros(len(unary), np.int64) if owner is None else owner
    left = rounds * np.bincount(owner[a], minlength=int(owner.max(initial=0)) + 1)
    by_sender = np.argsort(a, kind="stable")
    degree = np.bincount(a, minlength=len(unary))
    first = np.cumsum(degree) - degree
    live = np.arange(len(a))
    while len(live):
        np.subtract.at(left, owner[a[live]], 1)
        out = belief[a[live]] - message[back[live]]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(np.einsum("ei,eij->ej", out, tie[live]) + 1e-30)
        new -= new.max(axis=1, keepdims=True)
        change = 0.7 * (new - message[live])
        message[live] += change
        np.add.at(belief, b[live], change)
        moved = live[np.abs(change).max(axis=1) > SETTLED]
        told = np.unique(b[moved])
        n = degree[told]
        onward = by_sender[np.repeat(first[told] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        live = np.union1d(moved, onward)
        live = live[left[owner[a[live]]] > 0]
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


# ---------------------------------------------------------------- whole texts

def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def uncut(run: list[tuple[int, int]], base: list[tuple[int, int]], fits: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """What disjoint, sorted base spans leave of a run of tokens: whole tokens, joined if adjacent, and those rests of tokens that fit."""
    out: list[tuple[int, int]] = []
    at, joined = bisect_right(base, run[0][0], key=lambda s: s[1]), False
    for b, e in run:
        rests, low = [], b
        while at < len(base) and base[at][1] <= b:
            at, joined = at + 1, False
        while at < len(base) and base[at][0] < e:
            rests.append((low, base[at][0]))
            low = base[at][1]
            if low > e:
                break
            at += 1
        if low > b or rests:
            rests = [s for s in [*rests, (low, e)] if s[0] < s[1] and fits(*s)]
        else:
            rests = [(b, e)]
        if joined and rests and rests[0][0] == b:
            out[-1] = (out[-1][0], rests.pop(0)[1])
        elif rests:
            out.append(rests.pop(0))
        else:
            joined = False
            continue
        out += rests
        joined = out[-1][1] == e
    return out


def label_runs(model: tuple[np.ndarray, ...], texts: list[str], sure: float) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(number of the text, label, spans of adjacent tokens that the field gives this label, with marginals of `sure` and more)."""
    spans, segment, owner, chain, equal, alike, rows = [], [], [], [], [], [], []
    for i, t in enumerate(texts):
        first, own = len(spans), []
        for s, seg in enumerate(tokens(t)):
            ws = [t[b:e] for b, e in seg]
            chain += [(len(spans) + j, len(spans) + j + 1) for j in range(len(seg) - 1)]
            rows.append(scores(ws, model[0]))
            spans += seg
            own += [(w, s) for w in ws]
        owner += [i] * len(own)
        e, a = skips([w for w, _ in own], [s for _, s in own])
        equal += [(first + u, first + v) for u, v in e]
        alike += [(first + u, first + v) for u, v in a]
        segment += [(i, s) for _, s in own]
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    if not spans:
        return out
    edges = tuple(np.array(e, np.int64).reshape(-1, 2) for e in (chain, equal, alike))
    p = marginals(np.concatenate(rows), edges, model, owner=np.array(owner))
    label = np.where(p.max(axis=1) >= sure, p.argmax(axis=1), 0)
    j = 0
    while j < len(spans):
        k, n = int(label[j]), j + 1
        if k:
            while n < len(spans) and segment[n] == segment[j] and label[n] == k:
                n += 1
            out.append((owner[j], k, spans[j:n]))
        j = n
    return out


def _find(model: tuple[np.ndarray, ...], sure: float) -> Callable[[list[str]], list]:
    def alone(word: str) -> int:
        z = features([word])[0] @ model[0]
        q = np.exp(z - z.max())
        return int(q.argmax()) if q.max() >= sure * q.sum() else 0

    def find(texts: list[str]) -> list:
        out = [[(k, b, e, "base") for k, b, e in base_spans(t)] for t in texts]
        base = [_disjoint([(b, e) for _, b, e, _ in found]) for found in out]
        for i, k, run in label_runs(model, texts, sure):
            t = texts[i]
            for begin, end in uncut(run, base[i], lambda b, e: bool(TRIGGER.search(t, b, e)) and alone(t[b:e]) == k):  # noqa: B023
                while begin < end and t[begin] in EDGE:
                    begin += 1
                while begin < end and t[end - 1] in EDGE:
                    end -= 1
                if TRIGGER.search(t, begin, end):
                    out[i].append((k - 1, begin, end, "field"))
        return [[{"kind": KINDS[k], "start": b, "end": e, "source": s} for k, b, e, s in sorted(found)] for found in out]

    return find


def agreement(model: tuple[np.ndarray, ...], texts: list[str], sure: float = 0.9) -> tuple[int, int, int]:
    """How well the field does by itself, held against the base rules, whose spans it doesn't see: (base spans that a run of the same label
    touches, base spans, base spans that only runs of another label touch)."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for i, k, run in label_runs(model, texts, sure):
        runs.setdefault(i, []).append((run[0][0], run[-1][1], k - 1))
    hit = total = wrong = 0
    for i, t in enumerate(texts):
        for kind, b, e in base_spans(t):
            met = {k for x, y, k in runs.get(i, ()) if x < e and b < y}
            total += 1
            hit += kind in met
            wrong += bool(met) and kind not in met
    return hit, total, wrong


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("source", pa.string())]))


def find(df: DataFrame, text: str = "text", out: str = "pii", training: Training = Training(), sure: float = 0.9) -> DataFrame:
    """Add array<struct<kind, start, end, source>>: code points, end exclusive, by kind as in KINDS and then start; source: base or field.
    `sure`: the least marginal of a token for the field to label it."""
    small_batches(df.sparkSession)
    model = train(training)
    work: Callable = lambda: _find(model, sure)
    return put(df, out, text_udf(work, "array<struct<kind: string, start: int, end: int, source: string>>", SPAN)(F.col(text)))
