import random
import re
import time
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest

from satlake.llm import pii
from satlake.llm.queries import op8_pii
from tests.llm.helpers import clashing, no_docs, odd_docs


def brute(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]
    return out


@pytest.fixture(scope="module")
def model():
    return pii.train()


def test_base_spans():
    r = random.Random(3)
    for _ in range(6000):
        t = "".join(r.choice("a1@.+- (%_)é00..@٣") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(t) == brute(t), t
    for t in ("4111 1111 1111 1111", "+1 (988) 555-2485 x", "a@b.c.d.e a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.4", "a@@b.c", "x@y.z@w.v"):
        assert pii.base_spans(t) == brute(t), t


def _runs(numbers):
    out = []
    for n in numbers:
        if out and out[-1][-1] == n - 1:
            out[-1].append(n)
        else:
            out.append([n])
    return out


def test_tokens():
    t = "aa bb cc 11 dd ee ff gg hh ii 22 jj"
    assert [[t[a:b] for a, b in s] for s in pii.tokens(t)] == [["bb", "cc", "11", "dd", "ee"], ["hh", "ii", "22", "jj"]]
    assert [len(s) for s in pii.tokens("x1 " * 500)] == [500] and pii.tokens("no triggers") == []
    w = "1" + "x" * 100
    assert pii.tokens("y" * 100 + " " + w + " " + "z" * 100) == [[(0, 100), (101, 202), (203, 303)]]  # however long the neighbours are
    assert pii.tokens("a " + "b" * 10_000 + " 1") == [[(0, 1), (2, 10_002), (10_003, 10_004)]]
    r = random.Random(5)
    for _ in range(2000):  # against all words at once
        t = "".join(r.choice(["1", "a", "b@", " ", "\n ", "cc", " "]) for _ in range(r.randint(0, 30)))
        words = [m.span() for m in re.finditer(r"\S+", t)]
        hot = [i for i, (a, b) in enumerate(words) if re.search(r"[0-9@]", t[a:b])]
        near = {j for i in hot for j in range(i - 2, i + 3) if 0 <= j < len(words)}
        want = [[words[j] for j in run] for run in _runs(sorted(near))]
        assert pii.tokens(t) == want, t


def test_held_out(model):
    right = found = true = 0
    for words, labels in pii.sample(500, 99):
        edges = tuple(np.array(e, np.int64).reshape(-1, 2) for e in pii._edges(words))
        p = pii.marginals(pii.scores(words, model[0]), edges, model)
        y = np.where(p.max(axis=1) >= 0.9, p.argmax(axis=1), 0)
        right += sum(a == b > 0 for a, b in zip(y, labels, strict=True))
        found += (y > 0).sum()
        true += sum(b > 0 for b in labels)
    assert right / found > 0.98 and right / true > 0.92


def test_marginals_on_a_tree_are_exact():
    """Without loops, message passing gives the sums over all labellings."""
    r = np.random.default_rng(1)
    n, k = 4, len(pii.LABELS)
    unary = r.normal(size=(n, k))
    ties = [r.normal(size=(k, k)) for _ in range(3)]
    edges = (np.array([[0, 1], [1, 2]]), np.array([[1, 3]]), np.zeros((0, 2), np.int64))
    total = np.zeros((k,) * n)
    for y in np.ndindex(*total.shape):
        total[y] = np.exp(sum(unary[i, y[i]] for i in range(n)) + ties[0][y[0], y[1]] + ties[0][y[1], y[2]] + ties[1][y[1], y[3]])
    total /= total.sum()
    got = pii.marginals(unary, edges, (None, *ties), rounds=60)
    for i in range(n):
        assert got[i] == pytest.approx(total.sum(axis=tuple(j for j in range(n) if j != i)), abs=1e-6)


def test_skip_edges_carry_labels(model):
    """A bare number is nothing by itself; where the same number stands as a phone number elsewhere, it is one too."""
    words = "call phone 555-201-7788 now and then later on the other side we saw 555-201-7788 again".split()
    chain, same, like = (np.array(e, np.int64).reshape(-1, 2) for e in pii._edges(words))
    assert len(same) == 1
    last = len(words) - 2
    with_, without = (pii.marginals(pii.scores(words, model[0]), (chain, s, like), model)[last, 4] for s in (same, np.zeros((0, 2), np.int64)))
    assert with_ > without


def test_skip_edges_within_a_segment(model):
    """Tokens of one segment are tied as others are, unless they are adjacent; and so labels carry over."""
    words = "x119 aa x119 x119 bb x118 x119".split()
    assert pii.skips(words, [0] * 7) == ([(0, 2), (0, 3), (3, 6)], [(3, 5)])
    assert pii.skips(["x11"] * 5, [0] * 5)[0] == [(0, 2), (1, 3), (2, 4)]
    assert pii.skips(["x11"] * 3, [0, 1, 2])[0] == [(0, 1), (1, 2)]
    t = "phone 555-201-7788 in 2019 aa bb 12 cc dd ee 34 ff gg hh 56 saw 555-201-7788 too"
    (seg,) = pii.tokens(t)
    ws = [t[a:b] for a, b in seg]
    same, like = (np.array(e, np.int64).reshape(-1, 2) for e in pii.skips(ws, [0] * len(ws)))
    chain, none = np.array([(i, i + 1) for i in range(len(ws) - 1)]), np.zeros((0, 2), np.int64)
    first, last = (i for i, w in enumerate(ws) if w == "555-201-7788")
    assert same.tolist() == [[first, last]]
    unary = pii.scores(ws, model[0])
    unary[last] = 0  # nothing is known of the second
    assert pii.marginals(unary, (chain, same, like), model)[last, 4] > pii.marginals(unary, (chain, none, like), model)[last, 4]


def test_messages_reach_the_end_of_a_chain():
    """A label that is sure at one end is so at the other, 40 skip edges away, as on any tree; texts don't touch each other's messages."""
    n, k = 41, len(pii.LABELS)
    unary = np.zeros((n, k))
    unary[0, 4] = 20
    tie = np.eye(k) * 8
    none = np.zeros((0, 2), np.int64)
    edges = (none, np.array([(i, i + 1) for i in range(n - 1)]), none)
    step = np.exp(tie) / np.exp(tie).sum(axis=1, keepdims=True)
    start = np.exp(unary[0]) / np.exp(unary[0]).sum()
    alone = pii.marginals(unary, edges, (None, tie, tie, tie))
    assert alone[-1] == pytest.approx(start @ np.linalg.matrix_power(step, n - 1), abs=1e-3) and alone[-1, 4] > 0.9
    both = tuple(np.concatenate([e, e + n]) for e in edges)
    two = pii.marginals(np.concatenate([unary, unary * 0]), both, (None, tie, tie, tie), owner=np.repeat([0, 1], n))
    assert np.array_equal(two[:n], alone) and two[-1] == pytest.approx(np.full(k, 1 / k))


def test_whole_tokens_are_read():
    """What stands at the end of a long token counts as what stands at its beginning."""
    names = "a" * 500
    assert pii._own(names) != pii._own(names + "1234567") and pii._own(names + "@x.org")[1:3] == [1.0, 1.0]
    long = ["a" * 50 + "-1", "b", "a" * 50 + "_2x"]
    assert pii.skips(long, [0, 1, 2]) == ([], []) and pii.skips([long[0], "b", "a" * 50 + "-2"], [0, 1, 2]) == ([], [(0, 2)])


def test_field_keeps_what_base_spans_leave(model):
    """A phone number that only the field finds stays beside one that a base rule finds; brackets and ports beside base spans are none."""
    find = pii._find(model, 0.9)
    t = "call phone +1 (988) 555-2485, 555-123-4567 and"
    assert [(s["kind"], t[s["start"] : s["end"]], s["source"]) for s in find([t])[0]] == [("phone", "+1 (988) 555-2485", "base"), ("phone", "555-123-4567", "field")]
    assert all(s["source"] == "base" for s in find(["server 10.20.30.40:8080 and mail <an.42@example.com>, host 10.1.2.3/24 up"])[0])
    yes, no = (lambda b, e: True), (lambda b, e: False)
    run = [(0, 4), (5, 9), (10, 14), (15, 19)]
    assert pii.uncut(run, [], no) == [(0, 19)] and pii.uncut(run, [(0, 19)], yes) == [] and pii.uncut(run, [(20, 30)], no) == [(0, 19)]
    assert pii.uncut(run, [(5, 9)], no) == [(0, 4), (10, 19)] and pii.uncut(run, [(3, 7)], no) == [(10, 19)] and pii.uncut(run, [(3, 7)], yes) == [(0, 3), (7, 19)]
    assert pii.uncut(run, [(1, 2), (6, 12)], yes) == [(0, 1), (2, 6), (12, 19)] and pii.uncut(run, [(4, 5), (9, 10)], no) == [(0, 4), (5, 9), (10, 19)]


def test_field_adds_and_base_stays(model):
    find = pii._find(model, 0.9)
    t = "tokens erntou +1 (269) 555-3296 4524132264652876 and on and on, mail an.42@mail8.example.com here"
    got = find([t])[0]
    assert [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in got if s["source"] == "base"] == brute(t)
    assert all(not any(b["start"] < s["end"] and s["start"] < b["end"] for b in got if b["source"] == "base") for s in got if s["source"] == "field")
    clean = "Licensed under CC BY-NC 4.0. version 3. In 2024 they met at 10:30 on page 77, paid $12.50 and left. token = \"9a448b0667399ff1a7e901d2aa447171b1a97a0f\""
    assert find([clean])[0] == []


@pytest.mark.parametrize("text", ["1" * 200_000, "1 " * 20_000, "@" * 100_000, "a@" * 50_000, "1." * 100_000, "a@a." * 50_000, "+" * 100_000, "+1" + " " * 100_000])
def test_long_runs(model, text):
    pii._find(model, 0.9)([text])


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "a." * 100_000 + "@", "a@b." + "a." * 100_000, "x" * 300_000 + " 1 " + "y" * 300_000, "a1" * 200_000, ("b" * 50_000 + " 7 ") * 6])
def test_long_tokens_take_linear_time(model, text):
    find = pii._find(model, 0.9)
    began = time.perf_counter()
    find([text])
    assert time.perf_counter() - began < 1


def test_differing_tails_have_differing_features():
    for tail in ("1", "@b.org", ".5", "-1234"):
        assert not np.array_equal(pii.features(["a" * 5000]), pii.features(["a" * 5000 + tail]))


def test_field_recall_on_planted_entities(model):
    """What base rules find for sure is what documents have planted. The field alone, which doesn't see those spans, labels most of their characters."""
    texts = [t for t in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").to_pylist() if t]
    hit, total, wrong = pii.agreement(model, texts)
    assert total > 500 and hit / total >= 0.95 and wrong / max(hit, 1) < 0.05, (hit, total, wrong)


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    out = pii.find(df)
    assert set(out.columns) == {*df.columns, "pii"}
    got = out.collect()
    assert len(got) == df.count()
    for r in got:
        assert [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.pii if s.source == "base"] == brute(r.text or "")


def test_query(spark, sf):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op8_pii(spark, sf).collect():
        base = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(docs[r.doc_id])]
        assert r.base_sha256 == sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r.spans.split(",")) | {""}
        assert r.n_email == sum(b.startswith("email") for b in base) and r.n_phone == sum(b.startswith("phone") for b in base)
