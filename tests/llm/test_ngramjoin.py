import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from satlake.llm import ngramjoin as N
from satlake.llm.common import components
from satlake.llm.queries import op3_ngram_join
from tests.llm.helpers import clashing, no_docs, odd_docs, rows


def shingles(t):
    w = (t or "").encode().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs):
    """[(id, text)] to [(id, group, links, others)], by an inverted index of all shingles."""
    sets = [shingles(t) for _, t in docs]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    near = [{j for j, n in Counter(j for g in s for j in where[g] if j != i).items() if 5 * n >= 4 * (len(s) + len(sets[j]) - n)} for i, s in enumerate(sets)]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, js in enumerate(near):
        for j in js:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (id, _) in enumerate(docs):
        least[find(i)].append(id)
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in least.items()}
    return sorted(((id, low[find(i)] if sets[i] else id, len({docs[j][1] for j in near[i]} - {t}), len(near[i])) for i, (id, t) in enumerate(docs)), key=repr)


def got(df):
    return sorted(((r.row.doc_id, r.group, r.links, r.others) for r in df.collect()), key=repr)


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string")


def word(r):
    return "".join(r.choice("abcdefghij") for _ in range(4))


def drifted(r, words, edits):
    w = list(words)
    for _ in range(edits):
        w[r.randrange(len(w))] = word(r)
    return " ".join(w)


@pytest.fixture(scope="module")
def docs():
    r = random.Random(12)
    out = []
    for family in range(6):
        base = [word(r) for _ in range(r.choice([12, 40, 150]))]
        for _ in range(r.choice([2, 5, 40])):
            out.append(drifted(r, base, r.randrange(4)))
        out += [" ".join(base)] * 3
    out += [drifted(r, [word(r) for _ in range(60)], 0) for _ in range(40)] + ["a b c d", "a b c d", "a b c d e", "x", "x ", "", "  "]
    return list(enumerate(out))


@pytest.mark.parametrize("block", [4, 400])
def test_as_brute_force(spark, docs, block):
    """With blocks of four classes, every family is dealt over many units."""
    assert got(N.near_duplicates(table(spark, docs), N.Join(block=block))) == brute(docs)


def test_differences_tell_what_sets_tell():
    """Pairs held as differences from any pivot are linked as whole sets are, and linked texts lie in neighbouring steps of distance."""
    r = random.Random(8)
    base = [word(r) for _ in range(80)]
    texts = [drifted(r, base, r.randrange(12)) for _ in range(60)] + [" ".join(word(r) for _ in range(r.randrange(1, 90))) for _ in range(20)]
    p = N.Join()
    flat, start = N.shingle_sets(texts, 5)
    a, b = np.triu_indices(len(texts), 1)
    want = set(zip(*(x.tolist() for x in N.linked(flat, start, a, b, p)), strict=True))
    rows_ = next(iter(N._read(p)([pa.RecordBatch.from_arrays([pa.array(range(80), pa.int64()), pa.array(range(80), pa.int64()), pa.array([str(i) for i in range(80)]), pa.array([1] * 80, pa.int64()), pa.array(texts)], names=["comp", "node", "md5", "copies", "text"])])))
    for pivot in (0, 70):
        with_pivot = pa.RecordBatch.from_arrays([*rows_.columns, pa.array([rows_.column(6)[pivot].as_py()] * 80, pa.binary())], names=[*rows_.schema.names, "pivot"])
        (d,) = N._differ(p)([with_pivot])
        grams, step = d.column(6).to_pylist(), d.column(7).to_pylist()
        assert grams[pivot] == b"" and step[pivot] == 0
        signs = np.frombuffer(b"".join(d.column(5).to_pylist()), np.uint8).reshape(80, -1)
        some, ends = np.frombuffer(b"".join(grams), np.uint64), np.append(0, np.cumsum([len(g) // 8 for g in grams]))
        have = set(zip(*(x.tolist() for x in N.linked(some, ends, a, b, p, signs, d.column(4).to_numpy())), strict=True))
        assert have == want and len(want) >= 40
        assert all(abs(step[i] - step[j]) <= 1 for i, j in want)


def test_threshold_is_exact(spark):
    """8 of 10 shingles in common are a link; 7 of 10, 0.79... are none."""
    w = [f"w{i}" for i in range(60)]
    pairs = [(40, 36), (40, 35), (49, 45), (13, 11), (13, 12), (8, 7), (9, 8), (9, 7)]
    docs = []
    for n, m in pairs:
        own = [f"p{len(docs)}_{x}" for x in w]
        docs += [(len(docs), " ".join(own[:n])), (len(docs) + 1, " ".join(own[:m]))]
    assert got(N.near_duplicates(table(spark, docs))) == brute(docs)


def test_pruning_loses_nothing():
    """Pairs that the posterior drops are never at the threshold, for many pairs about it."""
    r = random.Random(3)
    texts = []
    for _ in range(150):
        base = [word(r) for _ in range(r.choice([30, 120]))]
        texts += [" ".join(base), drifted(r, base, r.randrange(1, 6))]
    flat, start = N.shingle_sets(texts, 5)
    a, b = np.triu_indices(len(texts), 1)
    x, y = N.linked(flat, start, a, b, N.Join())
    sets = [shingles(t) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(want) > 25
    few = [(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if i // 2 == j // 2]
    x, y = N.linked(flat, start, *np.array(few).T, N.Join())  # pair by pair, not by matrix
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want & set(few)


def test_least_agreements():
    least = N.least_agreements(N.Join())
    assert list(least) == sorted(least) and least[-1] < 160 * 0.8 and least[-1] > 160 * 0.5


def test_candidates_meet():
    """At similarity 0.8 and more, pairs share a band."""
    r = random.Random(5)
    p = N.Join()
    for _ in range(60):
        base = [word(r) for _ in range(200)]
        texts = [" ".join(base), drifted(r, base, 3)]
        keys = N.band_keys(N.minhash(*N.shingle_sets(texts, 5), p.bands * p.rows), p)
        assert (keys[0] == keys[1]).any()


def test_components(spark):
    r = random.Random(7)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(r.randrange(5000, 6000), r.randrange(5000, 6000)) for _ in range(400)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    e = spark.createDataFrame(edges, "u bigint, v bigint")
    assert rows(components(e), "node", "root") == sorted(((x, find(x)) for x in list(root)), key=repr)
    assert components(e.limit(0)).collect() == []


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    out = N.near_duplicates(df)
    assert got(out) == brute([(r.doc_id, r.text) for r in df.collect()])
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    texts = [r.text for r in kept.collect()]
    want = {r.text for r in df.collect() if shingles(r.text)}
    assert {t for t in texts if shingles(t)} == want and len(texts) == len(want) + sum(not (r.text or "").split() for r in df.collect())


def test_keep_one(spark, docs):
    kept = sorted(r.doc_id for r in N.keep_one(table(spark, docs)).collect())
    assert kept == [id for id, group, _, _ in sorted(brute(docs)) if id == group]


def test_repeated_ids(spark, tmp_path):
    """Unlinked texts of one id are groups of their own, whether copies, near copies or alone; each keeps a document."""
    r = random.Random(31)
    a, b, c = ([word(r) for _ in range(60)] for _ in range(3))
    near = " ".join([*b[:59], "changed"])
    docs = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(c)), (2, near), (3, " ".join(c))]
    df = table(spark, docs)
    assert got(N.near_duplicates(df)) == brute(docs)
    assert sorted((r.doc_id, r.text) for r in N.keep_one(df).collect()) == sorted(docs[:3])
    key = {(r.row.doc_id, r.row.text): r.key for r in N.near_duplicates(df).collect()}
    assert len(set(key.values())) == 3 and key[docs[1]] == key[docs[3]] and key[docs[2]] == key[docs[4]]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = op3_ngram_join(spark, str(tmp_path)).collect()
    assert {r.class_id for r in out} == {1} and len({r.class_key for r in out}) == 3


def test_null_ids(spark):
    """Near copies without ids are one group, of which one stays; unlinked ones all stay, and an id goes before none."""
    r = random.Random(32)
    a, b, c = ([word(r) for _ in range(60)] for _ in range(3))
    near = lambda w: " ".join([*w[:59], "changed"])
    docs = [(None, " ".join(a)), (None, near(a)), (None, near(a)), (None, " ".join(b)), (None, " ".join(c)), (9, near(c))]
    kept = [(r.doc_id, r.text) for r in N.keep_one(table(spark, docs)).collect()]
    assert len(kept) == 3 and len({t for _, t in kept} & {docs[0][1], docs[1][1]}) == 1 and {docs[3], docs[5]} < set(kept)


def test_query(spark, sf):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    have = sorted(((r.doc_id, r.class_id, r.n_links, r.n_linked_docs) for r in op3_ngram_join(spark, sf).collect()), key=repr)
    assert have == brute(docs)
