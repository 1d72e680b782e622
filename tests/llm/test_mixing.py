import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from satlake.llm import mixing, topics
from satlake.llm.queries import op1_mix
from tests.llm.helpers import clashing, no_docs, odd_docs


def brute(tokens, codes, want, budget, rounds=500):
    """Raking in plain Python."""
    total = budget * sum(tokens)
    x = [budget * t for t in tokens]
    for _ in range(rounds):
        for c, w in zip(codes, want, strict=True):
            sums = Counter()
            for k, v in zip(c, x, strict=True):
                sums[k] += v
            x = [min(v * w[k] * total / sums[k], t) if sums[k] else 0.0 for k, v, t in zip(c, x, tokens, strict=True)]
    return x


def test_rake():
    r = np.random.default_rng(6)
    tokens = r.integers(1000, 5000, 60).astype(float)
    codes = [r.integers(0, 5, 60), r.integers(0, 3, 60), r.integers(0, 4, 60)]
    want = [np.full(5, 0.2), np.array([0.5, 0.3, 0.2]), np.full(4, 0.25)]
    x = mixing.rake(tokens, codes, want, 0.3, 500, 1e-12)
    assert x == pytest.approx(np.array(brute(tokens.tolist(), [c.tolist() for c in codes], want, 0.3)), rel=1e-6)
    assert (x <= tokens).all()
    for c, w in zip(codes, want, strict=True):
        assert np.bincount(c, x) == pytest.approx(w * 0.3 * tokens.sum(), rel=1e-6)


def test_shares():
    assert mixing.shares(1.0, {"a": 30, "b": 10, "c": 0}, 0.5) == pytest.approx({"a": 0.75, "b": 0.25, "c": 0})
    assert mixing.shares(0.0, {"a": 90, "b": 10}, 0.5) == pytest.approx({"a": 0.8, "b": 0.2})  # b gives all it has
    assert mixing.shares({"a": 1, "x": 5}, {"a": 60, "b": 40}, 0.5) == pytest.approx({"a": 1.0, "b": 0})
    assert mixing.shares(0.5, {}, 0.5) == {}


def test_driver_and_tables_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    targets = (0.5, {"en": 0.4, "de": 0.3, "fr": 0.3}, 0.7)
    a = {r.row.doc_id: (r.prob, r.drawn) for r in mixing.mix(df, mixing.Mix(targets, rounds=12)).collect()}
    b = {r.row.doc_id: (r.prob, r.drawn) for r in mixing.mix(df, mixing.Mix(targets, rounds=12, driver_cells=0)).collect()}
    assert a.keys() == b.keys()
    assert all(a[k][0] == pytest.approx(b[k][0], abs=1e-9) for k in a)
    spanish = {r.doc_id for r in df.where("lang = 'es'").collect()}
    assert all(a[k] == (0.0, False) for k in spanish)


def test_margins_and_draws(spark):
    df = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    tokens, drawn = sum(r.n_tokens for r in df), [r for r in df if r.drawn]
    assert sum(r.prob * r.n_tokens for r in df) == pytest.approx(0.5 * tokens, rel=1e-6)
    for m, power in zip(mixing.MARGINS, (0.5, 0.7, 0.7), strict=True):
        held, expected, real = Counter(), Counter(), Counter()
        for r in df:
            held[r[m]] += r.n_tokens
            expected[r[m]] += r.prob * r.n_tokens
        for r in drawn:
            real[r[m]] += r.n_tokens
        want = mixing.shares(power, held, 0.5)
        for c in held:
            assert expected[c] / (0.5 * tokens) == pytest.approx(want[c], rel=1e-3)
            if expected[c] > 200_000:
                assert real[c] == pytest.approx(expected[c], rel=0.15)
    for r in df[:300]:
        u = int(hashlib.md5(f"17:{r.row.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.drawn == (u < r.prob)


@pytest.mark.parametrize("cells", [100_000, 0])
@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make, cells):
    df = clashing(make(spark))
    got = mixing.mix(df, mixing.Mix(rounds=4, driver_cells=cells)).collect()
    assert len(got) == df.count()
    for r in got:
        assert r.row.asDict().keys() == set(df.columns) and 0 <= r.prob <= 1
        assert r.n_tokens == len((r.row.text or "").encode().split()) and r.drawn is not None


def test_same_id_same_draw(spark):
    df = odd_docs(spark).where("doc_id = 4")
    got = mixing.mix(df.unionByName(df)).where("row.text = 'one two three'").collect()
    assert len({r.drawn for r in got}) == 1


def test_contradicting_margins_are_told(spark):
    """Topic z is in one language only, so both targets can't be met; on the driver and in tables alike."""
    df = spark.createDataFrame([(i, "w " * 40, "en" if i % 2 else "de", "s") for i in range(40)], "doc_id bigint, text string, lang string, source string")
    p = {"targets": (1.0, {"en": 0.5, "de": 0.5}, {"en": 0.2, "de": 0.8}), "rounds": 30}
    for cells in (100_000, 0):
        with pytest.warns(UserWarning, match="off its target"):
            rows = mixing.mix(df, mixing.Mix(**p, driver_cells=cells), topic=F.col("lang")).collect()
        assert {round(r.gap, 6) for r in rows} == {0.3}
    assert {r.gap < 1e-9 for r in mixing.mix(df, mixing.Mix((1.0, 1.0, 1.0))).collect()} == {True}


def topic(model, text, lang):
    """Every cluster's sum, word by word."""
    words = text.encode().split()
    if not words or lang not in model:
        return "t0" if words else "none"
    place, weight = model[lang]
    known = [w for w in words if w in place]
    sums = [sum(weight[place[w], k] for w in known) for k in range(weight.shape[1])]
    return f"t{int(np.argmax(sums))}" if known else "none"


def test_topics_are_found(spark):
    """Texts of three planted subjects in two languages: a language's clusters are its subjects, whatever order or copies the rows come in."""
    r = random.Random(4)
    subjects = {(g, k): [f"{g}{k}{i}" for i in range(30)] for g in "ab" for k in range(3)}
    common = {g: [f"{g}the{i}" for i in range(4)] for g in "ab"}
    docs = [(n, " ".join(common[g] + r.choices(subjects[g, k], k=25)), g, k) for n, (g, k) in enumerate(r.choices(list(subjects), k=600))]
    docs += [docs[0]] * 300
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, subject int").repartition(5)
    p = topics.Topics(count=3)
    model = topics.fit(df, F.col("text"), F.col("lang"), p)
    assert set(model) == {"a", "b"} and not any(w.startswith(b"athe") for w in model["a"][0])
    got = df.select("lang", "subject", topics.topic_of(df, model, F.col("text"), F.col("lang")).alias("t")).collect()
    assert all(x.t.n_tokens == 29 for x in got)
    seen = {(x.lang, x.subject, x.t.topic) for x in got}
    assert len(seen) == 6 and len({(g, t) for g, _, t in seen}) == 6
    again = topics.fit(df.orderBy(F.rand(3)), F.col("text"), F.col("lang"), p)
    assert all((again[g][1] == model[g][1]).all() and again[g][0] == model[g][0] for g in model)
    few = topics.fit(df, F.col("text"), F.col("lang"), topics.Topics(count=3, sample=40))
    assert not few or all(len(x[0]) <= 4096 for x in few.values())  # too few texts of a language: one cluster
    assert topics.fit(df.limit(0), F.col("text"), F.col("lang")) == {}


def test_query_against_brute_force(spark, sf):
    """op1_mix whole: cells, targets, raking, probabilities and draws in plain Python."""
    df = spark.read.parquet(f"{sf}/documents.parquet")
    model = topics.fit(df, F.col("text"), F.col("lang"))
    docs = [(d.doc_id, d.source or "", d.lang or "", topic(model, d.text or "", d.lang or ""), len((d.text or "").encode().split())) for d in df.collect()]
    cells = Counter()
    for _, *cell, n in docs:
        cells[tuple(cell)] += n
    names = sorted(cells)
    tokens = [cells[c] for c in names]
    want = []
    for m, power in enumerate((0.5, 0.7, 0.7)):
        held = Counter()
        for c in names:
            held[c[m]] += cells[c]
        most = {c: v / (0.5 * sum(tokens)) for c, v in held.items() if v}
        share, full = {}, set()
        while True:
            rest = {c: held[c] ** power for c in most if c not in full}
            room = 1 - sum(most[c] for c in full)
            share = {c: room * v / sum(rest.values()) for c, v in rest.items()} | {c: most[c] for c in full}
            more = {c for c in rest if share[c] > most[c]}
            if not more:
                break
            full |= more
        want.append(share | {c: 0.0 for c in held if c not in share})
    x = brute(tokens, [[c[m] for c in names] for m in range(3)], want, 0.5, 200)
    prob = {c: v / t if t else 0.5 for c, v, t in zip(names, x, tokens, strict=True)}
    have = Counter((r.doc_id, r.source, r.lang, r.topic, r.n_tokens, round(r.prob, 6), r.drawn) for r in op1_mix(spark, sf).collect())
    expect = Counter((i, s, g, t, n, round(prob[s, g, t], 6), int(hashlib.md5(f"17:{i}".encode()).hexdigest()[:13], 16) / 2**52 < prob[s, g, t]) for i, s, g, t, n in docs)
    assert have == expect


def test_query(spark, sf):
    rows = op1_mix(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and 0 < sum(r.drawn for r in rows) < len(rows)


def test_raking_gives_full_categories_whole():
    """A category that holds just its target meets it exactly, however slowly scaling alone nears that."""
    r = np.random.default_rng(11)
    tokens, codes = np.round(r.lognormal(5, 1.5, 60)), [r.integers(0, 5, 60), r.choice(4, 60, p=[0.6, 0.2, 0.15, 0.05]), r.choice(5, 60, p=[0.6, 0.2, 0.1, 0.07, 0.03])]
    want = [np.array([*mixing.shares(power, dict(enumerate(np.bincount(c, tokens))), 0.5).values()]) for power, c in zip((0.5, 0.7, 0.7), codes, strict=True)]
    slow = np.array(brute(tokens.tolist(), [c.tolist() for c in codes], want, 0.5, 60))
    x = mixing.rake(tokens, codes, want, 0.5, 60, 1e-12)
    assert mixing.gap(slow, tokens, codes, want, 0.5) > 1e-4 and mixing.gap(x, tokens, codes, want, 0.5) < 1e-9
    assert x.sum() == pytest.approx(0.5 * tokens.sum(), rel=1e-9) and (x <= tokens).all()


def plain_fit(docs, p):
    """The vocabulary, its weights, and what a round of k-means makes of centres, over all different texts."""
    held, n = {}, Counter()
    for lang, text in docs:
        n[lang] += 1
        held.setdefault(lang, Counter()).update(set(text.encode().split()))
    words = {g: sorted((w for w, k in c.items() if 2 * k <= n[g]), key=lambda w: (-c[w], w))[: p.words] for g, c in held.items()}
    return words, {g: np.log([n[g] / held[g][w] for w in ws]) for g, ws in words.items()}


def test_model_is_of_all_texts(spark, monkeypatch):
    """3,000 different texts, more than the sample there once was: words, frequencies and centres are those of all, whatever the units, rows and order."""
    r = random.Random(12)
    docs = [(g, " ".join(r.choices([f"{g}{k}{i}" for i in range(40)] + [f"{g}x{i}" for i in range(200)], k=r.randrange(3, 30)))) for g, k in r.choices([(g, k) for g in "ab" for k in range(3)], k=3000)]
    docs = sorted(set(docs)) + [("c", "too few")]
    df = spark.createDataFrame(docs + docs[:500], "lang string, text string")
    p = topics.Topics(count=3, words=300, rounds=60)
    model = topics.fit(df, F.col("text"), F.col("lang"), p)
    words, rare = plain_fit(docs, p)
    assert set(model) == {"a", "b"}
    for g, (place, weight) in model.items():
        assert sorted(place, key=place.get) == words[g]
        x = np.array([[t.split().count(w.decode()) for w in words[g]] for lang, t in docs if lang == g]) * rare[g]
        x = x[x.any(axis=1)]
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        centre = (weight / rare[g][:, None]).T
        own = (x @ centre.T).argmax(axis=1)
        assert np.bincount(own, minlength=3).tolist() == sorted(np.bincount(own, minlength=3).tolist(), reverse=True)
        for k in range(3):  # settled: each centre is the mean direction of all texts next to it
            mean = x[own == k].sum(axis=0)
            assert centre[k] == pytest.approx(mean / np.sqrt(mean @ mean), abs=1e-6)
    monkeypatch.setattr(topics, "UNIT", 1500)
    monkeypatch.setattr(topics, "ROW", 70)
    again = topics.fit(df.orderBy(F.rand(8)).repartition(3), F.col("text"), F.col("lang"), p)
    assert all(again[g][0] == model[g][0] and (again[g][1] == model[g][1]).all() for g in model)


def test_units():
    """Words as bytes.split() cuts them, each text's different ones with their counts, in units of few words and many languages."""
    texts = ["", " a\tb\x0ba\x0cc\r\n ", "\x1c x  y a", "a" * 70, "é é é\x00 é"] * 3
    batch = topics.pa.RecordBatch.from_arrays([topics.pa.array(range(15)), topics.pa.array([f"g{i % 2}" for i in range(15)]), topics.pa.array(texts)], names=["key", "lang", "text"])
    got = {}
    for row in topics.units(iter([batch.slice(0, 7), batch.slice(7)])):
        for lang, words, keys, sizes, ids, counts in topics.read(row):
            at = np.cumsum(sizes) - sizes
            for k, a, n in zip(keys.tolist(), at, sizes, strict=True):
                got[k] = lang, {words[i]: c for i, c in zip(ids[a : a + n], counts[a : a + n].tolist(), strict=True)}
    assert got == {i: (f"g{i % 2}", dict(Counter(t.encode().split()))) for i, t in enumerate(texts)}


def test_topics_are_found_once(spark, sf):
    """The result is read from what was written with topics: no text is parsed again for it."""
    plan = op1_mix(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "documents.parquet" not in plan
    rows = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id", "n_chars"])
    assert rows.select("row.*").columns == ["doc_id", "n_chars"]
    assert sorted(map(str, rows.select("row.doc_id", "topic", "prob", "drawn").collect())) == sorted(map(str, mixing.mix(spark.read.parquet(f"{sf}/documents.parquet")).select("row.doc_id", "topic", "prob", "drawn").collect()))


def test_words_by_their_bounds(spark, monkeypatch):
    """Units keep rare words back, and the most common ones and their counts are still exact; where bounds don't tell them ("b": each unit has words of its own), all words are counted."""
    r = random.Random(9)
    monkeypatch.setattr(topics, "UNIT", 3000)
    texts = [("a", " ".join({f"a{min(int(r.paretovariate(0.7)), 3000)}" for _ in range(30)} | {"everywhere", f"once{i}"})) for i in range(800)]
    texts += [("b", " ".join(f"b{i // 100}x{r.randrange(60)}" for _ in range(40))) for i in range(800)]
    texts += [("c", f"c{i} c{i % 3}") for i in range(9)]
    columns = [topics.pa.array(x) for x in (range(len(texts)), *zip(*texts, strict=True))]
    batch = topics.pa.RecordBatch.from_arrays(columns, names=["key", "lang", "text"])
    p = topics.Topics(words=50)
    units = list(topics.units((batch.slice(i, 20) for i in range(0, len(texts), 20)), p.words))
    df = spark.createDataFrame(topics.pa.Table.from_batches(units), topics.UNITS).repartition(4)
    docs = {"a": 800, "b": 800, "c": 9}
    want = {}
    for g in docs:
        held = Counter(w for lang, t in texts if lang == g for w in set(t.encode().split()))
        want[g] = sorted(((w, n) for w, n in held.items() if 2 * n <= docs[g]), key=lambda x: (-x[1], x[0]))[:50]
    told = topics.likely(df, docs, p)
    assert set(told) == {"a", "c"} and told == {g: want[g] for g in told}
    assert topics.vocabulary(df, docs, p) == want
    monkeypatch.setattr(topics, "LIKELY", 0)
    assert topics.likely(df, docs, p) == {} and topics.vocabulary(df, docs, p) == want
    given, whole = (sum(b.num_rows for b in topics.frequencies(iter(units), {"a": 800}, cuts)) for cuts in (True, False))
    assert given < whole / 3
