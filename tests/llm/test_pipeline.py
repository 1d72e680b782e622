import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from satlake.llm import mixing, quality, topics
from tests.llm import test_linededup, test_ngramjoin, test_quality
from tests.llm.helpers import no_docs, odd_docs

SYLLABLES = "the in er tion ing and re st ou th al for men un pro con der ly able ship work land house light water stone over under fire wind".split()
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    """Copies, near copies, shared passages, junk and clean documents."""
    r = random.Random(21)
    passage = words(r, 60)
    docs = [(k, words(r, 120)) for k in range(40)]
    docs += [(100 + k, docs[k][1]) for k in range(5)]
    docs += [(200 + k, " ".join(w if i != 50 else "changed" for i, w in enumerate(docs[10 + k][1].split()))) for k in range(5)]
    docs += [(300 + k, words(r, 40) + "\n" + passage + "\n" + words(r, 40)) for k in range(5)]
    docs += [(400, "too short"), (401, None), (402, ""), (403, "same words " * 80)]
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages(spark, planted):
    docs = planted
    assert [n for n, _ in C.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    kept = []
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "")
        if stage is not C.encode:
            assert docs.columns == COLS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id for r in docs.collect()})
        if stage is C.line_dedup:
            text = {r.doc_id: r for r in docs.collect()}
            assert sum(r.text.count("\n") for r in text.values()) == 2 + 4 * 1  # the passage stands in one document only
            assert all(r.n_chars == len(r.text) for r in text.values())
    clean = set(range(40))
    assert kept[0] == clean | {*range(100, 105), *range(200, 205), *range(300, 305)}
    assert kept[1] == kept[0] - set(range(100, 105))  # copies, of which nothing is left
    assert kept[2] == kept[1] - set(range(200, 205))
    assert kept[3] <= kept[2] and kept[4] == kept[3]
    assert docs.where("not round_trip").count() == 0


def test_stages_as_brute_force(spark, sf):
    """Each stage on its own input against a plain version of it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    verdicts = {r.doc_id: r.quality for r in quality.judge(docs, test_quality.MODEL).collect()}
    one = C.quality_rules(spark, docs, sf).collect()
    assert {r.doc_id for r in one} == {k for k, v in verdicts.items() if v.kept}
    for r in docs.collect():
        b = test_quality.brute(r.text or "")
        assert not (b[0] < 20 or 100 * b[4] > 30 * b[0]) or not verdicts[r.doc_id].kept
    docs = spark.createDataFrame(one, docs.schema)
    gone = test_linededup.brute([(r.doc_id, r.text) for r in one])
    want = {}
    for r in one:
        out = gone[r.doc_id, r.text]
        text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in out)
        if not out or text.split():
            want[r.doc_id] = text
    two = C.line_dedup(spark, docs, sf).collect()
    assert {r.doc_id: r.text for r in two} == want
    docs = spark.createDataFrame(two, docs.schema)
    three = C.near_duplicates(spark, docs, sf).collect()
    assert {r.doc_id for r in three} == {i for i, group, _, _ in test_ngramjoin.brute([(r.doc_id, r.text) for r in two]) if i == group}
    docs = spark.createDataFrame(three, docs.schema)
    four = C.mix_sources(spark, docs, sf).collect()
    assert {r.doc_id for r in four} == {r.row.doc_id for r in mixing.mix(docs).where("drawn").collect()}


def test_run(spark, sf):
    out = C.run(spark, sf)
    rows = out.collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    docs = make(spark)
    for extra in (docs, docs.withColumn("row", F.lit(1)).withColumn("quality", F.lit(2)).withColumn("group", F.lit(3))):
        d = extra
        for _, stage in C.STAGES:
            d = stage(spark, d, "")
            assert stage is C.encode or d.columns == extra.columns
            d = spark.createDataFrame(d.collect(), d.schema)


def test_mixing_fits_topics_to_all_texts(spark, monkeypatch):
    """2,500 different texts, some twice: the stage's document frequencies are those of all."""
    seen = {}
    plain = topics.vocabulary

    def spy(texts, docs, p):
        seen["docs"], seen["words"] = docs, plain(texts, docs, p)
        return seen["words"]

    monkeypatch.setattr(topics, "vocabulary", spy)
    texts = [f"w{i % 7} v{i % 11} only{i}" for i in range(2500)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts + texts[:300])], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    C.mix_sources(spark, docs, "").collect()
    held = Counter(w for t in texts for w in t.encode().split())
    assert seen["docs"] == {"en": 2500}
    assert seen["words"]["en"] == sorted(held.items(), key=lambda x: (-x[1], x[0]))[:4096]
