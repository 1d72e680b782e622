import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from satlake.llm import bpe, quality
from satlake.llm.queries import op6_fertility
from tests.llm.helpers import clashing, no_docs, odd_docs

MODEL = bpe.read_ranks(P.path("piece_bpe_32k.model"))
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def tokens(vocabulary, text):
    ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", text) for i in vocabulary.encode(w)]
    n = len(ids)
    return n, sum(vocabulary.IsByte(i) for i in ids), -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0.0


def test_measures(spark, sf, vocabulary):
    texts = [d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ["", "a b c d e f g h " * 5, "x\n x\nx\n\n\n x\n\x0b\nx", "日本語 🎉🎉  x", "a " * 7, "é" * 50, "\x85\xa0 b"]
    for text, got in zip(texts, quality._measure(MODEL, 8)(texts), strict=True):
        assert tuple(got[n] for n in NAMES) == brute(text)
        n, b, bits = tokens(vocabulary, text)
        assert (got["n_tokens"], got["n_byte_tokens"]) == (n, b) and got["token_bits"] == pytest.approx(bits, abs=1e-9)


def test_table_of_words_begun_anew(vocabulary, monkeypatch):
    monkeypatch.setattr(quality.Words, "MOST", 3)
    m = quality._measure(MODEL, 8)
    for t in ("one two three four five", "six seven one", "one two"):
        assert m([t])[0]["n_tokens"] == tokens(vocabulary, t)[0]


def test_windows_of_one_hash(monkeypatch):
    """With a mixing that gives every window one hash, words still tell them apart."""
    monkeypatch.setattr(quality, "_ODD", np.zeros(8, np.uint64))
    words = np.array([*range(8), 99, *range(8), *range(50, 58)])
    assert quality.repeated(words, np.array([0, 17, 25]), 8).tolist() == [16, 0]


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    out = quality.judge(df, MODEL)
    assert set(out.columns) == {*df.columns, "quality"}
    got = out.collect()
    assert len(got) == df.count()
    for r in got:
        assert tuple(r.quality[n] for n in NAMES) == brute(r.text or "")
        few = r.quality.n_words < 20
        assert r.quality.kept == (r.quality.reason is None) and (not few or r.quality.base_failed and not r.quality.kept)


def test_scripts(spark):
    texts = [("ru", "Это обычный русский текст который написан кириллицей и достаточно длинный чтобы его можно было измерить правилом качества текста здесь и сейчас " * 1), (None, "これは日本語の文章です " * 25)]
    got = quality.judge(spark.createDataFrame(texts, "lang string, text string"), MODEL).collect()
    assert {r.quality.band for r in got} == {"cyrillic", "kana"}
    assert got[0].quality.kept


def test_no_language_column(spark):
    r = quality.judge(spark.createDataFrame([("plain words " * 12,)], "text string"), MODEL).first()
    assert r.quality.band == "latin" and r.quality.reason == "repeats"


def test_clean_stay_and_noise_goes(spark, sf):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    clean = quality.judge(df.where("quality = 1").withColumnRenamed("quality", "label"), MODEL).where("not quality.base_failed").collect()
    assert len(clean) > 100 and all(r.quality.kept for r in clean)
    dirty = quality.judge(df.where("quality = 0").withColumnRenamed("quality", "label"), MODEL).where("not quality.base_failed").collect()
    assert sum(not r.quality.kept for r in dirty) > 0.25 * len(dirty)
    noise = "".join(chr(0x4E00 + (i * 7919) % 20000) + ("" if i % 9 else " ") for i in range(3000))
    rows = [("en", noise), ("en", "q#x$w%z^ " * 3 + " ".join(f"@{i}~`{i * 37}§¶" for i in range(200))), ("en", " ".join("ab" for _ in range(200)))]
    assert not any(r.quality.kept for r in quality.judge(spark.createDataFrame(rows, "lang string, text string"), MODEL).collect())


def labelled(spark, table):
    d = f"/root/testdata/{table}"
    return spark.read.parquet(f"{d}/documents.parquet").join(spark.read.parquet(f"{d}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id")


def test_bands_are_what_fitting_gives(spark):
    """Half of the labelled documents, fitted again, gives the constants; the other half, which had no part in them, tells how well they do."""
    df = labelled(spark, "sf0.1")
    bands = quality.fit(df.where((F.col("label") == 1) & (quality.half() == quality.FITTED_ON)), MODEL)
    assert {k: quality.BANDS[k] for k in bands} == bands and quality.widest(bands) == quality.BANDS["latin"]
    rest = quality.judge(df.where(quality.half() != quality.FITTED_ON), MODEL).where("not quality.base_failed").groupBy("label").agg(F.count("*").alias("n"), F.count_if("quality.kept").alias("kept")).collect()
    clean, junk = sorted(rest, key=lambda r: -r.label)
    assert clean.n > 1500 and clean.kept >= 0.998 * clean.n and junk.n > 100 and junk.kept <= 0.3 * junk.n
    some = quality.fit(df.where("label = 1"), MODEL, quality.Fit(sample=300))
    assert set(some) == {"en"} or set(some) > {"en"}  # the sample is bounded, and languages with too few documents are left out
    assert quality.fit(df.limit(0), MODEL) == {}


def test_bands_are_fitted_to_all_documents(spark):
    """4,300 documents and one that is farthest off, whose hash comes last: a sample of the 4,000 least hashes knew nothing of it."""
    r = random.Random(2)
    docs = [(i, "en", " ".join(r.choices(["house", "water", "people", "between", "country", "school", "never", "small"], k=r.randrange(24, 60)))) for i in range(4300)]
    last = max(range(10_000, 30_000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert sum(hashlib.md5(str(i).encode()).hexdigest() < hashlib.md5(str(last).encode()).hexdigest() for i, *_ in docs) > 4000
    odd = (last, "en", " ".join(["x7q", "z9k", "q4v", "j2w"] * 2 + [f"{a}{b}q" for a in "vwxyz" for b in "3579"]))
    df = spark.createDataFrame([*docs, odd], "doc_id long, lang string, text string")
    base = quality.Rules(share=100)
    whole, part = quality.fit(df, MODEL, rules=base)["en"], quality.fit(df, MODEL, quality.Fit(sample=4000), base)["en"]
    own = quality.judge(df.where(F.col("doc_id") == last), MODEL, base).first().quality
    root = math.sqrt(own.n_words)
    assert whole.least_chars - whole.chars_slack / root <= own.chars_per_token < part.least_chars - part.chars_slack / root


def test_query(spark, sf):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op6_fertility(spark, sf).collect():
        b = brute(docs[r.doc_id])
        assert tuple(r[n] for n in NAMES) == b and r.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0]) and not (r.base_failed and r.kept)
