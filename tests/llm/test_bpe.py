import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from satlake.llm import bpe
from tests.llm.helpers import clashing, no_docs, odd_docs, rows

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    r = random.Random(5)
    yield from ["", " ", "a" * 5000, "ab" * 700, "é" * 600, "  \n\n x", "日本語テキスト🎉🎉", "don't we'll", "\x00\x1c\x85 ", "x" * 1024 + " " + "y" * 1025, "1234567890" * 300, "<|endoftext|>"]
    for _ in range(60):
        yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(97, 103), r.randrange(160, 0x2000), r.randrange(0x10000, 0x11000)])) for _ in range(r.randrange(200)))


def test_as_tiktoken(codec, reference):
    texts = list(odd_texts())
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_heap_and_matrix_agree(codec):
    r = random.Random(1)
    for _ in range(60):
        p = bytes(r.choice(b"abcdeththeing ") for _ in range(r.randrange(2, 400)))
        if p in codec.rank:
            continue
        flat, start = codec.pieces([p])
        assert flat.tolist() == codec._heap(p) and start.tolist() == [0, len(flat)]


def test_pair_table():
    r = np.random.default_rng(2)
    keys = np.unique(r.integers(0, 1 << 40, 5000))
    table = bpe.PairTable(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(r.integers(0, 1 << 40, 5000), keys)
    assert (table.get(other) == bpe.NONE).all() and (table.get(np.array([-1])) == bpe.NONE).all()


def test_bad_ids(codec):
    with pytest.raises(ValueError):
        codec.decode(np.array([codec.n]))


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, reference, make):
    df = clashing(make(spark))
    out = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert set(out.columns) == {*df.columns, "token_ids", "decoded"}
    got = out.select("text", "token_ids", "decoded").collect()
    assert len(got) == df.count()
    both = bpe.round_trip(df, RANKS, P.PATTERN)
    assert both.columns == out.columns and both.select("text", "token_ids", "decoded").collect() == got
    for r in got:
        assert r.token_ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


def test_query(spark, sf, reference):
    from hashlib import sha256

    from satlake.llm.queries import op7_bpe

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = []
    for d in docs:
        ids = reference.encode_ordinary(d.text or "")
        want.append((d.doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((d.text or "").encode()).hexdigest()))
    assert rows(op7_bpe(spark, sf), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
