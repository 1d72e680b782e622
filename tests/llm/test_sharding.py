import zlib
from collections import defaultdict

import numpy as np
import pytest

from satlake.llm import oracles, sharding
from satlake.llm.queries import op4_shards
from tests.llm.helpers import clashing, no_docs, odd_docs
from tests.oracle import both, connect


def brute(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = np.array([0, 1, 2, 7, -1, -(1 << 63), (1 << 63) - 1, *range(1000, 3000)], np.int64)
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump(keys, n).tolist() == [brute(int(k), n) for k in keys]
    a, b = sharding.jump(np.arange(100_000), 8), sharding.jump(np.arange(100_000), 9)
    moved = a != b
    assert (b[moved] == 8).all() and abs(moved.mean() - 1 / 9) < 0.01
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_tables(spark, make):
    df = clashing(make(spark))
    out = sharding.assign(df, 8).collect()
    assert len(out) == df.count() and gapless(out)
    for r in out:
        assert r.shard == brute(sharding.LEAST if r.doc_id is None else r.doc_id, 8) and r.law == "key" and r.grown_shard in (r.shard, 8)


def test_hot_key(spark):
    """A third of all rows have one key: slots stay gapless and in the order of keys."""
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 777 ELSE id END doc_id", "cast(id as string) text")
    out = sharding.assign(df, 8, ranges=16, parts=4).collect()
    assert gapless(out)
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.shard, r.slot)):
        by[r.shard].append(r.doc_id)
    assert all(k == sorted(k) for k in by.values())


def test_query(spark, sf):
    ours, theirs = both(op4_shards(spark, sf), connect(sf), oracles.shards(8))
    assert ours == theirs
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op4_shards(spark, sf).collect():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.shard, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), brute(r.doc_id, 8), brute(r.doc_id, 9))
