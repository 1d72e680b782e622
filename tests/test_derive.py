from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from satlake.operators import derive, trace
from satlake.plans import api

OUT = "txid bigint, vout_idx int, block_height int, value_sats bigint, script_type int, address string"
IN = "txid bigint, vin_idx int, block_height int, prev_txid bigint, prev_vout int, sequence_no bigint"
HIST = "address string, block_height int, tx_index int, txid bigint, role int, net_value_sats bigint, block_time timestamp"


def ledger(spark, outs, ins):
    return spark.createDataFrame(outs, OUT), spark.createDataFrame(ins, IN)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_agg_same_key(spark):
    t = datetime(2020, 1, 1)
    h = spark.createDataFrame([("X", 100, 2, 1, 0, 10, t), ("X", 100, 2, 1, 0, 25, t), ("X", 100, 2, 1, 1, -5, t)], HIST)
    assert rows(derive.sum_history(h), "role", "net_value_sats") == [(0, 35), (1, -5)]


def test_same_batch_spend(spark):
    o, i = ledger(spark, [(1, 0, 5, 10, 0, "X"), (2, 0, 5, 9, 0, "Y"), (1, 1, 5, 3, 5, None)], [(2, 0, 5, 1, 0, 0), (1, 0, 5, None, None, 0)])
    s = derive.spends(i)
    assert rows(derive.utxo_set(o, s), "txid", "vout_idx") == [(2, 0)]
    assert rows(derive.balances_of(o, i), "address", "balance_sats", "tx_count", "utxo_count") == [("X", 0, 2, 0), ("Y", 9, 1, 1)]


def test_dup_value_same_tx(spark):
    o, i = ledger(spark, [(1, 0, 5, 5, 0, "X"), (1, 1, 5, 5, 0, "X")], [(1, 0, 5, None, None, 0)])
    marked, utxo = derive.outputs_with_spend(o, derive.spends(i)), derive.utxo_set(o, derive.spends(i))
    who = spark.createDataFrame([("X",), ("nobody",)], "address string")
    assert rows(derive.balances_of(o, i), "total_received_sats") == [(10,)]
    assert rows(api.info_computed(utxo, marked, who), "address", "total_received_sats", "balance_sats") == [("X", 5, 10)]


def test_two_txs_one_block(spark):
    o, i = ledger(spark, [(1, 0, 5, 5, 0, "X"), (2, 0, 5, 6, 0, "X")], [(1, 0, 5, None, None, 0)])
    moves = derive.deltas(derive.outputs_with_spend(o, derive.spends(i)))
    assert rows(derive.balances(moves), "tx_count") == [(2,)] and rows(derive.height_deltas(moves), "tx_delta") == [(1,)]


def test_dup_txid(spark):
    """One transaction id at two heights: a spend belongs to the latest output before it."""
    o, i = ledger(spark, [(1, 0, 5, 50, 0, "X"), (1, 0, 9, 50, 0, "X")], [(7, 0, 12, 1, 0, 0)])
    m = derive.outputs_with_spend(o, derive.spends(i))
    assert rows(m, "block_height", "is_spent") == [(5, False), (9, True)]
    assert rows(derive.source_heights(derive.spends(i), o), "source_height") == [(9,)]


def test_insert_ignore(spark):
    t = datetime(2020, 1, 1)
    old = spark.createDataFrame([("X", 1, 0, 1, 0, 5, t)], HIST)
    new = spark.createDataFrame([("X", 1, 0, 1, 0, 6, t), ("Y", 1, 0, 1, 0, 6, t), ("Y", 1, 0, 1, 0, 6, t)], HIST)
    assert rows(derive.insert_ignore(old, new), "address") == [("Y",)]


def test_pages(spark):
    assert api.page_numbers(None, None) == (100, 0) and api.page_numbers("x", "3") == (0, 3)


@st.composite
def ledgers(draw):
    outs, ins, open_, n = [], [], [], 0
    for height in range(draw(st.integers(1, 6))):
        for _ in range(draw(st.integers(1, 3))):
            n += 1
            spent = draw(st.lists(st.sampled_from(open_), unique=True, max_size=3)) if open_ else []
            ins += [(n, k, height, p, v, 0) for k, (p, v) in enumerate(spent)] or [(n, 0, height, None, None, 0)]
            open_ = [x for x in open_ if x not in spent]
            for k in range(draw(st.integers(0, 3))):
                outs.append((n, k, height, draw(st.integers(0, 9)), 0, draw(st.sampled_from(["A", "B", "C", None]))))
                open_.append((n, k))
    return outs, ins


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ledgers(), st.integers(0, 5))
def test_invariants(spark, l, cut):
    o, i = ledger(spark, *l)
    s = derive.spends(i)
    utxo, b = derive.utxo_set(o, s), derive.balances_of(o, i).collect()
    spent = {(p, v) for _, _, _, p, v, _ in l[1] if p is not None}
    held = [x for x in l[0] if x[5] and (x[0], x[1]) not in spent]
    assert rows(utxo, "txid", "vout_idx") == sorted((x[0], x[1]) for x in held)
    assert sum(r.balance_sats for r in b) == sum(x[3] for x in held)
    for r in b:
        assert r.balance_sats == r.total_received_sats - r.total_sent_sats >= 0 and r.utxo_count == sum(x[5] == r.address for x in held)
    moves = derive.deltas(derive.outputs_with_spend(o, s))
    old, new = (derive.balances(moves.where(c)) for c in (moves.block_height <= cut, moves.block_height > cut))
    merged = derive.merge_balances(old, new, derive.utxo_counts(utxo))
    cols = ("address", "balance_sats", "total_received_sats", "total_sent_sats", "tx_count", "first_seen_height", "last_seen_height", "utxo_count")
    assert rows(merged, *cols) == sorted(tuple(r[c] for c in cols) for r in b)


def test_descendants(spark):
    """A diamond and a tail: least depths, and a depth bound."""
    i = spark.createDataFrame([(2, 0, 1, 1, 0, 0), (3, 0, 1, 1, 1, 0), (4, 0, 2, 2, 0, 0), (4, 1, 2, 3, 0, 0), (5, 0, 3, 4, 0, 0), (5, 1, 3, 1, 2, 0)], IN)
    root = spark.createDataFrame([(1,)], "txid bigint")
    assert rows(trace.descendants(derive.spends(i), root), "txid", "depth") == [(2, 1), (3, 1), (4, 2), (5, 1)]
    assert rows(trace.descendants(derive.spends(i), root, 1), "txid", "depth") == [(2, 1), (3, 1), (5, 1)]
    assert rows(trace.one_hop(derive.spends(i), spark.createDataFrame([(99,)], "txid bigint")), "txid") == []


def test_height_between(spark):
    o, _ = ledger(spark, [(k, 0, k, 1, 0, "X") for k in range(0, 3000, 100)], [(1, 0, 0, None, None, 0)])
    b = derive.with_bucket(o, 1000)
    got = derive.height_between(b, 900, 2100, 1000)
    assert rows(got, "block_height") == [(h,) for h in range(900, 2101, 100)]
    with pytest.raises(AssertionError):
        assert rows(got, "block_height") == []


def test_require_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (1, 3)], "a int, b int")
    assert derive.require_key(df.distinct(), ("a", "b")).count() == 2
    with pytest.raises(ValueError, match="occurs 2 times"):
        derive.require_key(df, ("a", "b"))
    with pytest.raises(ValueError, match="no key column role"):
        derive.require_key(df, ("a", "role"))
