import json

import pytest
from pyspark.sql import functions as F

from satlake.operators import parse

H = "11" * 32


def block(txs, **kw):
    return json.dumps({"hash": H, "previousblockhash": "22" * 32, "merkleroot": "33" * 32, "time": 1231006505, "bits": "1d00ffff", "nonce": 5, "version": 1, "size": 285, "weight": 1140, "tx": txs} | kw)


def tx(n, vin=None, vout=None, **kw):
    return {"txid": f"{n:064x}", "version": 1, "locktime": 0, "size": 100, "vsize": 90, "weight": 360, "vin": vin if vin is not None else [{"coinbase": "00"}], "vout": vout or []} | kw


def tables(spark, *blocks):
    return parse.tables(spark.createDataFrame(list(blocks), "height int, block string"))


def test_genesis(spark):
    b = json.loads(block([tx(1)]))
    del b["previousblockhash"]
    t = tables(spark, (0, json.dumps(b)), (5, json.dumps(b)))["blocks"].orderBy("height").collect()
    assert bytes(t[0].prev_hash) == bytes(32) and t[1].prev_hash is None
    assert t[0].bits == 486604799 and t[0].tx_count == 1 and t[0].total_fees_sats == 0


def test_coinbase(spark):
    r = tables(spark, (1, block([tx(1, [{"coinbase": "04ff", "txinwitness": ["00" * 32], "sequence": 0}])])))
    t, i = r["transactions"].first(), r["tx_inputs"].first()
    assert t.is_coinbase and t.fee_sats is None and t.has_segwit
    assert i.prev_txid is None and i.prev_vout is None and i.script_sig is None and len(i.witness) == 1 and i.sequence_no == 0


def test_inputs(spark):
    vin = [{"txid": "ab" * 32, "vout": 3, "scriptSig": {"hex": "abc"}, "txinwitness": ["", "aa"]}, {"txid": "cd" * 32, "vout": 0, "txinwitness": [], "sequence": 7}]
    r = tables(spark, (1, block([tx(1, vin, fee=0.0001)])))
    a, b = r["tx_inputs"].orderBy("vin_idx").collect()
    assert a.sequence_no == 4294967294 and a.script_sig is None and a.witness[0] is None and bytes(a.witness[1]) == b"\xaa" and a.prev_vout == 3
    assert b.witness is None and b.sequence_no == 7
    t = r["transactions"].first()
    assert t.has_segwit and not t.is_coinbase and t.fee_sats == 10_000 and t.input_count == 2
    assert r["blocks"].first().total_fees_sats == 10_000


def test_outputs(spark):
    vout = [
        {"value": 0.29, "n": 4, "scriptPubKey": {"hex": "76", "type": "PubKeyHash", "address": "a"}},
        {"value": 1e-8, "n": 1, "scriptPubKey": {"type": "scripthash", "addresses": ["b", "c"]}},
        {"value": 20999999.9769, "scriptPubKey": {"type": "nulldata"}},
        {"n": 2, "scriptPubKey": {"type": "pubkey", "address": ""}},
    ]
    rows = {o.vout_idx: o for o in tables(spark, (1, block([tx(1, vout=vout)])))["tx_outputs"].collect()}
    assert (rows[4].value_sats, rows[4].script_type, rows[4].address) == (29_000_000, 0, "a")
    assert (rows[1].value_sats, rows[1].address) == (1, "b")
    assert (rows[0].value_sats, rows[0].script_type, rows[0].address) == (2_099_999_997_690_000, 5, None)
    assert (rows[2].value_sats, rows[2].script_type, rows[2].address) == (0, 7, None)
    got = parse.receivers(parse.decoded(spark.createDataFrame([(1, block([tx(1, vout=vout)]))], "height int, block string")))
    assert sorted((r.address, r.net_value_sats, r.role) for r in got.collect()) == [("a", 29_000_000, 0), ("b", 1, 0)]


def test_zero_sizes(spark):
    t = tables(spark, (1, block([tx(1, size=0, vsize=0, weight=0)])))["transactions"].first()
    assert (t.size_bytes, t.vsize, t.weight) == (None, None, None)


@pytest.mark.parametrize("bad", ["not json", '{"hash": "11"}', block([tx(1)], tx=5), block([tx(1)], hash="abc"), block([tx(1) | {"txid": "xyz"}])])
def test_bad_blocks(spark, bad):
    with pytest.raises(Exception, match="no list of transactions|bad hex"):
        for t in tables(spark, (1, bad)).values():
            t.select(*[F.col(c) for c in t.columns]).collect()
