import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from satlake.functions.exprs import to_hex
from satlake.plans.ledger import Ledger
from satlake.plans.registry import block_json
from satlake.sources import http
from satlake.sources.store import Store
from satlake.streaming import ingest


@pytest.fixture(scope="module")
def store(spark, sf, tmp_path_factory):
    s = Store(spark, str(tmp_path_factory.mktemp("served")), 1000)
    raw = block_json(Ledger(spark, sf)).orderBy("height").limit(200)
    ingest.save(s, spark.createDataFrame(raw.collect(), raw.schema), "all", historical=True)
    return s


def get(url):
    try:
        with urllib.request.urlopen(url) as r:
            return r.status, json.loads(r.read())
    except urllib.error.HTTPError as e:
        return e.code, json.loads(e.read())


def test_routes(spark, store):
    web = http.server(store)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{web.server_port}/btc"
    try:
        # before the backfill everything is computed from the facts
        out = store.facts("tx_outputs").where("address is not null").groupBy("address").agg(F.sum("value_sats").alias("v"), F.countDistinct("txid").alias("n")).orderBy(F.col("n").desc()).first()
        status, before = get(f"{base}/address/{out.address}?limit=500")
        assert status == 200 and before["info"]["tx_count"] >= out.n
        ingest.backfill(store)
        status, after = get(f"{base}/address/{out.address}?limit=500")
        assert status == 200 and after["info"]["total_received_sats"] == out.v
        key = lambda t: (t["block_height"], t["txid"], t["role"])
        assert sorted(map(key, before["transactions"])) == sorted(map(key, after["transactions"]))
        info = after["info"]
        assert info["balance_sats"] == info["total_received_sats"] - info["total_sent_sats"] == sum(t["net_value_sats"] for t in after["transactions"])
        assert {t["direction"] for t in get(f"{base}/address/{out.address}?role=OUT")[1]["transactions"]} == {"OUT"}
        two = [t for k in (0, 1) for t in get(f"{base}/address/{out.address}?limit=1&offset={k}")[1]["transactions"]]
        assert two == after["transactions"][:2]
        assert get(f"{base}/address/{out.address}?limit=x")[1]["transactions"] == []
        assert get(f"{base}/address/nobody")[0] == 404

        spent = store.facts("tx_inputs").where("prev_txid is not null").select(to_hex(F.col("prev_txid")).alias("p"), to_hex(F.col("txid")).alias("t"), "prev_vout").orderBy("p", "prev_vout").first()
        status, tx = get(f"{base}/tx/{spent.p}")
        assert status == 200 and tx["txid"] == spent.p and tx["outputs"][spent.prev_vout]["spent"] and tx["outputs"][spent.prev_vout]["spending_txid"] == spent.t
        assert [o["index"] for o in tx["outputs"]] == list(range(len(tx["outputs"]))) and "fee_sats" in tx and tx["inputs"]
        status, then = get(f"{base}/tx/{spent.t}")
        assert any(i.get("prev_txid") == spent.p and i["value_sats"] == tx["outputs"][i["prev_vout"]]["value_sats"] for i in then["inputs"])
        assert get(f"{base}/tx/{spent.p}/trace")[1]["descendants"] == [spent.t]
        assert get(f"{base}/tx/{'00' * 32}")[0] == 404 and get(f"{base}/tx/xyz")[0] == 500
        assert get(f"{base}/tx/{'00' * 32}/trace") == (200, {"txid": "00" * 32, "descendants": []})
        assert get(f"{base}/nothing")[0] == 404
    finally:
        web.shutdown()


def test_empty_store(spark, tmp_path):
    s = http.Service(Store(spark, str(tmp_path)))
    assert s.route("/btc/address/x")[0] == 404 and s.route("/btc/tx/00")[0] == 404 and s.route("/btc/tx/00/trace")[0] == 200
