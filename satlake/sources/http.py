"""The read side over HTTP, from a store: /btc/address/<address>, /btc/tx/<txid>, /btc/tx/<txid>/trace. JSON; hashes as lower-case hex.

Each answer is a Spark query or a few with literal filters, which reach the Parquet scans: files are sorted or have Bloom filters by address and id, so few row groups are read.
An address's numbers come from balances and history where those are derived for all blocks, else from the facts.
"""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.functions.exprs import script_name, to_hex
from satlake.operators import derive, trace
from satlake.plans import api
from satlake.sources.store import Store

Answer = tuple[int, dict]
LITERALS = 10  # as many as Spark pushes down from IN


def _rows(df: DataFrame) -> list[dict]:
    """Small results as JSON values; timestamps in UTC."""
    return [json.loads(x) for x in df.toJSON().collect()]


class Service:
    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark

    def _facts(self) -> dict[str, DataFrame] | None:
        f = {t: self.store.facts(t) for t in ("blocks", "transactions", "tx_outputs", "tx_inputs")}
        return f if f["blocks"] is not None else None

    def _marked(self, outputs: DataFrame, inputs: DataFrame) -> DataFrame:
        """Spend state of a few outputs: the spends are cut to theirs first."""
        keys = outputs.select(F.col("txid").alias("k"), F.col("vout_idx").alias("i"))
        own = inputs.join(keys, (F.col("prev_txid") == F.col("k")) & (F.col("prev_vout") == F.col("i")), "left_semi")
        return derive.outputs_with_spend(outputs, derive.spends(own))

    def address(self, address: str, direction: str | None = None, limit: str | None = None, offset: str | None = None) -> Answer:
        missing = 404, {"error": "address not found"}
        f = self._facts()
        if f is None:
            return missing
        mine = F.col("address") == address
        n, skip = api.page_numbers(limit, offset)
        if self.store.whole("receivers", "senders", "balances", "utxo_counts"):
            history = self.store.derived("address_transactions").where(mine)
            found = _rows(api.info_of_history(self.store.derived("address_balances").where(mine), history))
            rows = api.history(history, direction)
        else:
            marked = self._marked(f["tx_outputs"].where(mine), f["tx_inputs"])
            who = self.spark.createDataFrame([(address,)], "address string")
            found = _rows(api.info_computed(marked.where("not is_spent"), marked, who))
            rows = api.history_computed(marked, f["blocks"], direction)
        if not found:
            return missing
        page = api.page(rows, max(n, 0), max(skip, 0)).withColumn("txid", to_hex(F.col("txid")))
        return 200, {"info": found[0], "transactions": _rows(page)}

    def _txid(self, txid: str) -> bytes | None:
        try:
            return bytes.fromhex(txid)
        except ValueError:
            return None

    def transaction(self, txid: str) -> Answer:
        if (key := self._txid(txid)) is None:
            return 500, {"error": "txid is not hex"}
        f = self._facts()
        if f is None:
            return 404, {"error": "transaction not found"}
        mine = F.col("txid") == F.lit(bytearray(key))
        ids = self.spark.createDataFrame([(bytearray(key),)], "txid binary")
        head = api.header(f["transactions"].where(mine), f["blocks"], ids)
        cols = [to_hex(F.col("txid")).alias("txid"), "block_height", to_hex(F.col("block_hash")).alias("block_hash"), "block_time", "version", "locktime", "is_coinbase", "fee_sats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size_bytes", "vsize", "weight")]]
        found = _rows(head.select(*cols))
        if not found:
            return 404, {"error": "transaction not found"}
        i = f["tx_inputs"].where(mine)
        sources = [r.prev_txid for r in i.where("prev_txid is not null").select("prev_txid").distinct().limit(LITERALS + 1).collect()]
        if len(sources) <= LITERALS:  # so few are pushed down one by one; more meet in a join
            spent = f["tx_outputs"].where(F.col("txid").isin([F.lit(x) for x in sources]) if sources else F.lit(False))
        else:
            spent = f["tx_outputs"].join(i.select(F.col("prev_txid").alias("txid")), "txid", "left_semi")
        full = api.inputs_of(i, spent, ids).join(i.select(F.col("vin_idx").alias("n"), "script_sig"), F.col("vin_idx") == F.col("n"))
        ins = full.select(F.col("vin_idx").alias("index"), to_hex(F.col("prev_txid")).alias("prev_txid"), "prev_vout", "value_sats", "address", to_hex(F.col("script_sig")).alias("script_sig"), "sequence_no").orderBy("index")
        outs = derive.outputs_with_spend(f["tx_outputs"].where(mine), derive.spends(f["tx_inputs"].where(F.col("prev_txid") == F.lit(bytearray(key)))))
        outs = outs.select(F.col("vout_idx").alias("index"), "value_sats", "address", to_hex(F.col("script_pubkey")).alias("script_pubkey"), script_name(F.col("script_type")).alias("script_type"), F.col("is_spent").alias("spent"), to_hex(F.col("spending_txid")).alias("spending_txid")).orderBy("index")
        return 200, {"fee_sats": None} | found[0] | {"inputs": _rows(ins), "outputs": _rows(outs)}

    def trace(self, txid: str) -> Answer:
        if (key := self._txid(txid)) is None:
            return 500, {"error": "txid is not hex"}
        f = self._facts()
        if f is None:
            return 200, {"txid": txid, "descendants": []}
        spent = derive.spends(f["tx_inputs"].where(F.col("prev_txid") == F.lit(bytearray(key))))
        next_ = trace.one_hop(spent, self.spark.createDataFrame([(bytearray(key),)], "txid binary"))
        return 200, {"txid": txid, "descendants": [r["txid"] for r in _rows(next_.select(to_hex(F.col("txid")).alias("txid")).orderBy("txid"))]}

    def route(self, target: str) -> Answer:
        url = urlsplit(target)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        match [unquote(p) for p in url.path.split("/")[1:]]:
            case ["btc", "address", a] if a:
                return self.address(a, q.get("direction") or q.get("role"), q.get("limit"), q.get("offset"))
            case ["btc", "tx", t] if t:
                return self.transaction(t)
            case ["btc", "tx", t, "trace"] if t:
                return self.trace(t)
        return 404, {"error": "no such page"}


def server(store: Store, port: int = 0, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that is ready for serve_forever(); shutdown() stops it."""
    service = Service(store)

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            try:
                status, body = service.route(self.path)
            except Exception as e:
                status, body = 500, {"error": str(e)[:500]}
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
