import http.server
import json
import os
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from satlake.config import BackfillConfig, IngestConfig, overlay, read_flat_yaml
from satlake.plans.ledger import Ledger
from satlake.plans.registry import block_json
from satlake.sources import rpc
from satlake.sources.store import STEPS, Conflict, Store, bridged, common, joined, runs_of, without
from satlake.streaming import ingest

CHAIN = 40


@pytest.fixture(scope="module")
def chain(spark, sf, tmp_path_factory):
    """The first CHAIN blocks of the ledger, numbered from 0, as files."""
    folder = tmp_path_factory.mktemp("chain")
    rows = block_json(Ledger(spark, sf)).orderBy("height").limit(CHAIN).collect()
    for h, r in enumerate(rows):
        (folder / f"{h}.json").write_text(r.block)
    return folder


def tip(chain, n):
    (chain / "tip").write_text(str(n))


def table(df, *cols):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in (r[c] for c in cols)) for r in df.collect())


BAL = ("address", "balance_sats", "total_received_sats", "total_sent_sats", "tx_count", "utxo_count", "first_seen_height", "last_seen_height")
HIST = ("address", "block_height", "tx_index", "txid", "role", "net_value_sats")


def derived(store):
    return table(store.derived("address_balances"), *BAL), table(store.derived("address_transactions"), *HIST), table(store.derived("utxo_set"), "txid", "vout_idx", "value_sats")


def test_batches_equal_backfill(spark, chain, tmp_path):
    spark.dataSource.register(rpc.RpcBlocks)
    raw = spark.read.format("rpc_blocks").options(url=f"file:{chain}", start=0, end=CHAIN - 1).load()
    assert raw.count() == CHAIN
    live, bulk = Store(spark, str(tmp_path / "live"), 10), Store(spark, str(tmp_path / "bulk"), 10)
    for k, (a, b) in enumerate([(0, 6), (7, 7), (8, 39)]):
        part = raw.where(raw.height.between(a, b))
        assert ingest.save(live, part, f"b{k}")
        assert not ingest.save(live, part, f"b{k}")  # a replay
    assert ingest.save(bulk, raw, "all", historical=True)
    assert bulk.derived("utxo_set") is None
    ingest.backfill(bulk)
    assert derived(live) == derived(bulk)
    assert live.last_height() == bulk.last_height() == CHAIN - 1
    with pytest.raises(ValueError, match="already"):
        ingest.save(live, raw.where("height = 3"), "again")
    assert live.last_height() == CHAIN - 1
    before = table(live.facts("tx_outputs"), "txid", "vout_idx")
    live.compact()
    assert live.vacuum() > 0
    assert table(live.facts("tx_outputs"), "txid", "vout_idx") == before
    plan = live.facts("tx_outputs").where("height_bucket = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(height_bucket" in plan


def test_stream_lags_and_resumes(spark, chain, tmp_path):
    spark.dataSource.register(rpc.RpcBlocks)
    store = Store(spark, str(tmp_path / "s"), 10)
    seen = []

    def run(n):
        tip(chain, n)
        stream = spark.readStream.format("rpc_blocks").options(url=f"file:{chain}", batch=12, confirmations=10).load()
        q = ingest.start(spark, stream, store, str(tmp_path / "c"), every="0 seconds")
        want = rpc.safe_tip(n, 10)
        for _ in range(600):
            if store.last_height() >= want or q.exception():
                break
            q.awaitTermination(0.2)
        q.stop()
        assert q.exception() is None
        seen.append(store.last_height())

    run(25)
    run(39)
    assert seen == [15, 29]
    assert table(store.facts("blocks"), "height") == [(h,) for h in range(30)]
    bulk = Store(spark, str(tmp_path / "b"), 10)
    ingest.save(bulk, spark.read.format("rpc_blocks").options(url=f"file:{chain}", end=29).load(), "all", historical=True)
    ingest.backfill(bulk)
    assert derived(store) == derived(bulk)


@pytest.mark.parametrize("n, want", [(5, 0), (10, 0), (11, 1), (1000, 990)])
def test_safe_tip(n, want):
    assert rpc.safe_tip(n, 10) == want


def test_deal():
    assert [(p.first, p.last) for p in rpc.deal(3, 12, 4)] == [(3, 5), (6, 8), (9, 11), (12, 12)]
    assert rpc.deal(5, 4, 4) == []


def test_client_retries_and_keeps_numbers():
    calls = []

    class Node(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            q = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            calls.append(q["method"])
            if len(calls) == 1:
                self.send_response(503)
                self.end_headers()
                return
            body = {"getblockhash": '{"result": "ab", "error": null}', "getblock": '{"error": null, "result": {"fee": 0.10000000, "x": "\\"result\\""}, "id": 1}', "getblockchaininfo": '{"result": {"blocks": 77}, "error": null}', "bad": '{"result": null, "error": {"code": -1}}'}[q["method"]].encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Node)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    c = rpc.Client(f"http://127.0.0.1:{server.server_port}", "u", "p", wait=0.01)
    assert "0.10000000" in c.block(3)
    assert calls == ["getblockhash", "getblockhash", "getblock"] and c.tip() == 77
    with pytest.raises(rpc.RpcError):
        c.call("bad")
    server.shutdown()


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("# settings\nrpc_url: http://x:1\nworkers: 4\nbatch_size: many  # not a number\nhistorical_sync: true\n")
    cfg = IngestConfig.load(str(p), {"SATLAKE_WORKERS": "7", "SATLAKE_CONFIRMATIONS": "x"})
    assert (cfg.rpc_url, cfg.workers, cfg.batch_size, cfg.historical_sync, cfg.confirmations) == ("http://x:1", 7, 100, True, 10)
    assert IngestConfig.load("/nowhere", {}) == IngestConfig()
    (tmp_path / "b.yaml").write_text("end_height: 5\nskip_spend_state: true\n")
    b = BackfillConfig.load(str(tmp_path / "b.yaml"))
    assert b.end_height == 5 and b.skip_spend and not b.skip_balances
    assert read_flat_yaml("a:\n  b: 1\n  c: 'x'\nd: 2") == {"a.b": "1", "a.c": "x", "d": "2"}
    assert overlay(cfg, {"workers": "9"}).workers == 9
    assert os.path.exists(p)


class Node:
    """A node over HTTP that counts what it is asked."""

    def __init__(self, chain, tip):
        node = self
        self.asked, self.tip, self.fail = [], tip, 0

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                q = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                node.auth = self.headers.get("Authorization")
                p = q["params"]
                if q["method"] == "getblock":
                    node.asked.append(int(p[0], 16))
                answers = {"getblockchaininfo": lambda: json.dumps({"blocks": node.tip}), "getblockcount": lambda: str(node.tip), "getblockhash": lambda: json.dumps(f"{p[0]:x}"), "getblock": lambda: (chain / f"{int(p[0], 16)}.json").read_text()}
                body = ('{"error": null, "result": ' + answers[q["method"]]() + "}").encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://u:p@127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()


@pytest.mark.parametrize("historical", [True, False])
def test_each_block_is_fetched_once(spark, chain, tmp_path, historical):
    """The default trigger goes on over batches up to the safe tip, then stops."""
    spark.dataSource.register(rpc.RpcBlocks)
    node, store = Node(chain, 39), Store(spark, str(tmp_path / "s"), 10)
    stream = spark.readStream.format("rpc_blocks").options(url=node.url, batch=12, confirmations=10).load()
    q = ingest.start(spark, stream, store, str(tmp_path / "c"), historical)
    assert q.awaitTermination(300) and q.exception() is None
    node.server.shutdown()
    assert store.last_height() == 29 and sorted(node.asked) == list(range(30))
    assert store.manifest()["ranges"] == [[0, 29]] and store.whole(*STEPS) != historical


def test_new_checkpoint_loses_no_height(spark, chain, tmp_path):
    """The same checkpoint path again, from another height: what is in is passed over, what isn't goes in, batches needn't fall alike."""
    spark.dataSource.register(rpc.RpcBlocks)
    tip(chain, 39)
    store = Store(spark, str(tmp_path / "s"), 10)
    for start, batch, confirmations, want in ((0, 12, 28, 11), (6, 12, 10, 29)):
        stream = spark.readStream.format("rpc_blocks").options(url=f"file:{chain}", start=start, batch=batch, confirmations=confirmations).load()
        q = ingest.start(spark, stream, store, str(tmp_path / "c"), True)
        assert q.awaitTermination(300) and q.exception() is None
        assert store.last_height() == want
        shutil.rmtree(tmp_path / "c")
    assert table(store.facts("blocks"), "height") == [(h,) for h in range(30)]
    raw = spark.read.format("rpc_blocks").options(url=f"file:{chain}", start=0, end=29).load()
    assert not ingest.save(store, raw, again=True)
    other = spark.createDataFrame([(5, (chain / "6.json").read_text())], "height int, block string")
    with pytest.raises(ValueError, match="another hash"):
        ingest.save(store, other, again=True)


def test_names_are_kept(spark, chain, tmp_path):
    store = Store(spark, str(tmp_path), 10)
    raw = spark.createDataFrame([(h, (chain / f"{h}.json").read_text()) for h in range(2)], "height int, block string")
    assert ingest.save(store, raw, "first", historical=True)
    m = store.manifest()
    m["batches"] += [f"b{k}" for k in range(2000)]
    store.append(m, [], {})
    assert not ingest.save(store, raw, "first", historical=True)
    twice = spark.createDataFrame([(7, (chain / "7.json").read_text())] * 2, "height int, block string")
    with pytest.raises(ValueError, match="more than once"):
        ingest.save(store, twice, historical=True)


def test_second_writer_conflicts(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one, two = store.manifest(), store.manifest()
    store.append(one, [], {"spend": [[0, 1]]})
    with pytest.raises(Conflict):
        store.append(two, [], {"spend": [[2, 3]]})
    assert store.manifest()["done"]["spend"] == [[0, 1]]


def test_ranges():
    assert joined([[0, 3]], [[4, 6], [9, 9]]) == [[0, 6], [9, 9]]
    assert common([[0, 6], [9, 12]], [[5, 10]]) == [[5, 6], [9, 10]]
    assert without([[0, 9]], [[3, 4], [9, 20]]) == [[0, 2], [5, 8]]
    assert bridged([[0, 1], [4, 5], [9, 9]], [[7, 7]]) == [[0, 5], [9, 9]] and bridged([], [[1, 2]]) == []


def test_heights_with_gaps(spark):
    heights = spark.createDataFrame([(h,) for h in (3, 4, 9, 1, 5, 12)], "height int")
    assert runs_of(heights) == [[1, 1], [3, 5], [9, 9], [12, 12]] and runs_of(heights.limit(0)) == []


@pytest.mark.parametrize("cuts", [[(0, 19), (20, -1)], [(25, -1), (0, 9), (10, 24)]])
def test_bounded_backfill(spark, chain, tmp_path, cuts):
    """Ranges in any order, and steps one by one, give what one run over all gives; a range done again changes nothing."""
    raw = spark.createDataFrame([(h, (chain / f"{h}.json").read_text()) for h in range(CHAIN)], "height int, block string")
    whole, parts = Store(spark, str(tmp_path / "w"), 10), Store(spark, str(tmp_path / "p"), 10)
    for s in (whole, parts):
        ingest.save(s, raw, historical=True)
    ingest.backfill(whole)
    late = frozenset(["senders", "utxo_counts"])
    for a, b in [*cuts, cuts[0]]:
        ingest.backfill(parts, late, a, b)
    assert not parts.whole("senders") and parts.whole("spend", "receivers", "balances")
    assert parts.derived("address_transactions").where("role = 1").count() == 0
    ingest.backfill(parts, frozenset(STEPS) - late)
    assert derived(parts) == derived(whole)


def test_small_batches_are_merged(spark, chain, tmp_path):
    raw = spark.createDataFrame([(h, (chain / f"{h}.json").read_text()) for h in range(4)], "height int, block string").cache()
    live, bulk = Store(spark, str(tmp_path / "l"), 10), Store(spark, str(tmp_path / "b"), 10)
    for h in range(4):
        ingest.save(live, raw.where(raw.height == h))
        live.tidy(2)
    assert [p["level"] for p in live.manifest()["tables"]["blocks"]] == [2]
    ingest.save(bulk, raw, historical=True)
    ingest.backfill(bulk)
    assert derived(live) == derived(bulk)
    assert table(live.facts("tx_outputs"), "txid", "vout_idx") == table(bulk.facts("tx_outputs"), "txid", "vout_idx")


def test_lookups_read_few_row_groups(spark, chain, tmp_path):
    """An id or address that is in one file only: the other file's row groups are passed over by Bloom filter."""
    store = Store(spark, str(tmp_path), 10)
    raw = spark.createDataFrame([(h, (chain / f"{h}.json").read_text()) for h in range(CHAIN)], "height int, block string")
    ingest.save(store, raw.where("height < 20"), historical=True)
    ingest.save(store, raw.where("height >= 20"), historical=True)
    for name, key in (("transactions", "txid"), ("tx_outputs", "txid"), ("tx_inputs", "prev_txid")):
        t = store.facts(name)
        if name == "tx_inputs":
            once = t.where("prev_txid is not null").groupBy(key).agg(F.max("block_height").alias("h"), F.min("block_height").alias("l")).where("h = l and h < 20")
        else:
            once = t.where("block_height < 20").select(key)
        df = t.where(F.col(key) == F.lit(once.orderBy(key).first()[key]))
        assert "PushedFilters: [IsNotNull" in df._jdf.queryExecution().executedPlan().toString()
        found = df.collect()
        scans, todo = [], [df._jdf.queryExecution().executedPlan()]
        while todo:
            p = todo.pop()
            if "Scan" in p.nodeName():
                scans.append(p.metrics().get("numOutputRows").get().value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
        assert 0 < len(found) <= sum(scans) < t.count()


def test_tip_is_kept_for_a_while(tmp_path):
    now, opts = [0.0], {"url": f"file:{tmp_path}", "batch": "5", "confirmations": "0"}
    s = rpc.RpcStream(opts, clock=lambda: now[0])
    with pytest.raises(OSError):
        s.latestOffset()  # the first answer must come
    (tmp_path / "tip").write_text("7")
    assert s.known_tip() == 7
    (tmp_path / "tip").write_text("9")
    assert s.known_tip() == 7
    now[0] = 6
    assert s.known_tip() == 9
    (tmp_path / "tip").unlink()
    now[0] = 12
    assert s.known_tip() == 9 and s.ask_at == 27
