"""The three services: indexer, backfill and api. `python -m satlake indexer --config config.yaml` and so on; SIGINT and SIGTERM stop them after the batch at hand."""

from __future__ import annotations

import argparse
import logging
import signal
import threading
import uuid

from pyspark.sql import SparkSession

from satlake.config import BackfillConfig, IngestConfig
from satlake.functions.exprs import split_heights
from satlake.operators import derive
from satlake.sources import http, rpc
from satlake.sources.store import STEPS, Store
from satlake.streaming import ingest

log = logging.getLogger("satlake")
RETRY_SECONDS = 15.0
POLL = "10s"  # how long a stream that is caught up waits before it looks for blocks again


def session() -> SparkSession:
    return SparkSession.builder.appName("satlake").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.streaming.pollingDelay", POLL).getOrCreate()


def first_height(store: Store, cfg: IngestConfig) -> int:
    """Where an indexer begins: the setting if it is above 0, else after the store's last height, which is -1 for an empty store."""
    return cfg.start_height if cfg.start_height > 0 else store.last_height() + 1


def options(cfg: IngestConfig) -> dict:
    return {"url": cfg.rpc_url, "user": cfg.rpc_user, "password": cfg.rpc_password, "partitions": cfg.workers, "batch": cfg.batch_size, "confirmations": cfg.confirmations}


def progress(store: Store, cfg: IngestConfig) -> dict:
    """How far the store is behind the node."""
    last, tip = store.last_height(), rpc.client(options(cfg)).block_count()
    return {"indexed_height": last, "tip": tip, "behind": tip - last}


def indexer(spark: SparkSession, cfg: IngestConfig, stop: threading.Event, once: bool = False, retry: float = RETRY_SECONDS) -> Store:
    """Follow the node until `stop` is set; once: until caught up. The store alone knows what is in: every start has a checkpoint of its own and begins
    after the store's last height, so a lost checkpoint loses nothing. A failed range is tried again after `retry` seconds."""
    spark.dataSource.register(rpc.RpcBlocks)
    store = Store(spark, cfg.store_url)
    at = first_height(store, cfg)
    while not stop.is_set():
        checkpoint = f"checkpoint/{uuid.uuid4().hex}"
        try:
            log.info("from height %d, %s", at, progress(store, cfg))
            blocks = spark.readStream.format("rpc_blocks").options(start=at, **options(cfg)).load()
            query = ingest.start(spark, blocks, store, f"{store.root}/{checkpoint}", cfg.historical_sync, None if once else "0 seconds")
            while not stop.is_set() and not query.awaitTermination(1):
                pass
            query.stop()
            at = max(at, store.last_height() + 1)
            if once and query.exception() is None:
                return store
        except Exception:
            at = max(at, store.last_height() + 1)
            log.exception("ingest failed, from height %d again in %s s", at, retry)
            stop.wait(retry)
        finally:
            store.drop(checkpoint)
    return store


def backfill(spark: SparkSession, cfg: BackfillConfig) -> dict[str, int]:
    """Derive what is missing between the settings' heights, then report. Where a batch size is set, a commit holds so many heights."""
    store = Store(spark, cfg.store_url)
    end = store.last_height() if cfg.end_height < 0 else cfg.end_height
    if cfg.start_height <= end:
        for a, b in split_heights(cfg.start_height, end, cfg.batch_size or end - cfg.start_height + 1):
            ingest.backfill(store, cfg.skipped(), a, b)
            store.tidy()
    history = store.derived("address_transactions")
    if history is not None:
        derive.require_key(history, derive.HISTORY_KEY)
    return report(store)


def report(store: Store) -> dict[str, int]:
    """What is looked at after a backfill; negative balances should be 0."""
    if not store.whole(*STEPS):
        return {"last_height": store.last_height()}
    b, h, u = (store.derived(t) for t in ("address_balances", "address_transactions", "utxo_set"))
    marked = derive.outputs_with_spend(store.facts("tx_outputs"), derive.spends(store.facts("tx_inputs")))
    rows = derive.verify_report(marked, h, b, u, store.spark.createDataFrame([(store.last_height(),)], "h int"))
    return {r.metric: r.value for r in rows.collect()}


def api(spark: SparkSession, cfg: IngestConfig, stop: threading.Event, host: str = "0.0.0.0") -> int:  # noqa: S104
    """Serve the read side until `stop` is set; the port."""
    web = http.server(Store(spark, cfg.store_url), cfg.port, host)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    port = web.server_port
    stop.wait()
    web.shutdown()
    web.server_close()
    return port


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="satlake")
    p.add_argument("service", choices=["indexer", "backfill", "api"])
    p.add_argument("--config", help="a YAML file; the environment comes after it")
    p.add_argument("--once", action="store_true", help="indexer: stop when caught up")
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    stop = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: stop.set())
    spark = session()
    try:
        if a.service == "backfill":
            for metric, value in backfill(spark, BackfillConfig.load(a.config) if a.config else BackfillConfig()).items():
                print(metric, value)
        elif a.service == "indexer":
            indexer(spark, IngestConfig.load(a.config), stop, a.once)
        else:
            api(spark, IngestConfig.load(a.config), stop)
    finally:
        spark.stop()
