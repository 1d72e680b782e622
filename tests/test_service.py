import json
import threading
import time
import urllib.request

import pytest

from satlake import service
from satlake.config import BackfillConfig, IngestConfig
from satlake.sources import rpc
from satlake.sources.store import STEPS, Store
from tests.test_stream import CHAIN, chain, derived, tip  # noqa: F401


def write(path, **values):
    path.write_text("".join(f"{k}: {v}\n" for k, v in values.items()))
    return str(path)


def test_indexer_resumes_from_the_store(spark, chain, tmp_path):  # noqa: F811
    """Settings drive the services: two runs of the indexer, then the backfill in ranges; no checkpoint is shared."""
    cfg = IngestConfig.load(write(tmp_path / "c.yaml", store_url=tmp_path / "s", rpc_url=f"file:{chain}", batch_size=12, workers=3), {})
    assert cfg.historical_sync and cfg.port == 8080
    tip(chain, 21)
    store = service.indexer(spark, cfg, threading.Event(), once=True)
    assert store.last_height() == 11 and service.progress(store, cfg) == {"indexed_height": 11, "tip": 21, "behind": 10}
    tip(chain, 39)
    assert service.first_height(store, cfg) == 12
    service.indexer(spark, cfg, threading.Event(), once=True)
    assert store.last_height() == 29 and store.manifest()["ranges"] == [[0, 29]]
    some = BackfillConfig.load(write(tmp_path / "b.yaml", store_url=tmp_path / "s", batch_size=8, end_height=15, skip_spend_state="true"))
    assert service.backfill(spark, some) == {"last_height": 29}
    assert store.manifest()["done"]["spend"] == [] and store.manifest()["done"]["senders"] == [[0, 15]]
    report = service.backfill(spark, BackfillConfig(store_url=str(tmp_path / "s")))
    assert report["negative_balances"] == 0 and report["last_height"] == 29 and report["utxo_set"] == store.derived("utxo_set").count()
    live = service.indexer(spark, IngestConfig.load(None, {"RPC_URL": f"file:{chain}", "DATABASE_URL": str(tmp_path / "live"), "HISTORICAL_SYNC": "false", "BATCH_SIZE": "20", "WORKERS": "x"}), threading.Event(), once=True)
    assert live.whole(*STEPS) and derived(live) == derived(store)


def test_failed_range_is_tried_again(spark, chain, tmp_path):  # noqa: F811
    cfg = IngestConfig(store_url=str(tmp_path / "s"), rpc_url=f"file:{chain}", batch_size=100, confirmations=0)
    tip(chain, CHAIN)  # one block more than there is
    stop = threading.Event()
    t = threading.Thread(target=service.indexer, args=(spark, cfg, stop), kwargs={"retry": 0.1})
    t.start()
    time.sleep(3)
    tip(chain, CHAIN - 1)
    store = Store(spark, cfg.store_url)
    for _ in range(300):
        if store.last_height() == CHAIN - 1:
            break
        time.sleep(0.2)
    stop.set()
    t.join(60)
    assert not t.is_alive() and store.last_height() == CHAIN - 1


def test_api(spark, tmp_path):
    stop, cfg = threading.Event(), IngestConfig(store_url=str(tmp_path), port=18979)
    t = threading.Thread(target=service.api, args=(spark, cfg, stop, "127.0.0.1"))
    t.start()
    for _ in range(50):
        try:
            with urllib.request.urlopen("http://127.0.0.1:18979/btc/tx/00/trace") as r:
                assert json.loads(r.read())["descendants"] == []
            break
        except urllib.error.URLError:
            time.sleep(0.1)
    else:
        pytest.fail("no answer")
    stop.set()
    t.join(10)
    assert not t.is_alive()


def test_environment():
    env = {"PORT": "9", "SATLAKE_PORT": "10", "HISTORICAL_SYNC": "maybe", "START_HEIGHT": "5", "path": "x"}
    cfg = IngestConfig.load(None, env)
    assert (cfg.port, cfg.historical_sync, cfg.start_height) == (10, True, 5)
    c = rpc.Client("http://me:pass%20word@host:1/x")
    assert c.url == "http://host:1/x" and c.auth == rpc.Client("http://host", "me", "pass word").auth
