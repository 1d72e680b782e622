"""Ingest as a stream: blocks in, facts and changes of the derived tables committed a micro-batch at a time.

A micro-batch is written to staging first, decoded: every block is fetched and its JSON read once, and a replay that finds it committed sees it by its heights.
In historical mode only facts are written, and backfill() derives the rest afterwards; otherwise each batch adds its changes to the derived logs. What it
reads beside its own rows is the outputs that it spends, looked up in the log of open outputs by a semi-join; what it writes grows with the batch alone.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.operators import derive, parse
from satlake.sources.store import STEPS, Ranges, Store, bridged, common, fold, inside, runs_of, without

Changes = list[tuple[str, DataFrame]]
OUTPUT = ("txid", "vout_idx", "block_height", "value_sats", "script_type", "address")


def changes(outputs: DataFrame, spent: DataFrame, transactions: DataFrame, blocks: DataFrame, heights: Ranges, steps: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> Changes:
    """What the blocks of these heights change in the derived tables.

    outputs: those of the heights and at least all that their inputs spend; spent: the heights' spends. An output spent in its own batch opens and closes at once and leaves no row.
    """
    marked = stage(derive.outputs_with_spend(outputs.select(*OUTPUT), spent))
    own = inside(heights, F.col("block_height"))
    held = marked.where("address is not null")
    out: Changes = []
    if "spend" in steps:
        change = F.when(own & ~F.col("is_spent"), 1).when(~own & F.col("is_spent"), -1)
        out.append(("outputs_open", marked.select(*OUTPUT, change.alias("change")).where("change is not null")))
    rows = []
    if "receivers" in steps:
        rows.append(derive.receiver_rows(held.where(own), transactions, blocks))
    if "senders" in steps:
        sent = held.where("is_spent").select("address", F.col("spent_height").alias("block_height"), F.col("spending_txid").alias("txid"), (-F.col("value_sats")).alias("delta"))
        rows.append(derive.sender_rows_of(sent, transactions, blocks))
    if rows:
        out.append(("address_transactions", rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])))
    if "balances" in steps or "utxo_counts" in steps:
        moves = derive.deltas(held)
        b = derive.balances(moves.where((F.col("open") < 0) | inside(heights, F.col("block_height"))))
        zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("int")
        if "balances" not in steps:
            b = b.select("address", *[zero.alias(c) for c in ("balance_sats", "total_received_sats", "total_sent_sats", "tx_count")], none.alias("first_seen_height"), none.alias("last_seen_height"), "utxo_count")
        elif "utxo_counts" not in steps:
            b = b.withColumn("utxo_count", zero)
        out.append(("address_balances", b))
    return out


def touched(store: Store, spent: DataFrame) -> DataFrame | None:
    """The open outputs that these spends spend. The log is cut to them before it is folded, so only they are shuffled for that."""
    log = store.log("outputs_open")
    if log is None:
        return None
    keys = spent.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("vout_idx"))
    return fold("outputs_open", log.join(keys, ["txid", "vout_idx"], "left_semi")).where("change > 0").drop("change")


def live(store: Store, new: dict[str, DataFrame], heights: Ranges, stage: Callable[[DataFrame], DataFrame]) -> Changes:
    """A batch's changes, beside a store whose own blocks are all derived."""
    spent = derive.spends(new["tx_inputs"])
    fresh, old = new["tx_outputs"].select(*OUTPUT), touched(store, spent)
    return changes(fresh if old is None else fresh.unionByName(old.select(*OUTPUT)), spent, new["transactions"], new["blocks"], heights, STEPS, stage)


def backfill(store: Store, skip: frozenset[str] = frozenset(), start: int = 0, end: int = -1) -> None:
    """Derive from the facts of heights start to end (-1: the highest) what hasn't been yet, each step that isn't skipped (names as in STEPS). Steps that lack the same heights
    share one join of outputs and spends; all changes appear at once. Ranges may be done in any order, as changes add up."""
    m = store.manifest()
    asked = common(m["ranges"], [[start, end if end >= 0 else 1 << 31]])
    todo = {s: without(asked, m["done"][s]) for s in STEPS if s not in skip}
    groups: dict[str, tuple[str, ...]] = {}
    for s, r in todo.items():
        if r:
            groups[repr(r)] = (*groups.get(repr(r), ()), s)
    if not groups:
        return
    f = {t: store.facts(t) for t in ("blocks", "transactions", "tx_outputs", "tx_inputs")}
    found: Changes = []
    with store.staging() as stage:
        for steps in groups.values():
            heights = bridged(todo[steps[0]], without(m["ranges"], todo[steps[0]]))
            low, high = heights[0][0], heights[-1][1]
            cut = lambda df: derive.height_between(df, low, high, store.width).where(inside(heights, F.col("block_height")))  # noqa: B023, E731
            outputs = derive.height_between(f["tx_outputs"], 0, high, store.width)
            spent = derive.spends(cut(f["tx_inputs"]))
            found += changes(outputs, spent, cut(f["transactions"]), f["blocks"].where(inside(heights, F.col("height"))), heights, steps, stage)
        store.append(m, found, todo)


def unseen(store: Store, decoded: DataFrame) -> DataFrame:
    """The blocks whose heights the store doesn't have. One that it has with another hash is an error: confirmations were too few."""
    heights = runs_of(decoded.select("height"))
    known = common(store.manifest()["ranges"], heights)
    if not known:
        return decoded
    known = bridged(known, without(heights, known))
    ours = store.facts("blocks").where(inside(known, F.col("height"))).select(F.col("height").alias("h"), F.lower(F.hex("hash")).alias("ours"))
    other = decoded.where(inside(known, F.col("height"))).join(ours, F.col("height") == F.col("h")).where(F.lower("b.hash") != F.col("ours")).select("height").head(1)
    if other:
        raise ValueError(f"height {other[0].height} is in the store with another hash")
    return decoded.where(~inside(known, F.col("height")))


def save(store: Store, raw: DataFrame, batch: str | None = None, historical: bool = False, again: bool = False) -> bool:
    """Parse and commit one batch of (height, block). False if there was nothing new: no blocks, or a batch of this name is in. again: blocks whose heights
    are in already are passed over, as a stream that starts anew sends some; else they are an error. Without historical, what the store's
    own blocks lack is derived first."""
    if batch is not None and batch in store.manifest()["batches"]:
        return False
    with store.staging() as stage:
        decoded = stage(parse.decoded(raw))
        if again:
            decoded = unseen(store, decoded)
        heights = runs_of(decoded.select("height"))
        if not heights:
            return False
        if not historical:
            backfill(store)
        own = bridged(heights, store.manifest()["ranges"])
        return store.commit(parse.project(decoded), heights, batch, None if historical else lambda new: live(store, new, own, stage))


def start(spark: SparkSession, blocks: DataFrame, store: Store, checkpoint: str, historical: bool = False, every: str | None = None):
    """A running query over a stream of (height, block). every: a trigger interval; None: batch after batch until the stream has no more, then stop.

    (A trigger of all that is available would plan one batch to the source's first answer, and sources here answer with no more than a batch.)"""

    def arrive(df: DataFrame, _: int) -> None:
        if save(store, df, None, historical, again=True):
            store.tidy()

    query = blocks.writeStream.foreachBatch(arrive).option("checkpointLocation", checkpoint).trigger(processingTime=every or "0 seconds").start()
    if every is None:

        def finish() -> None:
            try:
                query.processAllAvailable()
            except Exception:  # noqa: S110  the query has ended and tells why itself
                pass
            finally:
                query.stop()

        threading.Thread(target=finish, daemon=True).start()
    return query


