"""Derived tables as functions of the facts. Facts are never changed: spend state is a join, snapshots are queries.

Columns follow the facts' names; keys may be of any type. No side is broadcast by hand: blocks and transactions grow with the chain, so
Catalyst and AQE choose by measured size. Joins and sums on the outpoint or the address share their partitioning where they can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.functions.exprs import BUCKET, RECEIVER, SENDER, height_bucket, negative, positive

HISTORY_KEY = ("address", "block_height", "tx_index", "txid", "role")


def height_between(df: DataFrame, low: int, high: int, width: int = BUCKET) -> DataFrame:
    """Rows of heights low to high, both inclusive; also by bucket where the table has that partition column, which Catalyst can't infer."""
    out = df.where(F.col("block_height").between(low, high))
    return out.where(F.col("height_bucket").between(low // width, high // width)) if "height_bucket" in df.columns else out


def with_bucket(df: DataFrame, width: int = BUCKET) -> DataFrame:
    return df.withColumn("height_bucket", height_bucket(F.col("block_height"), width))


def spends(inputs: DataFrame) -> DataFrame:
    """One row for each spent outpoint: prev_txid, prev_vout, spending_txid, spending_vin, spent_height. Of several spends the first counts.

    By a window rather than a minimum of structs: that would sort before the shuffle too, and this sort serves a join on the outpoint next."""
    real = inputs.where(F.col("prev_txid").isNotNull() & F.col("prev_vout").isNotNull())
    before = F.lag(F.lit(1)).over(Window.partitionBy("prev_txid", "prev_vout").orderBy("block_height", "txid", "vin_idx"))
    named = real.select("prev_txid", "prev_vout", F.col("txid").alias("spending_txid"), F.col("vin_idx").alias("spending_vin"), F.col("block_height").alias("spent_height"), before.alias("before"))
    return named.where("before is null").drop("before")


def until_next(outputs: DataFrame) -> DataFrame:
    """Outputs with `until`: the next height at which the same outpoint occurs again, null for all but a few early ones. An input spends the output whose
    height is not after its own and whose `until` is. The window has the partitioning that a join on the outpoint needs."""
    return outputs.withColumn("until", F.lead("block_height").over(Window.partitionBy("txid", "vout_idx").orderBy("block_height")))


def outputs_with_spend(outputs: DataFrame, spent: DataFrame) -> DataFrame:
    """Outputs with is_spent and the spend's columns. Should an outpoint occur at several heights, its spend belongs to the latest output
    not after it; the window has the join's partitioning and order, so that costs no shuffle."""
    joined = outputs.join(spent, (F.col("txid") == F.col("prev_txid")) & (F.col("vout_idx") == F.col("prev_vout")), "left")
    source = F.max(F.when(F.col("block_height") <= F.col("spent_height"), F.col("block_height"))).over(Window.partitionBy("txid", "vout_idx"))
    mine = F.coalesce(F.col("block_height") == source, F.lit(False))
    kept = [F.when(mine, F.col(c)).alias(c) for c in ("spending_txid", "spending_vin", "spent_height")]
    return joined.select(*[F.col(c) for c in outputs.columns], mine.alias("is_spent"), *kept)


def source_heights(spent: DataFrame, utxo: DataFrame) -> DataFrame:
    """Spends with the height of the output they spend, null where the outpoint isn't among the unspent ones given."""
    keys = utxo.select(F.col("txid").alias("k"), F.col("vout_idx").alias("i"), F.col("block_height").alias("h"))
    out = spent.join(keys, (F.col("prev_txid") == F.col("k")) & (F.col("prev_vout") == F.col("i")) & (F.col("h") <= F.col("spent_height")), "left")
    return out.groupBy(*spent.columns).agg(F.max("h").alias("source_height"))


def mark_spent_pruned(outputs: DataFrame, spent: DataFrame) -> DataFrame:
    """Outputs that spends with a known source_height mark: the join also has the height, so only those partitions are read."""
    s = spent.where("source_height is not null")
    return outputs.join(s, (F.col("txid") == F.col("prev_txid")) & (F.col("vout_idx") == F.col("prev_vout")) & (F.col("block_height") == F.col("source_height")))


def utxo_set(outputs: DataFrame, spent: DataFrame) -> DataFrame:
    held = outputs.where(F.col("address").isNotNull())
    return held.join(spent, (F.col("txid") == F.col("prev_txid")) & (F.col("vout_idx") == F.col("prev_vout")) & (F.col("block_height") <= F.col("spent_height")), "left_anti")


def utxo_counts(utxo: DataFrame) -> DataFrame:
    return utxo.groupBy("address").agg(F.count("*").alias("utxo_count"), F.sum("value_sats").alias("utxo_sats"))


def _with_tx(rows: DataFrame, transactions: DataFrame, blocks: DataFrame, txid: str, height: str) -> DataFrame:
    t = transactions.select(F.col("txid").alias("t_id"), F.col("block_height").alias("t_height"), "tx_index")
    b = blocks.select(F.col("height").alias("b_height"), "block_time")
    return rows.join(t, (F.col(txid) == F.col("t_id")) & (F.col(height) == F.col("t_height"))).join(b, F.col(height) == F.col("b_height"))


def receiver_rows(outputs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """What each address is paid by a transaction: role 0. Sums first, so the joins move a row a key."""
    paid = outputs.where(F.col("address").isNotNull()).groupBy("txid", "block_height", "address").agg(F.sum("value_sats").alias("net_value_sats"))
    return _with_tx(paid, transactions, blocks, "txid", "block_height").select("address", "block_height", "tx_index", "txid", F.lit(RECEIVER).alias("role"), "net_value_sats", "block_time")


def sender_deltas(spent: DataFrame, outputs: DataFrame) -> DataFrame:
    """address, block_height (of the spend), txid (the spending one), delta (negative): a row for each spent output with an address."""
    o = outputs.where(F.col("address").isNotNull()).select(F.col("txid").alias("o_id"), F.col("vout_idx").alias("o_idx"), F.col("block_height").alias("o_height"), "address", "value_sats")
    found = spent.join(o, (F.col("prev_txid") == F.col("o_id")) & (F.col("prev_vout") == F.col("o_idx")) & (F.col("o_height") <= F.col("spent_height")))
    return found.select("address", F.col("spent_height").alias("block_height"), F.col("spending_txid").alias("txid"), (-F.col("value_sats")).alias("delta"))


def sender_rows(spent: DataFrame, outputs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """What each address spends in a transaction: role 1, negative."""
    return sender_rows_of(sender_deltas(spent, outputs), transactions, blocks)


def sender_rows_of(deltas_: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """The same from debits: address, block_height, txid, delta."""
    sent = deltas_.groupBy("txid", "block_height", "address").agg(F.sum("delta").alias("net_value_sats"))
    return _with_tx(sent, transactions, blocks, "txid", "block_height").select("address", "block_height", "tx_index", "txid", F.lit(SENDER).alias("role"), "net_value_sats", "block_time")


def address_transactions(outputs: DataFrame, spent: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    return receiver_rows(outputs, transactions, blocks).unionByName(sender_rows(spent, outputs, transactions, blocks))


def sum_history(rows: DataFrame) -> DataFrame:
    """History rows of one key summed up; a key has one block and so one time."""
    return rows.groupBy(*HISTORY_KEY).agg(F.sum("net_value_sats").alias("net_value_sats"), F.min("block_time").alias("block_time"))


def deltas(marked: DataFrame) -> DataFrame:
    """Credits and debits by address from outputs with spend state: address, txid, block_height, delta, and `open`, 1 for a credit and -1 for a
    debit, so that its sum up to any height is the number of outputs unspent there. One scan gives both."""
    credit = F.struct("txid", F.col("block_height").alias("block_height"), F.col("value_sats").alias("delta"), F.lit(1).alias("open"))
    debit = F.struct(F.col("spending_txid").alias("txid"), F.col("spent_height").alias("block_height"), (-F.col("value_sats")).alias("delta"), F.lit(-1).alias("open"))
    held = marked.where(F.col("address").isNotNull())
    return held.select("address", F.explode(F.when(F.col("is_spent"), F.array(credit, debit)).otherwise(F.array(credit))).alias("d")).select("address", "d.*")


def balances(moves: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Balances from credits and debits. The transactions of an address are counted by two sums: rows of (address, txid) first, so a hot address is no hot task.
    utxo_count comes from `counts`, or else from `open` if moves have it, or is left out."""
    opened = counts is None and "open" in moves.columns
    first = [F.sum("open").alias("open")] if opened else []
    pairs = moves.groupBy("address", "txid").agg(
        F.sum("delta").alias("delta"), F.sum(positive(F.col("delta"))).alias("received"), F.sum(negative(F.col("delta"))).alias("sent"), F.min("block_height").alias("first"), F.max("block_height").alias("last"), *first
    )
    out = pairs.groupBy("address").agg(
        F.sum("delta").alias("balance_sats"), F.sum("received").alias("total_received_sats"), F.sum("sent").alias("total_sent_sats"), F.count("*").alias("tx_count"), F.min("first").alias("first_seen_height"), F.max("last").alias("last_seen_height"),
        *([F.sum("open").alias("utxo_count")] if opened else []),
    )
    return out if counts is None else with_counts(out, counts)


def with_counts(balances_: DataFrame, counts: DataFrame) -> DataFrame:
    """Balances with the counts put in. An address without one keeps the count that it has, or gets 0 where balances have none."""
    c = counts.select(F.col("address").alias("c_address"), F.col("utxo_count").alias("c"))
    old = F.col("utxo_count") if "utxo_count" in balances_.columns else F.lit(0)
    return balances_.join(c, F.col("address") == F.col("c_address"), "left").select(*[F.col(x) for x in balances_.columns if x != "utxo_count"], F.coalesce(F.col("c"), old).alias("utxo_count"))


def balances_of(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Facts to balances, unspent counts included, with one join and two sums."""
    return balances(deltas(outputs_with_spend(outputs.select("txid", "vout_idx", "block_height", "address", "value_sats"), spends(inputs))))


def height_deltas(moves: DataFrame) -> DataFrame:
    """Sums by address over sums by (address, height); tx_delta counts heights, a variant of counting transactions."""
    by_height = moves.groupBy("address", "block_height").agg(F.sum("delta").alias("delta"), F.sum(positive(F.col("delta"))).alias("received"), F.sum(negative(F.col("delta"))).alias("sent"))
    return by_height.groupBy("address").agg(F.sum("delta").alias("delta_sats"), F.sum("received").alias("received_sats"), F.sum("sent").alias("sent_sats"), F.count("*").alias("tx_delta"), F.min("block_height").alias("first_height"), F.max("block_height").alias("last_height"))


def fold_balances(parts: DataFrame) -> DataFrame:
    """Partial balances of an address summed up, in any order and grouping: sums and counts add, heights widen."""
    sums = ("balance_sats", "total_received_sats", "total_sent_sats", "tx_count", "utxo_count")
    return parts.groupBy("address").agg(*[F.sum(c).alias(c) for c in sums], F.min("first_seen_height").alias("first_seen_height"), F.max("last_seen_height").alias("last_seen_height"))


def merge_balances(old: DataFrame, delta: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Old balances and those of a batch of new blocks: sums add, heights widen. A transaction lies in one block, so counts of transactions of different
    blocks add too; so do unspent counts, unless `counts` replaces them."""
    cols = ["address", "balance_sats", "total_received_sats", "total_sent_sats", "tx_count", "first_seen_height", "last_seen_height"]
    if counts is None:
        return fold_balances(old.unionByName(delta))
    merged = fold_balances(old.select(*cols, F.lit(0).alias("utxo_count")).unionByName(delta.select(*cols, F.lit(0).alias("utxo_count"))))
    return with_counts(merged.select(*cols), counts)


def insert_ignore(old: DataFrame, new: DataFrame, key: tuple[str, ...] = HISTORY_KEY) -> DataFrame:
    """The rows of `new` that an insert ignoring conflicts on the key adds to `old`."""
    return new.dropDuplicates(list(key)).join(old.select(*key), list(key), "left_anti")


def verify_report(marked: DataFrame, history: DataFrame, balances_: DataFrame, utxo: DataFrame, last_height: DataFrame) -> DataFrame:
    """metric, value: what is looked at after a backfill; negative balances should be 0. last_height: one row, one column."""
    per = lambda df, **aggs: df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in aggs.items()])
    parts = [
        per(balances_, address_balances=F.count("*"), negative_balances=F.count_if(F.col("balance_sats") < 0)),
        per(history, address_transactions=F.count("*"), receiver_rows=F.count_if(F.col("role") == RECEIVER), sender_rows=F.count_if(F.col("role") == SENDER)),
        per(marked, spent_outputs=F.count_if("is_spent")),
        per(utxo, utxo_set=F.count("*")),
        last_height.select(F.coalesce(F.col(last_height.columns[0]), F.lit(-1)).cast("bigint").alias("last_height")),
    ]
    rows = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in p.columns])).alias("x")).select("x.*") for p in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their number: empty where the key is one."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_key(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """df, after a check that it has those columns and no key twice."""
    if missing := [k for k in key if k not in df.columns]:
        raise ValueError(f"no key column {', '.join(missing)}")
    if found := duplicate_keys(df, key).head(1):
        raise ValueError(f"key {key} occurs {found[0].n} times: {found[0]}")
    return df
