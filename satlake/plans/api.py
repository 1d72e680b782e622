"""The read side: an address, its history, a transaction, a trace. Each is one lazy plan over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.functions.exprs import direction_name, direction_role, negative, positive, role_name, script_name
from satlake.operators.derive import until_next

STATS = ("tx_count", "first_seen_height", "last_seen_height", "total_received_sats", "total_sent_sats")


def of_address(df: DataFrame, who: DataFrame) -> DataFrame:
    """Rows of the addresses in `who` (column address); a literal filter is pushed down better, so callers with one address use where()."""
    return df.join(who.select("address"), "address", "left_semi")


def moves_of(marked: DataFrame) -> DataFrame:
    """address, txid, block_height, received, sent: a row for each output, and one for each spend of it."""
    zero = F.lit(0).cast("bigint")
    credit = F.struct("txid", "block_height", F.col("value_sats").alias("received"), zero.alias("sent"))
    debit = F.struct(F.col("spending_txid").alias("txid"), F.col("spent_height").alias("block_height"), zero.alias("received"), F.col("value_sats").alias("sent"))
    return marked.where("address is not null").select("address", F.explode(F.when(F.col("is_spent") & F.col("spending_txid").isNotNull(), F.array(credit, debit)).otherwise(F.array(credit))).alias("m")).select("address", "m.*")


def stats(moves: DataFrame) -> DataFrame:
    return moves.groupBy("address").agg(
        F.countDistinct("txid").alias("tx_count"), F.coalesce(F.min("block_height"), F.lit(0)).alias("first_seen_height"), F.coalesce(F.max("block_height"), F.lit(0)).alias("last_seen_height"), F.sum("received").alias("total_received_sats"), F.sum("sent").alias("total_sent_sats")
    )


def info_cached(balances: DataFrame, marked: DataFrame, who: DataFrame) -> DataFrame:
    """The stored row; counts, sums and heights are taken anew from the outputs unless there are none. Balance and unspent count stay as stored."""
    s = stats(moves_of(of_address(marked, who))).select(F.col("address").alias("a"), *[F.col(c).alias(f"s_{c}") for c in STATS])
    b = of_address(balances, who)
    return b.join(s, F.col("address") == F.col("a"), "left").select("address", "balance_sats", "utxo_count", *[F.coalesce(f"s_{c}", c).alias(c) for c in STATS])


def info_of_history(balances: DataFrame, history: DataFrame) -> DataFrame:
    """What info_cached gives, from history rows instead of outputs: both are clustered by address, so a lookup reads a few row groups."""
    moves = history.select("address", "txid", "block_height", positive(F.col("net_value_sats")).alias("received"), negative(F.col("net_value_sats")).alias("sent"))
    s = stats(moves).select(F.col("address").alias("a"), *[F.col(c).alias(f"s_{c}") for c in STATS])
    return balances.join(s, F.col("address") == F.col("a"), "left").select("address", "balance_sats", "utxo_count", *[F.coalesce(f"s_{c}", c).alias(c) for c in STATS])


def info_computed(utxo: DataFrame, marked: DataFrame, who: DataFrame) -> DataFrame:
    """Without a stored row: balance and count from the unspent outputs, the rest from outputs and spends as a set, in which equal rows
    of one transaction collapse. An address without either gives no row."""
    u = of_address(utxo, who).groupBy("address").agg(F.coalesce(F.sum("value_sats"), F.lit(0)).alias("balance_sats"), F.count("*").alias("utxo_count")).withColumnRenamed("address", "a")
    s = stats(moves_of(of_address(marked, who)).distinct())
    return s.join(u, F.col("address") == F.col("a"), "full").select(F.coalesce("address", "a").alias("address"), F.coalesce("balance_sats", F.lit(0)).alias("balance_sats"), F.coalesce("utxo_count", F.lit(0)).alias("utxo_count"), *[F.coalesce(c, F.lit(0)).alias(c) for c in STATS])


def info(balances: DataFrame, utxo: DataFrame, marked: DataFrame, who: DataFrame) -> DataFrame:
    """Stored where there is a row, computed where there is none."""
    missing = who.select("address").join(balances.select("address"), "address", "left_anti")
    return info_cached(balances, marked, who).unionByName(info_computed(utxo, marked, missing))


def history(rows: DataFrame, direction: str | None = None) -> DataFrame:
    """History rows of an address, one a transaction, height and role."""
    role = direction_role(direction)
    kept = rows if role is None else rows.where(F.col("role") == role)
    return kept.groupBy("txid", "block_height", "role").agg(F.max("tx_index").alias("tx_index"), F.max("block_time").alias("block_time"), F.sum("net_value_sats").alias("net_value_sats"))


def history_computed(marked: DataFrame, blocks: DataFrame, direction: str | None = None) -> DataFrame:
    """The same from one address's outputs, for a ledger whose history isn't derived."""
    credit = marked.select("txid", "block_height", F.col("value_sats").alias("net"), F.lit(0).alias("role"))
    debit = marked.where("is_spent").select(F.col("spending_txid").alias("txid"), F.col("spent_height").alias("block_height"), (-F.col("value_sats")).alias("net"), F.lit(1).alias("role"))
    moves = credit.unionByName(debit).where("txid is not null")
    role = direction_role(direction)
    moves = moves if role is None else moves.where(F.col("role") == role)
    sums = moves.groupBy("txid", "block_height", "role").agg(F.sum("net").alias("net_value_sats"))
    b = blocks.select(F.col("height").alias("h"), "block_time")
    return sums.join(b, F.col("block_height") == F.col("h"), "left").select("txid", "block_height", "role", "block_time", "net_value_sats")


def page(rows: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Newest first; ties by place in the block, then id, then role, so that pages don't overlap."""
    keys = ["block_height", *(["tx_index"] if "tx_index" in rows.columns else []), "txid", "role"]
    cut = rows.orderBy(*[F.col(k).desc() for k in keys]).offset(offset).limit(limit)
    return cut.select("txid", "block_height", "block_time", "net_value_sats", role_name(F.col("role")).alias("role"), direction_name(F.col("role")).alias("direction"))


def header(transactions: DataFrame, blocks: DataFrame, txids: DataFrame) -> DataFrame:
    """A transaction with its block; of one id at several heights the lowest."""
    t = transactions.join(txids.select("txid"), "txid", "left_semi")
    b = blocks.select(F.col("height").alias("b_height"), F.col("hash").alias("block_hash"), "block_time")
    return t.join(b, F.col("block_height") == F.col("b_height")).drop("b_height").orderBy("block_height", "txid").limit(1)


def inputs_of(inputs: DataFrame, outputs: DataFrame, txids: DataFrame) -> DataFrame:
    """Inputs with the value and address they spend; a coinbase input has value 0. Of an outpoint that occurs at several heights, the latest not after
    the input counts, so an input stays one row."""
    i = inputs.join(txids.select("txid"), "txid", "left_semi").select("txid", "vin_idx", F.col("block_height").alias("i_height"), "prev_txid", "prev_vout", "sequence_no")
    o = until_next(outputs.select("txid", "vout_idx", "block_height", "value_sats", "address")).withColumnsRenamed({"txid": "o_id", "vout_idx": "o_idx", "block_height": "o_height"})
    mine = (F.col("o_height") <= F.col("i_height")) & (F.col("until").isNull() | (F.col("i_height") < F.col("until")))
    found = i.join(o, (F.col("prev_txid") == F.col("o_id")) & (F.col("prev_vout") == F.col("o_idx")) & mine, "left")
    return found.select("txid", "vin_idx", "prev_txid", "prev_vout", "sequence_no", F.coalesce("value_sats", F.lit(0)).alias("value_sats"), "address")


def outputs_of(marked: DataFrame, txids: DataFrame) -> DataFrame:
    o = marked.join(txids.select("txid"), "txid", "left_semi")
    return o.select("txid", "vout_idx", "value_sats", "address", script_name(F.col("script_type")).alias("script_type"), "is_spent", "spending_txid")


def transaction(transactions: DataFrame, blocks: DataFrame, inputs: DataFrame, outputs: DataFrame, marked: DataFrame, txids: DataFrame) -> DataFrame:
    """One row: header, inputs and outputs as arrays in order."""
    listed = lambda df, key: df.groupBy(F.col("txid").alias(f"{key}_of")).agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != "txid"]))).alias(key))
    h = header(transactions, blocks, txids)
    return h.join(listed(inputs_of(inputs, outputs, txids), "inputs"), F.col("txid") == F.col("inputs_of"), "left").join(listed(outputs_of(marked, txids), "outputs"), F.col("txid") == F.col("outputs_of"), "left").drop("inputs_of", "outputs_of")


def page_numbers(limit: str | None, offset: str | None) -> tuple[int, int]:
    """As the handler reads them: 100 and 0 if absent, 0 if not a number."""
    read = lambda x, default: default if x is None else (int(x) if x.strip().lstrip("+-").isdigit() else 0)
    return read(limit, 100), read(offset, 0)
