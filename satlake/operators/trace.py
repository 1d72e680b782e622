"""Tracing: who spends a transaction's outputs, one step or several, and the edges of the ledger as a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.operators.derive import until_next
from satlake.operators.lineage import cut


def one_hop(spent: DataFrame, txids: DataFrame) -> DataFrame:
    """Distinct transactions that spend outputs of the given ones (column txid)."""
    return spent.join(txids.select(F.col("txid").alias("from_id")), F.col("prev_txid") == F.col("from_id"), "left_semi").select(F.col("spending_txid").alias("txid")).distinct()


def edges(spent: DataFrame) -> DataFrame:
    """Transaction to transaction."""
    return spent.select(F.col("prev_txid").alias("src"), F.col("spending_txid").alias("dst")).distinct()


def spends_edges(outputs: DataFrame) -> DataFrame:
    """Transaction to address, with what is paid."""
    return outputs.where("address is not null").groupBy(F.col("txid").alias("src"), F.col("address").alias("dst")).agg(F.sum("value_sats").alias("value_sats"))


def sends_edges(spent: DataFrame, outputs: DataFrame) -> DataFrame:
    """Address to the transaction that spends from it."""
    o = until_next(outputs).where("address is not null").select(F.col("txid").alias("o_id"), F.col("vout_idx").alias("o_idx"), F.col("block_height").alias("o_height"), "until", "address", "value_sats")
    mine = (F.col("o_height") <= F.col("spent_height")) & (F.col("until").isNull() | (F.col("spent_height") < F.col("until")))
    return spent.join(o, (F.col("prev_txid") == F.col("o_id")) & (F.col("prev_vout") == F.col("o_idx")) & mine).groupBy(F.col("address").alias("src"), F.col("spending_txid").alias("dst")).agg(F.sum("value_sats").alias("value_sats"))


def descendants(spent: DataFrame, txids: DataFrame, depth: int = 10) -> DataFrame:
    """txid, depth: all transactions reached in up to `depth` steps, each at its least depth. Breadth first; what has been seen is left out of
    the next step, so paths that meet again don't multiply."""
    e = cut(edges(spent))  # every step reads it
    seen = cut(txids.select("txid").distinct().select("txid", F.lit(0).alias("depth")))
    last = seen
    for d in range(1, depth + 1):
        step = e.join(last.select(F.col("txid").alias("src")), "src", "left_semi").select(F.col("dst").alias("txid")).distinct()
        last = cut(step.join(seen, "txid", "left_anti").select("txid", F.lit(d).alias("depth")))
        if last.isEmpty():
            break
        seen = seen.unionByName(last)
    return seen.where("depth > 0")
