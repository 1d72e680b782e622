"""Nested block JSON to typed tables.

Input: height int, block string (JSON of one block). decoded() reads the JSON, project() makes the tables of it, each in one narrow pass; nothing is
shuffled, and Python runs nowhere.
A block that isn't JSON, has no list of transactions, or lacks a required hash is an error, as a batch that is committed in part would be worse.
A `coinbase` key with a null value reads as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.functions import exprs as X
from satlake.schemas import BLOCK_JSON, VIN

FEE = "fee"


def decoded(raw: DataFrame) -> DataFrame:
    """height, b: the decoded block."""
    b = F.from_json("block", BLOCK_JSON, {"columnNameOfCorruptRecord": "_corrupt"})
    fine = F.col("b").isNotNull() & F.col("b.tx").isNotNull() & ~F.exists("b.tx", lambda t: t.isNull())
    checked = F.when(fine, F.col("b")).otherwise(F.raise_error(F.concat(F.lit("no list of transactions in block "), F.col("height").cast("string"))).cast(BLOCK_JSON))
    return raw.select("height", b.alias("b")).select(F.col("height").cast("int").alias("height"), checked.alias("b"))


def blocks(d: DataFrame) -> DataFrame:
    fees = F.aggregate(F.transform("b.tx", lambda t: F.coalesce(X.sats(t[FEE]), F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    genesis = F.unhex(F.repeat(F.lit("00"), 32))
    prev = F.when(F.col("b.previousblockhash").isNull() & (F.col("height") == 0), genesis).otherwise(X.hex_lenient(F.col("b.previousblockhash")))
    return d.select(
        "height", X.hex_strict(F.col("b.hash"), "hash").alias("hash"), prev.alias("prev_hash"), X.hex_lenient(F.col("b.merkleroot")).alias("merkle_root"),
        F.timestamp_seconds(X.number(F.col("b.time"))).alias("block_time"), X.bits(F.col("b.bits")).alias("bits"), X.number(F.col("b.nonce")).alias("nonce"),
        F.coalesce("b.version", F.lit(0)).alias("version"), F.coalesce("b.size", F.lit(0)).alias("size_bytes"), F.coalesce("b.weight", F.lit(0)).alias("weight"), F.size("b.tx").alias("tx_count"), fees.alias("total_fees_sats"),
    )


def _transactions(d: DataFrame) -> DataFrame:
    return d.select("height", F.posexplode("b.tx").alias("tx_index", "t")).withColumn("txid", X.hex_strict(F.col("t.txid"), "txid"))


def transactions(d: DataFrame) -> DataFrame:
    vin = F.coalesce("t.vin", F.array().cast(VIN))
    first = F.get(vin, F.lit(0))
    return _transactions(d).select(
        "txid", F.col("height").alias("block_height"), "tx_index", F.coalesce("t.version", F.lit(0)).alias("version"), X.number(F.col("t.locktime")).alias("locktime"),
        *[X.zero_to_null(F.col(f"t.{a}")).alias(b) for a, b in (("size", "size_bytes"), ("vsize", "vsize"), ("weight", "weight"))],
        F.size(vin).alias("input_count"), F.coalesce(F.size("t.vout"), F.lit(0)).alias("output_count"), X.sats(F.col("t.fee")).alias("fee_sats"), F.coalesce(first["coinbase"].isNotNull(), F.lit(False)).alias("is_coinbase"),
        F.exists(vin, lambda v: F.coalesce(F.size(v["txinwitness"]) > 0, F.lit(False))).alias("has_segwit"),
    ).withColumn("output_count", F.greatest("output_count", F.lit(0)))


def inputs(d: DataFrame) -> DataFrame:
    rows = _transactions(d).select("height", "txid", F.posexplode("t.vin").alias("vin_idx", "v"))
    coinbase = F.col("v.coinbase").isNotNull()
    witness = F.when(F.size("v.txinwitness") > 0, F.transform("v.txinwitness", X.hex_lenient))
    return rows.select(
        "txid", "vin_idx", F.col("height").alias("block_height"), F.when(~coinbase, X.hex_strict(F.col("v.txid"), "vin.txid")).alias("prev_txid"), F.when(~coinbase, F.coalesce("v.vout", F.lit(0))).alias("prev_vout"),
        X.hex_lenient(F.col("v.scriptSig.hex")).alias("script_sig"), witness.alias("witness"), X.number(F.col("v.sequence"), X.DEFAULT_SEQUENCE).alias("sequence_no"),
    )


def address_of(script: Column) -> Column:
    """`address`, or else the first of `addresses`; null if there is none."""
    return F.nullif(F.coalesce(F.nullif(script["address"], F.lit("")), F.get(script["addresses"], F.lit(0))), F.lit(""))


def outputs(d: DataFrame) -> DataFrame:
    rows = _transactions(d).select("height", "tx_index", "txid", F.explode("t.vout").alias("o"))
    s = F.col("o.scriptPubKey")
    return rows.select(
        "txid", F.coalesce("o.n", F.lit(0)).alias("vout_idx"), F.col("height").alias("block_height"), F.coalesce(X.sats(F.col("o.value")), F.lit(0).cast("bigint")).alias("value_sats"),
        X.script_code(s["type"]).alias("script_type"), X.hex_lenient(s["hex"]).alias("script_pubkey"), address_of(s).alias("address"), "tx_index",
    )


def receivers(d: DataFrame) -> DataFrame:
    """One row for each output with an address, as it is paid."""
    times = d.select(F.col("height").alias("block_height"), F.timestamp_seconds(X.number(F.col("b.time"))).alias("block_time"), F.posexplode("b.tx").alias("tx_index", "t"))
    rows = times.select("block_height", "block_time", "tx_index", X.hex_strict(F.col("t.txid"), "txid").alias("txid"), F.explode("t.vout").alias("o"))
    return rows.select(address_of(F.col("o.scriptPubKey")).alias("address"), "block_height", "tx_index", "txid", F.lit(0).cast("smallint").alias("role"), F.coalesce(X.sats(F.col("o.value")), F.lit(0).cast("bigint")).alias("net_value_sats"), "block_time").where("address is not null")


def project(d: DataFrame) -> dict[str, DataFrame]:
    """The fact tables of decoded blocks. Where those lie in Parquet, each table reads the nested columns it needs."""
    return {"blocks": blocks(d), "transactions": transactions(d), "tx_outputs": outputs(d).drop("tx_index"), "tx_inputs": inputs(d)}


def tables(raw: DataFrame) -> dict[str, DataFrame]:
    return project(decoded(raw))
