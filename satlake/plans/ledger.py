"""The ledger as views over the star-schema tables of a folder: orders are transactions, line items their outputs, days are blocks.

An output whose line status is F is spent by the same customer's next order; a customer's first order is a coinbase. Keys are longs. SQL below
says the same to DuckDB.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.operators import derive

WIDTH = 1000
SEQUENCE = 4294967294


class Ledger:
    """Lazy views; each is built once and never cached in memory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        height = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
        by_day = Window.partitionBy("o_orderdate").orderBy("o_orderkey")
        by_customer = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
        return (
            self.table("orders")
            .withColumn("block_height", height)
            .withColumn("tx_index", (F.row_number().over(by_day) - 1).cast("int"))
            .withColumn("is_coinbase", F.row_number().over(by_customer) == 1)
            .withColumn("next_txid", F.lead("o_orderkey").over(by_customer))
            .withColumn("next_height", F.lead("block_height").over(by_customer))
            .withColumnRenamed("o_orderkey", "txid")
        )

    @cached_property
    def blocks(self) -> DataFrame:
        height = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("height")
        days = self.table("orders").groupBy(height, F.col("o_orderdate").alias("block_time")).agg(F.count("*").cast("int").alias("tx_count"))
        return days.select("height", F.sha2(F.concat(F.lit("block:"), F.col("height").cast("string")), 256).alias("hash"), "block_time", "tx_count")

    @cached_property
    def transactions(self) -> DataFrame:
        fee = F.when(~F.col("is_coinbase"), F.round(F.col("o_totalprice") * 100).cast("bigint") % 10000)
        return self.orders.select("txid", "block_height", "tx_index", "is_coinbase", fee.alias("fee_sats"))

    @cached_property
    def _items(self) -> DataFrame:
        every = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*every))
        address = F.when(~((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)), F.concat(F.lit("addr"), F.col("l_suppkey").cast("string")))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("txid"), (n - 1).cast("int").alias("vout_idx"), (F.col("l_quantity").cast("bigint") * 1000000).alias("value_sats"), (F.col("l_linenumber") % 8).cast("int").alias("script_type"), address.alias("address"), "l_linestatus"
        )

    @cached_property
    def outputs(self) -> DataFrame:
        o = self.orders.select(F.col("txid").alias("t"), "block_height")
        return self._items.join(o, F.col("txid") == F.col("t")).select("txid", "vout_idx", "block_height", "value_sats", "script_type", "address")

    @cached_property
    def inputs(self) -> DataFrame:
        o = self.orders.where("next_txid is not null").select(F.col("txid").alias("t"), "next_txid", "next_height")
        spent = self._items.where("l_linestatus = 'F'").join(o, F.col("txid") == F.col("t"))
        number = F.row_number().over(Window.partitionBy("next_txid").orderBy("txid", "vout_idx")) - 1
        real = spent.select(F.col("next_txid").alias("txid"), number.cast("int").alias("vin_idx"), F.col("next_height").alias("block_height"), F.col("txid").alias("prev_txid"), F.col("vout_idx").alias("prev_vout"))
        none = self.orders.where("is_coinbase").select("txid", F.lit(0).alias("vin_idx"), "block_height", F.lit(None).cast("bigint").alias("prev_txid"), F.lit(None).cast("int").alias("prev_vout"))
        return real.unionByName(none).withColumn("sequence_no", F.lit(SEQUENCE).cast("bigint"))

    @cached_property
    def spends(self) -> DataFrame:
        return derive.spends(self.inputs)

    @cached_property
    def marked(self) -> DataFrame:
        return derive.outputs_with_spend(self.outputs, self.spends)

    @cached_property
    def utxo(self) -> DataFrame:
        return derive.utxo_set(self.outputs, self.spends)

    @cached_property
    def history(self) -> DataFrame:
        return derive.address_transactions(self.outputs, self.spends, self.transactions, self.blocks)

    @cached_property
    def balances(self) -> DataFrame:
        return derive.balances_of(self.outputs, self.inputs)

    def before(self, height: int, above: bool = False) -> Ledger:
        """The ledger's facts up to that height, or above it only."""
        part = Ledger(self.spark, self.dir)
        for name, col in (("blocks", "height"), ("transactions", "block_height"), ("outputs", "block_height"), ("inputs", "block_height")):
            c = F.col(col)
            part.__dict__[name] = getattr(self, name).where(c > height if above else c <= height)
        return part


CTES = {
    "tx0": """SELECT o_orderkey AS txid, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS block_height,
        CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS INTEGER) AS tx_index,
        row_number() OVER c = 1 AS is_coinbase, lead(o_orderkey) OVER c AS next_txid,
        CAST(lead(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE))) OVER c AS INTEGER) AS next_height, o_totalprice, o_orderdate
        FROM orders WINDOW c AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "blocks": """SELECT height, sha256('block:' || height) AS hash, block_time, tx_count FROM (SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS height,
        o_orderdate AS block_time, CAST(count(*) AS INTEGER) AS tx_count FROM orders GROUP BY 1, 2)""",
    "transactions": """SELECT txid, block_height, tx_index, is_coinbase, CASE WHEN NOT is_coinbase THEN CAST(round(o_totalprice * 100) AS BIGINT) % 10000 END AS fee_sats FROM tx0""",
    "items": """SELECT l_orderkey AS txid, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate) - 1 AS INTEGER) AS vout_idx, CAST(l_quantity AS BIGINT) * 1000000 AS value_sats, CAST(l_linenumber % 8 AS INTEGER) AS script_type,
        CASE WHEN NOT (l_returnflag = 'A' AND l_linenumber = 1) THEN 'addr' || l_suppkey END AS address, l_linestatus FROM lineitem""",
    "outputs": """SELECT i.txid, vout_idx, block_height, value_sats, script_type, address FROM items i JOIN tx0 ON tx0.txid = i.txid""",
    "inputs": f"""SELECT next_txid AS txid, CAST(row_number() OVER (PARTITION BY next_txid ORDER BY i.txid, vout_idx) - 1 AS INTEGER) AS vin_idx, next_height AS block_height, i.txid AS prev_txid, vout_idx AS prev_vout,
        CAST({SEQUENCE} AS BIGINT) AS sequence_no FROM items i JOIN tx0 ON tx0.txid = i.txid WHERE l_linestatus = 'F' AND next_txid IS NOT NULL
        UNION ALL SELECT txid, 0, block_height, NULL, NULL, CAST({SEQUENCE} AS BIGINT) FROM tx0 WHERE is_coinbase""",
    "spends": """SELECT prev_txid, prev_vout, txid AS spending_txid, vin_idx AS spending_vin, block_height AS spent_height FROM inputs WHERE prev_txid IS NOT NULL AND prev_vout IS NOT NULL""",
    "marked": """SELECT o.*, spending_txid IS NOT NULL AS is_spent, spending_txid, spending_vin, spent_height FROM outputs o LEFT JOIN spends ON o.txid = prev_txid AND o.vout_idx = prev_vout""",
    "utxo": """SELECT txid, vout_idx, block_height, value_sats, script_type, address FROM marked WHERE address IS NOT NULL AND NOT is_spent""",
    "receivers": """SELECT o.address, o.block_height, t.tx_index, o.txid, 0 AS role, CAST(sum(o.value_sats) AS BIGINT) AS net_value_sats, b.block_time FROM outputs o JOIN transactions t ON t.txid = o.txid AND t.block_height = o.block_height
        JOIN blocks b ON b.height = o.block_height WHERE o.address IS NOT NULL GROUP BY ALL""",
    "senders": """SELECT o.address, o.spent_height AS block_height, t.tx_index, o.spending_txid AS txid, 1 AS role, CAST(-sum(o.value_sats) AS BIGINT) AS net_value_sats, b.block_time FROM marked o
        JOIN transactions t ON t.txid = o.spending_txid AND t.block_height = o.spent_height JOIN blocks b ON b.height = o.spent_height WHERE o.address IS NOT NULL AND o.is_spent GROUP BY ALL""",
    "history": "SELECT * FROM receivers UNION ALL SELECT * FROM senders",
    "moves": """SELECT address, txid, block_height, value_sats AS delta FROM outputs WHERE address IS NOT NULL UNION ALL SELECT address, spending_txid, spent_height, -value_sats FROM marked WHERE address IS NOT NULL AND is_spent""",
    "sums": """SELECT address, CAST(sum(delta) AS BIGINT) AS balance_sats, CAST(sum(greatest(delta, 0)) AS BIGINT) AS total_received_sats, CAST(sum(greatest(-delta, 0)) AS BIGINT) AS total_sent_sats,
        count(DISTINCT txid) AS tx_count, min(block_height) AS first_seen_height, max(block_height) AS last_seen_height FROM moves GROUP BY address""",
    "counts": "SELECT address, count(*) AS utxo_count, CAST(sum(value_sats) AS BIGINT) AS utxo_sats FROM utxo GROUP BY address",
    "balances": "SELECT s.*, coalesce(utxo_count, 0) AS utxo_count FROM sums s LEFT JOIN counts c ON c.address = s.address",
    "heavy": "SELECT address FROM sums ORDER BY tx_count DESC, address LIMIT 1",
    "top_tx": "SELECT txid FROM outputs GROUP BY txid ORDER BY count(*) DESC, txid LIMIT 1",
    "middle": "SELECT CAST(floor((min(height) + max(height)) / 2) AS INTEGER) AS h FROM blocks",
}
NEEDS = {
    "transactions": ["tx0"], "outputs": ["items", "tx0"], "inputs": ["items", "tx0"], "spends": ["inputs"], "marked": ["outputs", "spends"], "utxo": ["marked"], "receivers": ["outputs", "transactions", "blocks"],
    "senders": ["marked", "transactions", "blocks"], "history": ["receivers", "senders"], "moves": ["marked", "outputs"], "sums": ["moves"], "counts": ["utxo"], "balances": ["sums", "counts"], "heavy": ["sums"], "top_tx": ["outputs"], "middle": ["blocks"],
}


def sql(body: str, *ctes: str, extra: str = "") -> str:
    """The body behind those CTEs that it needs; `extra`: more of them, in full."""
    order: list[str] = []

    def need(name: str) -> None:
        for n in NEEDS.get(name, []):
            need(n)
        if name not in order:
            order.append(name)

    for c in ctes:
        need(c)
    parts = [f"{c} AS ({CTES[c]})" for c in order] + ([extra] if extra else [])
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
