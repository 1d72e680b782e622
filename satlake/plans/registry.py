"""One query for each operator family over the ledger views, and the same in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.functions import exprs as X
from satlake.operators import derive, parse, trace
from satlake.operators.lineage import cut, shared_folder
from satlake.plans import api
from satlake.plans.ledger import WIDTH, Ledger, sql
from satlake.sources import rpc
from satlake.sources.store import FACTS, Store
from satlake.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None, name: str | None = None):
    """Register a function of a Ledger under its name."""

    def add(f: Callable[[Ledger], DataFrame]) -> Callable[[Ledger], DataFrame]:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Ledger(spark, sf_dir))
        if oracle:
            ORACLE_SQL[key] = oracle
        return f

    return add


def heavy(g: Ledger) -> DataFrame:
    """The address with the most transactions, by address among equals: one row."""
    return derive.balances(derive.deltas(g.marked)).orderBy(F.col("tx_count").desc(), "address").limit(1).select("address")


def top_tx(g: Ledger) -> DataFrame:
    """The transaction with the most outputs, by id among equals: one row."""
    return g.outputs.groupBy("txid").count().orderBy(F.col("count").desc(), "txid").limit(1).select("txid")


def middle(g: Ledger) -> int:
    return g.blocks.agg(F.floor((F.min("height") + F.max("height")) / 2).cast("int")).first()[0]


BALANCE = "address, balance_sats, total_received_sats, total_sent_sats, tx_count, first_seen_height, last_seen_height, utxo_count"

# ---------------------------------------------------------------- balances, spend state, unspent outputs


@query(sql(f"SELECT {BALANCE} FROM balances", "balances"))
def balances_backfill(g: Ledger) -> DataFrame:
    return g.balances


@query(sql(f"SELECT {BALANCE} FROM balances", "balances"))
def balances_incremental(g: Ledger) -> DataFrame:
    """Balances of the lower half of the blocks, then those of the upper half merged in, unspent counts by their changes."""
    h = middle(g)
    moves = derive.deltas(g.marked)
    old, new = (derive.balances(moves.where(c)) for c in (F.col("block_height") <= h, F.col("block_height") > h))
    return derive.merge_balances(old, new)


@query(
    sql(
        "SELECT address, CAST(sum(d) AS BIGINT) AS delta_sats, CAST(sum(r) AS BIGINT) AS received_sats, CAST(sum(s) AS BIGINT) AS sent_sats, count(*) AS tx_delta, min(block_height) AS first_height, max(block_height) AS last_height FROM (SELECT address, block_height, sum(delta) AS d, sum(greatest(delta, 0)) AS r, sum(greatest(-delta, 0)) AS s FROM moves GROUP BY 1, 2) GROUP BY 1",
        "moves",
    )
)
def tx_delta_by_height(g: Ledger) -> DataFrame:
    return derive.height_deltas(derive.deltas(g.marked))


@query(sql("SELECT * FROM marked", "marked"))
def spend_marking(g: Ledger) -> DataFrame:
    return g.marked


@query(sql("SELECT s.*, u.block_height AS source_height FROM spends s LEFT JOIN outputs u ON u.address IS NOT NULL AND s.prev_txid = u.txid AND s.prev_vout = u.vout_idx", "spends", "outputs"))
def source_height_lookup(g: Ledger) -> DataFrame:
    return derive.source_heights(g.spends, g.outputs.where("address is not null"))


@query(sql("SELECT o.txid, o.vout_idx, o.block_height, o.value_sats, o.address, spending_txid, spending_vin, spent_height FROM outputs o JOIN spends s ON o.txid = prev_txid AND o.vout_idx = prev_vout WHERE o.address IS NOT NULL", "outputs", "spends"))
def spend_marking_pruned(g: Ledger) -> DataFrame:
    known = derive.source_heights(g.spends, g.outputs.where("address is not null"))
    return derive.mark_spent_pruned(g.outputs, known).select("txid", "vout_idx", "block_height", "value_sats", "address", "spending_txid", "spending_vin", "spent_height")


@query(sql("SELECT * FROM utxo", "utxo"))
def utxo_set(g: Ledger) -> DataFrame:
    return g.utxo


@query(sql("SELECT * FROM counts", "counts"))
def utxo_counts(g: Ledger) -> DataFrame:
    return derive.utxo_counts(g.utxo)


@query(sql("SELECT b.address, b.balance_sats, coalesce(u.utxo_count, b.utxo_count) AS utxo_count FROM balances b LEFT JOIN (SELECT address, count(*) AS utxo_count FROM utxo WHERE value_sats >= 50000000 AND script_type = 5 GROUP BY 1) u ON u.address = b.address", "balances", "utxo"))
def utxo_counts_update(g: Ledger) -> DataFrame:
    """Counts of some unspent outputs put into balances; an address without any keeps the count that it has."""
    counts = derive.utxo_counts(g.utxo.where("value_sats >= 50000000 and script_type = 5"))
    return derive.with_counts(derive.balances(derive.deltas(g.marked)), counts).select("address", "balance_sats", "utxo_count")


@query(sql("SELECT DISTINCT address FROM utxo WHERE address IN (SELECT o.address FROM outputs o JOIN spends ON o.txid = prev_txid AND o.vout_idx = prev_vout)", "utxo", "outputs", "spends"))
def in_subquery(g: Ledger) -> DataFrame:
    """Addresses with unspent outputs among those that have spent."""
    return g.utxo.join(derive.sender_deltas(g.spends, g.outputs), "address", "left_semi").select("address").distinct()


@query(sql("SELECT address, block_height, txid, -value_sats AS delta FROM (SELECT address, spent_height AS block_height, spending_txid AS txid, value_sats FROM marked WHERE address IS NOT NULL AND is_spent)", "marked"))
def sender_deltas(g: Ledger) -> DataFrame:
    return derive.sender_deltas(g.spends, g.outputs)


@query(sql("SELECT address, txid, block_height, delta, greatest(delta, 0) AS received, greatest(-delta, 0) AS sent FROM moves", "moves"))
def positive_negative(g: Ledger) -> DataFrame:
    return derive.deltas(g.marked).select("address", "txid", "block_height", "delta", X.positive(F.col("delta")).alias("received"), X.negative(F.col("delta")).alias("sent"))


# ---------------------------------------------------------------- history rows


@query(sql("SELECT * FROM receivers", "receivers"))
def receiver_rows(g: Ledger) -> DataFrame:
    return derive.receiver_rows(g.outputs, g.transactions, g.blocks)


@query(sql("SELECT * FROM senders", "senders"))
def sender_rows(g: Ledger) -> DataFrame:
    return derive.sender_rows(g.spends, g.outputs, g.transactions, g.blocks)


@query(sql("SELECT s.* FROM senders s, middle WHERE block_height > h", "senders", "middle"))
def sender_rows_live(g: Ledger) -> DataFrame:
    """Sender rows of a batch: the upper half of the blocks."""
    h = middle(g)
    return derive.sender_rows(g.spends.where(F.col("spent_height") > h), g.outputs, g.transactions.where(F.col("block_height") > h), g.blocks.where(F.col("height") > h))


@query(sql("SELECT r.* FROM receivers r, middle WHERE block_height > h", "receivers", "middle"))
def addr_tx_insert_ignore(g: Ledger) -> DataFrame:
    """What inserting all receiver rows, twice over, adds to those of the lower half."""
    rows = derive.receiver_rows(g.outputs, g.transactions, g.blocks)
    return derive.insert_ignore(rows.where(F.col("block_height") <= middle(g)), rows.unionByName(rows))


@query(
    sql(
        "SELECT o.address, o.block_height, t.tx_index, o.txid, 0 AS role, CAST(sum(o.value_sats) AS BIGINT) AS net_value_sats, b.block_time FROM outputs o JOIN transactions t ON t.txid = o.txid JOIN blocks b ON b.height = o.block_height WHERE o.address IS NOT NULL GROUP BY ALL",
        "outputs", "transactions", "blocks",
    )
)
def agg_addr_tx(g: Ledger) -> DataFrame:
    """One row an output, as the parser emits them, summed up by the five keys."""
    t = g.transactions.select(F.col("txid").alias("t"), "tx_index")
    b = g.blocks.select(F.col("height").alias("h"), "block_time")
    rows = g.outputs.where("address is not null").join(t, F.col("txid") == F.col("t")).join(b, F.col("block_height") == F.col("h"))
    return derive.sum_history(rows.select("address", "block_height", "tx_index", "txid", F.lit(0).alias("role"), F.col("value_sats").alias("net_value_sats"), "block_time"))


# ---------------------------------------------------------------- read side

_STATS = "count(DISTINCT txid) AS tx_count, coalesce(min(block_height), 0) AS first_seen_height, coalesce(max(block_height), 0) AS last_seen_height, CAST(sum(greatest(delta, 0)) AS BIGINT) AS total_received_sats, CAST(sum(greatest(-delta, 0)) AS BIGINT) AS total_sent_sats"


@query(sql(f"SELECT b.address, balance_sats, utxo_count, s.* EXCLUDE (address) FROM balances b JOIN (SELECT address, {_STATS} FROM moves GROUP BY 1) s ON s.address = b.address WHERE b.address IN (SELECT address FROM heavy)", "balances", "heavy"))
def address_info_cached(g: Ledger) -> DataFrame:
    return api.info_cached(g.balances, g.marked, heavy(g))


@query(sql(f"SELECT s.*, coalesce(utxo_sats, 0) AS balance_sats, coalesce(utxo_count, 0) AS utxo_count FROM (SELECT address, {_STATS} FROM (SELECT DISTINCT * FROM moves) GROUP BY 1) s LEFT JOIN counts c ON c.address = s.address", "moves", "counts"))
def address_info_fallback(g: Ledger) -> DataFrame:
    """Computed for all addresses: the set variant."""
    return api.info_computed(g.utxo, g.marked, g.outputs.where("address is not null").select("address").distinct())


@query(sql(f"SELECT s.*, coalesce(utxo_sats, 0) AS balance_sats, coalesce(utxo_count, 0) AS utxo_count FROM (SELECT address, {_STATS} FROM (SELECT * FROM moves WHERE address LIKE 'addr1%' UNION ALL (SELECT DISTINCT * FROM moves WHERE address NOT LIKE 'addr1%')) GROUP BY 1) s LEFT JOIN counts c ON c.address = s.address", "moves", "counts"))
def address_info_mixed(g: Ledger) -> DataFrame:
    """Stored rows for some addresses, computed ones for the others."""
    return api.info(g.balances.where(F.col("address").startswith("addr1")), g.utxo, g.marked, g.outputs.where("address is not null").select("address").distinct())


_ROLE = "CASE role WHEN 0 THEN 'receiver' WHEN 1 THEN 'sender' WHEN 2 THEN 'both' ELSE 'unknown' END AS role, CASE role WHEN 0 THEN 'OUT' WHEN 1 THEN 'IN' WHEN 2 THEN 'BOTH' ELSE 'UNKNOWN' END AS direction"


def _history_sql(where: str, limit: int = 100, offset: int = 0) -> str:
    return sql(
        f"SELECT txid, block_height, block_time, net_value_sats, {_ROLE} FROM (SELECT txid, block_height, max(tx_index) AS tx_index, max(block_time) AS block_time, CAST(sum(net_value_sats) AS BIGINT) AS net_value_sats, role FROM history WHERE address IN (SELECT address FROM heavy) {where} GROUP BY txid, block_height, role) x ORDER BY block_height DESC, tx_index DESC, txid DESC, x.role DESC LIMIT {limit} OFFSET {offset}",
        "history", "heavy",
    )


@query(_history_sql("AND role = 1"))
def history_in(g: Ledger) -> DataFrame:
    return api.page(api.history(api.of_address(g.history, heavy(g)), "in"))


@query(_history_sql("AND role = 0"))
def history_out(g: Ledger) -> DataFrame:
    return api.page(api.history(api.of_address(g.history, heavy(g)), "OUT"))


@query(_history_sql(""))
def history_both(g: Ledger) -> DataFrame:
    return api.page(api.history(api.of_address(g.history, heavy(g)), "both"))


@query(_history_sql("", 25, 50))
def history_page(g: Ledger) -> DataFrame:
    return api.page(api.history(api.of_address(g.history, heavy(g))), 25, 50)


@query(
    sql(
        f"SELECT txid, block_height, block_time, net_value_sats, {_ROLE} FROM (SELECT txid, block_height, role, CAST(sum(delta) AS BIGINT) AS net_value_sats FROM (SELECT *, CASE WHEN delta < 0 THEN 1 ELSE 0 END AS role FROM moves WHERE address IN (SELECT address FROM heavy)) GROUP BY 1, 2, 3) x LEFT JOIN blocks ON height = block_height ORDER BY block_height DESC, txid DESC, x.role DESC LIMIT 100",
        "moves", "heavy", "blocks",
    )
)
def history_fallback(g: Ledger) -> DataFrame:
    return api.page(api.history_computed(api.of_address(g.marked, heavy(g)), g.blocks))


@query(sql("SELECT t.*, b.hash AS block_hash, b.block_time FROM transactions t JOIN blocks b ON b.height = t.block_height WHERE t.txid IN (SELECT txid FROM top_tx) LIMIT 1", "transactions", "blocks", "top_tx"))
def tx_header(g: Ledger) -> DataFrame:
    return api.header(g.transactions, g.blocks, top_tx(g))


@query(sql("SELECT i.txid, vin_idx, prev_txid, prev_vout, sequence_no, coalesce(value_sats, 0) AS value_sats, address FROM inputs i LEFT JOIN outputs o ON o.txid = prev_txid AND o.vout_idx = prev_vout", "inputs", "outputs"))
def tx_inputs_enriched(g: Ledger) -> DataFrame:
    return api.inputs_of(g.inputs, g.outputs, g.orders.select("txid"))


_SCRIPT = "CASE script_type " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(X.SCRIPT_NAMES)) + " ELSE 'unknown' END"


@query(sql(f"SELECT txid, vout_idx, value_sats, address, {_SCRIPT} AS script_type, is_spent, spending_txid FROM marked WHERE txid IN (SELECT txid FROM top_tx)", "marked", "top_tx"))
def tx_outputs_view(g: Ledger) -> DataFrame:
    return api.outputs_of(g.marked, top_tx(g)).orderBy("vout_idx")


@query(
    sql(
        f"SELECT t.*, b.hash AS block_hash, b.block_time, (SELECT CAST(to_json(list({{'vin_idx': vin_idx, 'prev_txid': prev_txid, 'prev_vout': prev_vout, 'sequence_no': sequence_no, 'value_sats': coalesce(value_sats, 0), 'address': address}} ORDER BY vin_idx)) AS VARCHAR) FROM inputs i LEFT JOIN outputs o ON o.txid = prev_txid AND o.vout_idx = prev_vout WHERE i.txid IN (SELECT txid FROM top_tx)) AS inputs, (SELECT CAST(to_json(list({{'vout_idx': vout_idx, 'value_sats': value_sats, 'address': address, 'script_type': {_SCRIPT}, 'is_spent': is_spent, 'spending_txid': spending_txid}} ORDER BY vout_idx)) AS VARCHAR) FROM marked WHERE txid IN (SELECT txid FROM top_tx)) AS outputs FROM transactions t JOIN blocks b ON b.height = t.block_height WHERE t.txid IN (SELECT txid FROM top_tx)",
        "transactions", "blocks", "top_tx", "inputs", "marked",
    )
)
def tx_full(g: Ledger) -> DataFrame:
    """Header, inputs and outputs of one transaction, the lists as JSON."""
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"}).alias(c)
    full = api.transaction(g.transactions, g.blocks, g.inputs, g.outputs, g.marked, top_tx(g))
    return full.select(*[text(c) if c in ("inputs", "outputs") else c for c in full.columns])


@query(sql("SELECT DISTINCT spending_txid AS txid FROM spends WHERE prev_txid IN (SELECT txid FROM outputs GROUP BY 1 HAVING count(*) >= 7)", "spends", "outputs"))
def trace_one_hop(g: Ledger) -> DataFrame:
    return trace.one_hop(g.spends, g.outputs.groupBy("txid").count().where("count >= 7").select("txid"))


@query(
    sql(
        "SELECT txid, min(depth) AS depth FROM walk WHERE depth > 0 GROUP BY txid", "spends", "middle",
        extra="roots AS (SELECT min(prev_txid) AS txid FROM spends), walk AS (SELECT txid, 0 AS depth FROM roots UNION SELECT spending_txid, depth + 1 FROM walk JOIN spends ON prev_txid = txid WHERE depth < 8)",
    )
)
def trace_multi_hop(g: Ledger) -> DataFrame:
    return trace.descendants(g.spends, g.spends.agg(F.min("prev_txid").alias("txid")), 8)


@query(sql("SELECT address AS src, spending_txid AS dst, CAST(sum(value_sats) AS BIGINT) AS value_sats FROM marked WHERE is_spent AND address IS NOT NULL GROUP BY 1, 2", "marked"))
def graph_sends(g: Ledger) -> DataFrame:
    return trace.sends_edges(g.spends, g.outputs)


@query(sql("SELECT txid AS src, address AS dst, CAST(sum(value_sats) AS BIGINT) AS value_sats FROM outputs WHERE address IS NOT NULL GROUP BY 1, 2", "outputs"))
def graph_spends(g: Ledger) -> DataFrame:
    return trace.spends_edges(g.outputs)


@query(sql("SELECT DISTINCT prev_txid AS src, spending_txid AS dst FROM spends", "spends"))
def graph_tx_edges(g: Ledger) -> DataFrame:
    return trace.edges(g.spends)


# ---------------------------------------------------------------- blocks as JSON, and back


def _pad(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 64, "0")


def block_json(g: Ledger) -> DataFrame:
    """height, block: the ledger as verbosity-2 block JSON, for parsing again."""
    outs = g.outputs.groupBy(F.col("txid").alias("o")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("vout_idx").alias("n"), (F.col("value_sats").cast("decimal(20,0)") / F.lit(100000000)).cast("decimal(18,8)").alias("value"), F.struct(F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("script_type") + 1).alias("type"), F.col("address").alias("address")).alias("scriptPubKey")))).alias("vout")
    )
    real = F.col("prev_txid").isNotNull()
    ins = g.inputs.groupBy(F.col("txid").alias("i")).agg(
        F.array_sort(F.collect_list(F.struct("vin_idx", F.when(~real, "00").alias("coinbase"), F.when(real, _pad(F.col("prev_txid"))).alias("txid"), F.when(real, F.col("prev_vout")).alias("vout"), F.col("sequence_no").alias("sequence")))).alias("vin")
    )
    t = g.transactions.join(outs, F.col("txid") == F.col("o"), "left").join(ins, F.col("txid") == F.col("i"), "left")
    fee = (F.col("fee_sats").cast("decimal(20,0)") / F.lit(100000000)).cast("decimal(18,8)")
    tx = F.struct("tx_index", _pad(F.col("txid")).alias("txid"), F.lit(2).alias("version"), F.lit(0).alias("locktime"), fee.alias("fee"), F.coalesce("vin", F.array()).alias("vin"), F.coalesce("vout", F.array()).alias("vout"))
    per = t.groupBy("block_height").agg(F.array_sort(F.collect_list(tx)).alias("tx"))
    b = g.blocks.join(per, F.col("height") == F.col("block_height"))
    doc = F.struct("hash", F.unix_timestamp(F.col("block_time").cast("timestamp")).alias("time"), F.lit("1d00ffff").alias("bits"), F.lit(7).alias("nonce"), F.lit(1).alias("version"), "tx")
    return b.select("height", F.to_json(doc).alias("block"))


#: A name of each script code, as nodes give it.
NAMES = ("pubkeyhash", "scripthash", "witness_v0_keyhash", "witness_v0_scripthash", "witness_v1_taproot", "nulldata", "multisig", "pubkey")


def _parsed(g: Ledger) -> dict[str, DataFrame]:
    return parse.tables(block_json(g))


def _id(c: str):
    return F.conv(X.to_hex(F.col(c)), 16, 10).cast("bigint").alias(c)


@query(sql("SELECT b.height, b.hash, b.block_time, 486604799 AS bits, CAST(7 AS BIGINT) AS nonce, b.tx_count, coalesce(f.fees, 0) AS total_fees_sats FROM blocks b LEFT JOIN (SELECT block_height, CAST(sum(fee_sats) AS BIGINT) AS fees FROM transactions GROUP BY 1) f ON f.block_height = b.height".replace("486604799 AS", "CAST(486604799 AS BIGINT) AS"), "blocks", "transactions"))
def parse_blocks(g: Ledger) -> DataFrame:
    return _parsed(g)["blocks"].select("height", X.to_hex(F.col("hash")).alias("hash"), F.col("block_time").cast("timestamp_ntz").alias("block_time"), "bits", "nonce", "tx_count", "total_fees_sats")


@query(
    sql(
        "SELECT t.*, coalesce(i, 0) AS input_count, coalesce(o, 0) AS output_count FROM transactions t LEFT JOIN (SELECT txid, CAST(count(*) AS INTEGER) AS i FROM inputs GROUP BY 1) a ON a.txid = t.txid LEFT JOIN (SELECT txid, CAST(count(*) AS INTEGER) AS o FROM outputs GROUP BY 1) b ON b.txid = t.txid",
        "transactions", "inputs", "outputs",
    )
)
def parse_txs(g: Ledger) -> DataFrame:
    return _parsed(g)["transactions"].select(_id("txid"), "block_height", "tx_index", "is_coinbase", "fee_sats", "input_count", "output_count")


@query(sql("SELECT txid, vin_idx, block_height, prev_txid, prev_vout, sequence_no FROM inputs", "inputs"))
def parse_inputs(g: Ledger) -> DataFrame:
    return _parsed(g)["tx_inputs"].select(_id("txid"), "vin_idx", "block_height", _id("prev_txid"), "prev_vout", "sequence_no")


@query(sql("SELECT * FROM outputs", "outputs"))
def parse_outputs(g: Ledger) -> DataFrame:
    return _parsed(g)["tx_outputs"].select(_id("txid"), "vout_idx", "block_height", "value_sats", F.col("script_type").cast("int").alias("script_type"), "address")


@query(sql("SELECT o.address, o.block_height, t.tx_index, o.txid, 0 AS role, o.value_sats AS net_value_sats, b.block_time FROM outputs o JOIN transactions t ON t.txid = o.txid JOIN blocks b ON b.height = o.block_height WHERE o.address IS NOT NULL", "outputs", "transactions", "blocks"))
def parse_receivers(g: Ledger) -> DataFrame:
    rows = parse.receivers(parse.decoded(block_json(g)))
    return rows.select("address", "block_height", "tx_index", _id("txid"), F.col("role").cast("int").alias("role"), "net_value_sats", F.col("block_time").cast("timestamp_ntz").alias("block_time"))


def detail_json(g: Ledger) -> DataFrame:
    """height, block: the ledger from height 0 on, with the fields that nodes leave out, leave empty or get wrong in some places."""
    first = g.blocks.agg(F.min("height").alias("low"))
    text = lambda c: F.col(c).cast("string")
    spk = F.struct(
        F.when(F.col("vout_idx") % 2 == 0, F.concat(F.lit("76A9"), F.lpad(text("vout_idx"), 2, "0"))).otherwise("not hex").alias("hex"),
        F.when(F.col("vout_idx") % 2 == 0, F.col("address")).alias("address"), F.when(F.col("vout_idx") % 2 == 1, F.array("address", F.lit("second"))).alias("addresses"),
    )
    outs = g.outputs.groupBy(F.col("txid").alias("o")).agg(F.array_sort(F.collect_list(F.struct(F.col("vout_idx").alias("n"), spk.alias("scriptPubKey")))).alias("vout"))
    script = F.when(F.col("vin_idx") % 3 == 0, "abc").when(F.col("vin_idx") % 3 == 1, F.lpad(text("vin_idx"), 4, "0"))
    vin = F.struct("vin_idx", F.lit("00").alias("coinbase"), F.struct(script.alias("hex")).alias("scriptSig"), F.when(F.col("vin_idx") % 2 == 1, F.array(F.lit(""), F.lit("aa"))).alias("txinwitness"))
    ins = g.inputs.groupBy(F.col("txid").alias("i")).agg(F.array_sort(F.collect_list(vin)).alias("vin"))
    size = F.when(F.col("tx_index") % 5 == 0, 0).otherwise(F.col("tx_index") + 200)
    tx = F.struct("tx_index", _pad(F.col("txid")).alias("txid"), (F.col("tx_index") % 2 + 1).alias("version"), F.col("block_height").alias("locktime"), size.alias("size"), F.col("tx_index").alias("vsize"), (size * 4).alias("weight"), "vin", F.coalesce("vout", F.array()).alias("vout"))
    per = g.transactions.join(outs, F.col("txid") == F.col("o"), "left").join(ins, F.col("txid") == F.col("i"), "left").groupBy("block_height").agg(F.array_sort(F.collect_list(tx)).alias("tx"))
    b = g.blocks.join(per, F.col("height") == F.col("block_height")).crossJoin(F.broadcast(first))  # first: one row
    before = F.when(F.col("height") % 2 == 1, F.sha2(F.concat(F.lit("block:"), (F.col("height") - 1).cast("string")), 256))
    return b.select((F.col("height") - F.col("low")).alias("height"), F.to_json(F.struct("hash", before.alias("previousblockhash"), F.when(F.col("height") % 3 == 0, "0x").alias("merkleroot"), F.lit("junk").alias("bits"), "tx")).alias("block"))


@query(
    sql(
        "SELECT t.txid, t.tx_index % 2 + 1 AS version, CAST(t.block_height AS BIGINT) AS locktime, nullif(s, 0) AS size_bytes, nullif(t.tx_index, 0) AS vsize, nullif(s * 4, 0) AS weight, coalesce(w, false) AS has_segwit FROM (SELECT *, CASE WHEN tx_index % 5 = 0 THEN 0 ELSE tx_index + 200 END AS s FROM transactions) t LEFT JOIN (SELECT txid, bool_or(vin_idx % 2 = 1) AS w FROM inputs GROUP BY 1) i ON i.txid = t.txid",
        "transactions", "inputs",
    )
)
def parse_tx_details(g: Ledger) -> DataFrame:
    """Sizes of 0 are unknown; a transaction has a witness if some input has."""
    return parse.tables(detail_json(g))["transactions"].select(_id("txid"), "version", "locktime", "size_bytes", "vsize", "weight", "has_segwit")


@query(
    sql(
        "SELECT txid, vin_idx, CASE WHEN vin_idx % 3 = 1 THEN lpad(CAST(vin_idx AS VARCHAR), 4, '0') END AS script_sig, CASE WHEN vin_idx % 2 = 1 THEN 'NULL,aa' END AS witness, CAST(4294967294 AS BIGINT) AS sequence_no FROM inputs",
        "inputs",
    )
)
def parse_input_details(g: Ledger) -> DataFrame:
    """Bad hex is null, an empty witness item too; no witness is null; a missing sequence has its default."""
    i = parse.tables(detail_json(g))["tx_inputs"]
    witness = F.array_join(F.transform("witness", X.to_hex), ",", "NULL")
    return i.select(_id("txid"), "vin_idx", X.to_hex(F.col("script_sig")).alias("script_sig"), witness.alias("witness"), "sequence_no")


@query(sql("SELECT txid, vout_idx, CASE WHEN vout_idx % 2 = 0 THEN '76a9' || lpad(CAST(vout_idx AS VARCHAR), 2, '0') END AS script_pubkey, address FROM outputs", "outputs"))
def parse_output_details(g: Ledger) -> DataFrame:
    """Scripts with bad hex are null; where there is no address, the first of the addresses is it."""
    return parse.tables(detail_json(g))["tx_outputs"].select(_id("txid"), "vout_idx", X.to_hex(F.col("script_pubkey")).alias("script_pubkey"), "address")


@query(
    sql(
        "SELECT CAST(height - low AS INTEGER) AS height, CASE WHEN height % 2 = 1 THEN sha256('block:' || (height - 1)) WHEN height = low THEN repeat('0', 64) END AS prev_hash, CAST(NULL AS VARCHAR) AS merkle_root, CAST(0 AS BIGINT) AS bits, CAST(0 AS BIGINT) AS nonce FROM blocks, (SELECT min(height) AS low FROM blocks)",
        "blocks",
    )
)
def parse_block_links(g: Ledger) -> DataFrame:
    """The hash before: as given; zeros for the first block if it has none; else null. What can't be read is null or 0."""
    return parse.tables(detail_json(g))["blocks"].select("height", X.to_hex(F.col("prev_hash")).alias("prev_hash"), X.to_hex(F.col("merkle_root")).alias("merkle_root"), "bits", "nonce")


@query(
    sql(
        "SELECT 'blocks' AS name, count(*) AS n, CAST(sum(height) AS BIGINT) AS total FROM blocks UNION ALL SELECT 'transactions', count(*), CAST(sum(tx_index) AS BIGINT) FROM transactions UNION ALL SELECT 'tx_outputs', count(*), CAST(sum(value_sats) AS BIGINT) FROM outputs UNION ALL SELECT 'tx_inputs', count(*), CAST(sum(vin_idx) AS BIGINT) FROM inputs UNION ALL SELECT 'address_balances', count(*), CAST(sum(balance_sats) AS BIGINT) FROM sums UNION ALL SELECT 'address_transactions', count(*), CAST(sum(net_value_sats) AS BIGINT) FROM history UNION ALL SELECT 'utxo_set', count(*), CAST(sum(value_sats) AS BIGINT) FROM utxo UNION ALL SELECT 'last_height', 1, max(height) FROM blocks",
        "blocks", "transactions", "outputs", "inputs", "sums", "history", "utxo",
    )
)
def store_batches(g: Ledger) -> DataFrame:
    """What a store holds after three batches of which the last comes twice: one in historical mode, then live ones, before which the first is derived."""
    raw, store = cut(block_json(g)), Store(g.spark, f"{shared_folder(g.spark)}/store-{uuid.uuid4().hex}", WIDTH)
    low, high = raw.agg(F.min("height"), F.max("height")).first()
    third = (high - low) // 3
    ranges = [(low, low + third), (low + third + 1, low + 2 * third), (low + 2 * third + 1, high), (low + 2 * third + 1, high)]
    for k, (a, b) in enumerate(ranges):
        ingest.save(store, raw.where(F.col("height").between(a, b)), historical=k == 0, again=True)
    totals = {"blocks": "height", "transactions": "tx_index", "tx_outputs": "value_sats", "tx_inputs": "vin_idx", "address_balances": "balance_sats", "address_transactions": "net_value_sats", "utxo_set": "value_sats"}
    out = g.spark.createDataFrame([("last_height", 1, store.last_height())], "name string, n bigint, total bigint")
    for name, c in totals.items():
        df = store.facts(name) if name in FACTS else store.derived(name)
        out = out.unionByName(df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(c).cast("bigint").alias("total")))
    return out


@query(sql("SELECT block_height, CAST(coalesce(sum(fee_sats), 0) AS BIGINT) AS total_fees_sats FROM transactions GROUP BY 1", "transactions"))
def block_fee_totals(g: Ledger) -> DataFrame:
    return g.transactions.groupBy("block_height").agg(F.coalesce(F.sum("fee_sats"), F.lit(0)).alias("total_fees_sats"))


@query(sql(f"SELECT txid, vout_idx, script_type, {_SCRIPT} AS script_name FROM outputs", "outputs"))
def script_type_names(g: Ledger) -> DataFrame:
    return g.outputs.select("txid", "vout_idx", "script_type", X.script_name(F.col("script_type")).alias("script_name"))


# ---------------------------------------------------------------- filters, scans, pages, reports


def by_bucket(g: Ledger) -> DataFrame:
    """Outputs as the store lays them out: a folder for each bucket of heights."""
    at = f"{shared_folder(g.spark)}/outputs-{uuid.uuid4().hex}"
    derive.with_bucket(g.outputs, WIDTH).write.partitionBy("height_bucket").parquet(at)
    return g.spark.read.parquet(at)


@query(sql("SELECT o.* FROM outputs o, middle WHERE block_height BETWEEN h - 200 AND h + 200", "outputs", "middle"))
def height_range(g: Ledger) -> DataFrame:
    h = middle(g)
    return derive.height_between(by_bucket(g), h - 200, h + 200, WIDTH).drop("height_bucket")


@query(sql(f"SELECT o.* FROM outputs o, middle WHERE block_height // {WIDTH} = h // {WIDTH}", "outputs", "middle"))
def partition_scan(g: Ledger) -> DataFrame:
    """One partition of outputs by its number: the others aren't read."""
    return by_bucket(g).where(F.col("height_bucket") == middle(g) // WIDTH).drop("height_bucket")


@query(sql("SELECT * FROM sums WHERE address LIKE 'addr1%'", "sums"))
def address_prefix(g: Ledger) -> DataFrame:
    return derive.balances(derive.deltas(g.marked.where(F.col("address").startswith("addr1")))).drop("utxo_count")


@query(sql(f"SELECT {BALANCE} FROM balances WHERE address IN (SELECT min(address) FROM outputs)", "balances", "outputs"))
def balance_by_address(g: Ledger) -> DataFrame:
    """The stored balance of one address."""
    return api.of_address(g.balances, g.outputs.agg(F.min("address").alias("address")))


@query(sql("SELECT EXISTS (SELECT 1 FROM blocks WHERE height = 0) AS has_genesis, EXISTS (SELECT 1 FROM blocks) AS has_blocks", "blocks"))
def genesis_exists(g: Ledger) -> DataFrame:
    return g.blocks.agg((F.count_if(F.col("height") == 0) > 0).alias("has_genesis"), (F.count("*") > 0).alias("has_blocks"))


@query(sql("SELECT max(height) AS last_height, arg_max(hash, height) AS last_hash FROM blocks", "blocks"))
def last_height(g: Ledger) -> DataFrame:
    return g.blocks.agg(F.max("height").alias("last_height"), F.max_by("hash", "height").alias("last_hash"))


@query("SELECT b * 100000 AS low, CASE WHEN b = 0 THEN '0' WHEN b < 10 THEN (b * 100) || 'k' WHEN b % 10 = 0 THEN (b // 10) || 'm' ELSE b || 'm' END AS label, 'FOR VALUES FROM (' || (b * 100000) || ') TO (' || ((b + 1) * 100000) || ')' AS bounds FROM range(25) r(b)")
def partition_labels(g: Ledger) -> DataFrame:
    low = F.col("id") * 100_000
    return g.spark.range(25).select(low.alias("low"), X.partition_label_column(low).alias("label"), F.format_string("FOR VALUES FROM (%d) TO (%d)", low, low + 100_000).alias("bounds"))


@query(
    sql(
        "SELECT 'address_balances' AS metric, count(*) AS value FROM sums UNION ALL SELECT 'negative_balances', count(*) FROM sums WHERE balance_sats < 0 UNION ALL SELECT 'address_transactions', count(*) FROM history UNION ALL SELECT 'receiver_rows', count(*) FROM receivers UNION ALL SELECT 'sender_rows', count(*) FROM senders UNION ALL SELECT 'spent_outputs', count(*) FROM marked WHERE is_spent UNION ALL SELECT 'utxo_set', count(*) FROM utxo UNION ALL SELECT 'last_height', max(height) FROM blocks",
        "sums", "history", "utxo", "blocks",
    )
)
def verify_report(g: Ledger) -> DataFrame:
    marked = cut(g.marked)  # outputs meet their spends once; balances, history and unspent outputs all follow from that
    held = marked.where("address is not null")
    sent = held.where("is_spent").select("address", F.col("spent_height").alias("block_height"), F.col("spending_txid").alias("txid"), (-F.col("value_sats")).alias("delta"))
    history = derive.receiver_rows(held, g.transactions, g.blocks).unionByName(derive.sender_rows_of(sent, g.transactions, g.blocks))
    return derive.verify_report(marked, history, derive.balances(derive.deltas(held)), held.where("not is_spent"), g.blocks.agg(F.max("height")))


@query(sql("SELECT height, hash, tx_count, block_time FROM blocks ORDER BY height DESC LIMIT 10", "blocks"))
def latest_blocks(g: Ledger) -> DataFrame:
    return g.blocks.orderBy(F.col("height").desc()).limit(10).select("height", "hash", "tx_count", "block_time")


@query(sql("SELECT t.txid, t.block_height, CAST(sum(o.value_sats) AS BIGINT) AS total_output_sats FROM transactions t JOIN outputs o ON o.txid = t.txid AND o.block_height = t.block_height GROUP BY 1, 2 ORDER BY total_output_sats DESC, t.txid LIMIT 20", "transactions", "outputs"))
def top_tx_by_output(g: Ledger) -> DataFrame:
    o = g.outputs.groupBy(F.col("txid").alias("o"), F.col("block_height").alias("h")).agg(F.sum("value_sats").alias("total_output_sats"))
    t = g.transactions.select("txid", "block_height").join(o, (F.col("txid") == F.col("o")) & (F.col("block_height") == F.col("h")))
    return t.select("txid", "block_height", "total_output_sats").orderBy(F.col("total_output_sats").desc(), "txid").limit(20)


@query(sql("SELECT txid, vout_idx, value_sats, block_height FROM utxo WHERE address IN (SELECT address FROM heavy)", "utxo", "heavy"))
def address_utxos(g: Ledger) -> DataFrame:
    return api.of_address(g.utxo, heavy(g)).select("txid", "vout_idx", "value_sats", "block_height").orderBy("block_height", "txid", "vout_idx")


@query(sql("SELECT vout_idx, address, value_sats FROM marked WHERE txid IN (SELECT txid FROM top_tx) AND NOT is_spent", "marked", "top_tx"))
def unspent_of_tx(g: Ledger) -> DataFrame:
    return g.marked.join(top_tx(g), "txid", "left_semi").where("not is_spent").select("vout_idx", "address", "value_sats")


@query(sql("SELECT max(height) AS indexed_height, max(height) + 25 - max(height) AS behind, count(*) AS n_blocks, CAST(sum(tx_count) AS BIGINT) AS n_txs FROM blocks", "blocks"))
def sync_progress(g: Ledger) -> DataFrame:
    tip = F.max("height") + 25
    return g.blocks.agg(F.max("height").alias("indexed_height"), (tip - F.max("height")).alias("behind"), F.count("*").alias("n_blocks"), F.sum("tx_count").alias("n_txs"))


@query(
    "SELECT tip, b AS batch, CAST(b * 12 AS BIGINT) AS first, CAST(least(b * 12 + 11, greatest(tip - 10, 0)) AS BIGINT) AS last FROM (SELECT unnest([5, 10, 11, 45, 1000]) AS tip) t, range(200) r(b) WHERE b * 12 <= greatest(tip - 10, 0)".replace("[5, 10, 11, 45, 1000]", "[CAST(5 AS BIGINT), 10, 11, 45, 1000]")
)
def safe_tip_batches(g: Ledger) -> DataFrame:
    """The height ranges that a stream from 0 in batches of 12 gives out, ten blocks behind the tip, for five tips: its own offsets, asked for until they stay."""
    rows = []
    for tip in (5, 10, 11, 45, 1000):
        stream = rpc.RpcStream({"batch": "12", "confirmations": "10"})
        stream.tip, stream.ask_at = tip, float("inf")
        at = stream.initialOffset()["next"]
        while (end := stream.latestOffset()["next"]) > at:
            rows.append((tip, len([r for r in rows if r[0] == tip]), at, end - 1))
            at = end
    return g.spark.createDataFrame(rows, "tip bigint, batch bigint, first bigint, last bigint")


@query(sql("SELECT block_height // 1000 AS bucket, count(*) AS n_outputs, CAST(sum(value_sats) AS BIGINT) AS value_sats FROM outputs GROUP BY 1".replace("block_height // 1000", "CAST(block_height // 1000 AS INTEGER)"), "outputs"))
def bucket_totals(g: Ledger) -> DataFrame:
    return derive.with_bucket(g.outputs, WIDTH).groupBy(F.col("height_bucket").alias("bucket")).agg(F.count("*").alias("n_outputs"), F.sum("value_sats").alias("value_sats"))


@query("SELECT l_orderkey AS txid, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(g: Ledger) -> DataFrame:
    """Line numbers are no key of line items; the ledger numbers outputs anew."""
    return derive.duplicate_keys(g.table("lineitem").select(F.col("l_orderkey").alias("txid"), F.col("l_linenumber").alias("line")), ("txid", "line"))


@query(sql("SELECT address, count(*) AS n_rows, count(*) FILTER (role = 1) AS n_sent, CAST(sum(net_value_sats) AS BIGINT) AS net_sats FROM history GROUP BY 1", "history"))
def history_totals(g: Ledger) -> DataFrame:
    """An invariant's two sides: net sums of history are balances."""
    h = derive.require_key(g.history, derive.HISTORY_KEY)
    return h.groupBy("address").agg(F.count("*").alias("n_rows"), F.count_if(F.col("role") == X.SENDER).alias("n_sent"), F.sum("net_value_sats").alias("net_sats"))
