"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key and the number of shards alone decide a row's shard, without a table of the ring. With one shard more, one row in n + 1 moves, and
only into the new shard. Law: `key`.

Each shard's rows also get slots, gapless from 0 in the order of the key (rows of one key: by checksum and size, then in
any order). Slots come from counts of (shard, range of keys, part) and row numbers inside such a group, so no task holds a shard: the
ranges are cut at quantiles of the key, and a key that holds several quantiles is dealt over `parts` groups of its own.

Null key: hashed as the least long, and first in its shard. Null text: size 1, checksum 0. Repeated rows: one shard, different slots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.llm.common import reliable

LEAST = -(1 << 63)
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key."""
    if shards < 1:
        raise ValueError("shards must be positive")
    key = keys.astype(np.int64).view(np.uint64).copy()
    at, to = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        at[live] = to[live]
        key[live] = key[live] * STEP + np.uint64(1)
        to[live] = ((at[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live = live[to[live] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """int; a null key counts as the least long."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in arrays:
            yield pa.array(jump(a.fill_null(LEAST).to_numpy(zero_copy_only=False), shards), type=pa.int32())

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "int")(key.cast("long"))


def assign(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", ranges: int = 256, parts: int = 32) -> DataFrame:
    """One row for each input row: the key, size, text_crc32, law, shard, slot and grown_shard (with one shard more)."""
    plain = F.coalesce(F.col(text), F.lit(""))
    slim = df.select(F.col(key).alias(key), (F.octet_length(plain) + 1).cast("long").alias("size"), F.crc32(plain.cast("binary")).alias("text_crc32"))
    slim = slim.select("*", shard_of(F.col(key), shards).alias("shard"), shard_of(F.col(key), shards + 1).alias("grown_shard"), F.monotonically_increasing_id().alias("row"))
    slim = reliable(slim)  # slots need the same rows in both passes below
    order = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    cuts = slim.select(order.alias("k")).approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if shards else []
    cuts = sorted(int(c) for c in cuts)
    hot = sorted({c for c, d in zip(cuts, cuts[1:], strict=False) if c == d})
    cuts = sorted(set(cuts))
    # a range is numbered by twice the cuts below it, and one more if it is a hot key itself
    below = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c).cast("long") for c in cuts])
        below = F.size(F.filter(edges, lambda c: c < order))
    is_hot = order.isin(hot) if hot else F.lit(False)
    group = slim.withColumn("range", below * 2 + is_hot.cast("int")).withColumn("part", F.when(is_hot, F.pmod(F.xxhash64("row"), F.lit(parts))).otherwise(F.lit(0)).cast("int"))
    # a hot key is the cut itself, and rows of its range before it are those below the cut: the same number of cuts lies below both
    counts = group.groupBy("shard", "range", "part").agg(F.count("*").alias("n"))  # a row for each group: its bound doesn't depend on the data
    first = F.sum("n").over(Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "range", "part", F.coalesce(first, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "range", "part").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size", "row"))
    return (
        group.withColumn("inside", inside)
        .join(F.broadcast(starts), ["shard", "range", "part"])
        .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("inside") - 1).cast("long").alias("slot"), "grown_shard")
    )
