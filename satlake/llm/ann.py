"""Approximate nearest neighbours by multi-index hashing (Norouzi, Punjani and Fleet, 2012) over learned rotated codes (ITQ, Gong and Lazebnik).

Codes: unit vectors are centred and turned by rotations that iterative quantisation fits on a bounded sample; the signs are the bits, as many rotations as give `bits` bits. A code is cut
into substrings of 16 bits, each with an index from its values to rows. Probing each index for all values within f flips of the query's finds, by the pigeonhole principle, every code within
radius substrings * (f + 1) - 1, and of farther codes those that agree with the query somewhere that well. f is the least that finds `reach` of the true neighbours of sample
queries: 0 or 1 where neighbours are close, 2 or 3 where all vectors are about as far apart.

What is found is ranked by whole codes. Codes up to `margin` bits beyond the `list`-th best go on, margin being the `sure` quantile of what true neighbours in the sample needed; no
list is cut inside a distance, so codes of one distance go on together. Only for those are the vectors fetched, and ranked by cosine in double precision. Sums run over halves of the products, in an
order that depends on nothing but the dimension, so equal vectors have equal scores wherever they stand.

Equal vectors are one class: it is indexed and searched once, and holds its least k + 1 ids, as no query can have more of them. The classes' codes are dealt into shards, and query classes
into blocks; a task has the codes of one shard and one block, never vectors. Only the sample goes to the driver. Where fewer than `list` classes of a shard are found, its nearest codes
are taken, so every query gets k neighbours if there are so many.

Vectors that are null, zero, of another dimension than most of the sample, or hold null or non-finite components take no part, nor do rows without an id. Rows of one id count once,
with the least vector. Ties: the smaller id. No vectors: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.llm.common import reliable

WIDTH = 16  # bits of a substring


@dataclass(frozen=True)
class Index:
    bits: int = 1536
    sample: int = 12_000
    queries: int = 400
    reach: float = 0.95
    sure: float = 0.99
    steps: int = 8
    seed: int = 11
    shard: int = 65_536
    block: int = 4_096
    list: int = 64


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    turn: np.ndarray  # dimensions x bits, a multiple of 64
    flips: int
    margin: int


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of products, row by row; each is built from the row's own products by halving, whatever rows are beside it."""
    p = x * y
    n = 1 << max(0, p.shape[1] - 1).bit_length()
    p = np.pad(p, ((0, 0), (0, n - p.shape[1])))
    while n > 1:
        n //= 2
        p = p[:, :n] + p[:, n:]
    return p[:, 0]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return dots(x, y) / (np.sqrt(dots(x, x)) * np.sqrt(dots(y, y)))


def code(model: Model, vectors: np.ndarray) -> np.ndarray:
    """uint64 words of the codes, a row each. A block of rows at a time."""
    out = [np.packbits((unit(vectors[i : i + 4096]) - model.mean) @ model.turn > 0, axis=1, bitorder="little").view(np.uint64) for i in range(0, len(vectors), 4096)]
    return np.concatenate(out) if out else np.zeros((0, model.turn.shape[1] // 64), np.uint64)


def distance(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ query).sum(axis=1, dtype=np.int64)


@lru_cache(maxsize=8)
def masks(flips: int) -> np.ndarray:
    """All values of a substring's width with up to so many bits set."""
    return np.array([sum(1 << b for b in c) for n in range(flips + 1) for c in combinations(range(WIDTH), n)], np.int64)


class Shard:
    """Indexes of the substrings of some codes: for each substring a table of all values, from which a value's rows follow."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = codes.view(np.uint16).reshape(len(codes), -1)
        self.count = parts.shape[1]
        values = (1 << WIDTH) + 1
        self.order = np.empty(parts.shape[::-1], np.int32)
        self.start = np.zeros((self.count, values), np.int32)
        for j in range(self.count):
            self.order[j] = np.argsort(parts[:, j], kind="stable")
            self.start[j, 1:] = np.cumsum(np.bincount(parts[:, j], minlength=values - 1))
        self.start = self.start.ravel()
        self.base, self.first = np.arange(self.count)[:, None] * values, np.arange(self.count)[:, None] * len(codes)
        self.order = self.order.ravel()

    def probe(self, query: np.ndarray, flips: int) -> np.ndarray:
        """Rows that agree with the query in some substring but for up to `flips` bits."""
        held = np.zeros(len(self.codes), bool)
        if flips >= WIDTH:
            return np.arange(len(held))
        at = (query.view(np.uint16).astype(np.int64)[:, None] ^ masks(flips)[None]) + self.base
        low = self.start[at]
        size = self.start[at + 1] - low
        some = size > 0
        size, low = size[some].astype(np.int64), (low + self.first)[some]
        held[self.order[np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]] = True
        return np.flatnonzero(held)

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes lie within the radius: all of them, by the pigeonhole principle."""
        rows = self.probe(query, min(radius // self.count, WIDTH))
        return rows[distance(self.codes[rows], query) <= radius]

    def nearest(self, query: np.ndarray, flips: int, k: int, margin: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the codes found up to `margin` beyond the k-th; if fewer than k are found, of the k nearest of all."""
        rows = self.probe(query, flips)
        if len(rows) < k:
            rows = np.arange(len(self.codes))
        far = distance(self.codes[rows], query)
        limit = np.partition(far, k - 1)[k - 1] + margin if len(far) > k else far.max(initial=0)
        return rows[far <= limit], far[far <= limit]


def fit(vectors: np.ndarray, k: int, p: Index) -> Model:
    r = np.random.default_rng(p.seed)
    x = np.unique(unit(vectors), axis=0)
    mean = x.mean(axis=0)
    v, d = x - mean, x.shape[1]
    turns = []
    while sum(t.shape[1] for t in turns) < p.bits:
        turn, _ = np.linalg.qr(r.standard_normal((d, d)))
        for _ in range(p.steps):
            a, _, b = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (a @ b).T
        turns.append(turn)
    turn = np.concatenate(turns, axis=1)
    turn = turn[:, : max(64, turn.shape[1] // 64 * 64)] if turn.shape[1] >= 64 else np.pad(turn, ((0, 0), (0, 64 - turn.shape[1])))
    codes = code(Model(mean, turn, 0, 0), x)
    parts = codes.view(np.uint16).reshape(len(codes), -1)
    least, beyond = [], []
    for i in r.permutation(len(x))[: p.queries]:
        near = x @ x[i]
        near[i] = -2
        best = np.argsort(-near, kind="stable")[: min(k, len(x) - 1)]
        least += np.bitwise_count(parts[best] ^ parts[i]).min(axis=1).tolist()
        far = distance(codes, codes[i])
        far[i] = 1 << 40
        beyond += np.maximum(0, far[best] - np.partition(far, min(p.list, len(x)) - 1)[min(p.list, len(x)) - 1]).tolist() if len(best) else []
    flips = int(np.quantile(least, p.reach, method="higher")) if least else WIDTH
    return Model(mean, turn, flips, int(np.quantile(beyond, p.sure, method="higher")) if beyond else turn.shape[1])


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1) if values else np.zeros((0, 1), kind)


def search(df: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", p: Index = Index()) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other rows by cosine."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id).cast("long").alias("i"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("i").isNotNull()).where(usable(F.col("v")))
    rows = rows.groupBy("i").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    drawn = rows.select("v", F.xxhash64("i", F.lit(p.seed)).alias("h"), "i").orderBy("h", "i").limit(p.sample).select("v").toArrow().column("v").combine_chunks()
    spark, length = df.sparkSession, max(p.list, k + 1)
    if not len(drawn):
        return spark.createDataFrame([], T_RESULT)
    sizes = drawn.value_lengths().to_numpy()
    d = int(np.bincount(sizes).argmax())
    model = spark.sparkContext.broadcast(fit(drawn.filter(pa.array(sizes == d)).flatten().to_numpy().reshape(-1, d), k, p))  # of a size that the sample's dimension gives

    def pack(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                yield pa.RecordBatch.from_arrays([b.column("i"), b.column("q"), pa.array([r.tobytes() for r in x], pa.binary())], names=["i", "q", "v"])

    packed = reliable(rows.where(F.size("v") == d).mapInArrow(pack, "i long, q boolean, v binary").withColumn("cls", F.md5("v")))
    # classes: the least k + 1 ids of each; the rank is cut before the shuffle too, so a vector that a third of all rows have is no hot task
    order = F.row_number().over(Window.partitionBy("cls").orderBy("i"))
    least = packed.withColumn("n", order).where(F.col("n") <= k + 1)
    members = least.groupBy("cls").agg(F.array_sort(F.collect_list("i")).alias("ids"), F.min_by("v", "i").alias("v"))

    def encode(batches):
        for b in batches:
            if b.num_rows:
                c = code(model.value, _matrix(b.column("v"), np.float64))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in c], pa.binary())], names=["cls", "ids", "v", "c"])

    classes = reliable(members.mapInArrow(encode, "cls string, ids array<long>, v binary, c binary"))
    wanted = packed.where("q").select("cls").distinct()
    asked = classes.select(F.col("cls").alias("query"), F.col("c").alias("z")).join(wanted.withColumnRenamed("cls", "query"), "query", "left_semi")
    n, nq = classes.count(), wanted.count()
    shards, blocks = max(1, -(-n // p.shard)), max(1, -(-nq // p.block))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    index = classes.select("cls", "c", F.pmod(F.xxhash64("cls"), F.lit(shards)).cast("int").alias("shard")).select("*", every(blocks).alias("block"))
    asked = asked.select("query", "z", F.pmod(F.xxhash64("query", F.lit(1)), F.lit(blocks)).cast("int").alias("block")).select("*", every(shards).alias("shard"))

    def meet(rows_: pa.Table, queries: pa.Table) -> pa.Table:
        a, b, far = [], [], []
        if rows_.num_rows and queries.num_rows:
            m, shard = model.value, Shard(_matrix(rows_.column("c"), np.uint64))
            for i, z in enumerate(_matrix(queries.column("z"), np.uint64)):
                found, bits = shard.nearest(z, m.flips, length, m.margin)
                a.append(np.full(len(found), i))
                b.append(found)
                far.append(bits)
        flat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return pa.table({"query": queries.column("query").take(pa.array(flat(a))), "cls": rows_.column("cls").take(pa.array(flat(b))), "far": pa.array(flat(far), pa.int64())})

    near = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(meet, "query string, cls string, far long")
    # a shard's k-th best isn't the best k-th: once more over all shards
    rank = F.row_number().over(Window.partitionBy("query").orderBy("far", "cls"))
    limit = F.min(F.when(F.col("rank") >= length, F.col("far"))).over(Window.partitionBy("query"))
    near = near.withColumn("rank", rank).withColumn("limit", limit).where(F.col("limit").isNull() | (F.col("far") <= F.col("limit") + model.value.margin)).select("query", "cls")

    def score(batches):
        for x, y in batches:
            yield pa.array(cosines(_matrix(x, np.float64), _matrix(y, np.float64)) if len(x) else [], pa.float64())

    score.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    one, other = classes.select(F.col("cls").alias("one"), "ids", "v"), classes.select(F.col("cls").alias("other"), F.col("v").alias("w"))
    scored = near.join(one, F.col("cls") == F.col("one")).join(other, F.col("query") == F.col("other")).select("query", "ids", F.arrow_udf(score, "double")("v", "w").alias("score"))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "i")
    top = scored.select("query", F.explode("ids").alias("i"), "score").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    # a query of the class takes no part in its own list
    mine = packed.where("q").select(F.col("i").alias("query_id"), F.col("cls").alias("query")).join(top, "query").where("query_id <> i")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "i"))
    return mine.select("query_id", place.alias("rank"), F.col("i").alias("vec_id"), "score").where(F.col("rank") <= k)


T_RESULT = "query_id long, rank int, vec_id long, score double"
