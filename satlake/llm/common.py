"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.operators.lineage import cut

#: Python work on texts goes in runs of documents of about this many bytes, whatever the Arrow batch holds.
CHUNK_BYTES = 600_000
#: Bytes of an Arrow batch to and from Python, of which a task holds a few at once; a longer row is a batch of its own.
BATCH_BYTES = "4m"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column; an input column of that name is replaced."""
    return df.withColumn(name, value)


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage through the folder in spark.checkpoint.dir, which every executor shares."""
    return cut(df)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def runs_of(array: pa.Array) -> Iterator[pa.Array]:
    """Consecutive runs of an array's texts."""
    size = pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(array):
        end, total = at + 1, int(size[at])
        while end < len(array) and total + size[end] <= CHUNK_BYTES:
            total += int(size[end])
            end += 1
        yield array.slice(at, end - at)
        at = end


def texts_of(array: pa.Array) -> Iterator[list[str]]:
    """Consecutive runs of an array's texts (null: empty), each made into Python strings only when it is reached."""
    for run in runs_of(array):
        yield [t or "" for t in run.to_pylist()]


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker idles on after its task, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_udf(work: Callable[[], Callable[[list[str]], Iterable]], returns: str, kind: pa.DataType) -> Callable[[Column | str], Column]:
    """An Arrow UDF over one text column. work() is called once a task and gives the function from a run of texts
    (null: empty) to one result each."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = work()
        for a in arrays:
            parts = [pa.array(list(f(c)), type=kind) for c in texts_of(a)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=kind)
        del f
        give_back()

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    edges(u long, v long): links, in any order, repeated or not; loops and nulls are left out. Returns (node, root), one row for each node
    of a link, root being the smallest node of its component. Each step moves every edge once, and a hot node's
    edges meet only in sums (its minimum) and in a join whose other side has one row a node; that side is written first, so that both
    sides are plain exchanges and a skewed join can be split.
    Nothing goes to the driver but two counts a round.
    """
    both = lambda e: e.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(e.select(F.col("v").alias("a"), F.col("u").alias("b")))
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = reliable(e)
    for _ in range(rounds):
        # large star: each larger neighbour is tied to the smallest of the neighbourhood
        pairs = both(e)
        least = reliable(pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")))
        large = pairs.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the smaller neighbours are tied to the smallest of them, and so is the node
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("s"))
        e = reliable(small.select("s.u", "s.v").where("u <> v").distinct())
        # done if all that is left are stars: each node tied to one, which is tied to none
        ends = e.groupBy("u").agg(F.count("*").alias("n")).join(e.select(F.col("v").alias("root")).distinct(), F.col("u") == F.col("root"), "left")
        most, inner = ends.agg(F.max("n"), F.count("root")).first()
        if (most or 1) == 1 and inner == 0:
            break
    else:
        raise RuntimeError("components didn't settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
