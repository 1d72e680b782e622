"""N-gram Jaccard join with Bayesian pruning (BayesLSH-Lite: Satuluri and Parthasarathy, 2012).

Shingles: five consecutive words (what lies between ASCII white space); a text of one to four words has one shingle, of them all. Two texts are
linked if the Jaccard similarity of their shingle sets is 0.8 or more. Texts without words are linked to none.

1. Each text has 160 MinHash values, in 32 bands of five. Texts that share a band's values are candidates: at similarity 0.8 a pair is
   missed with probability 3e-6. Bands meet in sums of the least and greatest text, so neither copies nor a bucket that a third of all texts
   are in gather anywhere; each text of a bucket is tied to the bucket's least one, and components of these ties are the groups in which pairs are sought.
2. Equal texts are one class. Each class of a group is read once: its shingles, its size and a byte of each MinHash value go on, the text doesn't. A group of up to `block` classes is
   one unit of work. In a larger one, the text of least MD5 is the pivot, and each class is held as its difference from it: shingles that just one of the two has, a few for near
   copies. Jaccard distance is a metric, so classes linked differ in their distance to the pivot by 1 - 0.8 at most: classes are dealt by that distance in such steps and by size, in
   steps of a quarter, and only neighbouring steps are compared. Steps are dealt by hash into blocks, and a unit is a pair of blocks.
3. Inside a unit, MinHash bytes are compared sixteen at a time. A pair is dropped when, given its m agreements in n, the posterior probability (uniform
   prior) of a similarity of 0.8 or more is below `tolerance`; bytes agree no less often than values, so none is dropped that values would keep. What is left is verified exactly: two
   texts' difference is the difference of their differences from the pivot.
4. A unit returns one row a class: its links, and the least class that it is tied to. No pairs are returned. Components of the ties are
   the near-duplicate groups.

The number of links of every text is part of the result, so work in a group grows with its pairs of neighbouring steps; rows moved are a few hundred bytes a class and block.

Shingles and classes are told apart by 64-bit and 128-bit hashes.

Result: one row a document: its class (least document id of the equal texts), its group (least id of all linked, directly or through others), how many
different texts it is linked to, and how many other documents, copies included. Null text: empty. Null id: it can be no class's or group's
name unless the class has no other id. Rows of equal id and text are documents of their own, and copies of each other. Where an id repeats with
other text, groups that aren't linked can have one name: the group's key tells them apart (null for texts without words, which are in no group).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import components, give_back, reliable, small_batches, texts_of


SALTS = 32


@dataclass(frozen=True)
class Join:
    words: int = 5
    num: int = 4  # the threshold, num / den
    den: int = 5
    bands: int = 32
    rows: int = 5
    step: int = 16
    tolerance: float = 1e-7
    block: int = 128


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, one text after another; where each text starts, and the end)."""
    import xxhash

    known: dict[bytes, int] = {}
    coded = [[known.setdefault(w, len(known)) for w in t.encode().split()] for t in texts]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
    out, start = [], np.zeros(len(texts) + 1, np.int64)
    for i, c in enumerate(coded):
        h = hashes[np.array(c, np.int64)] if c else hashes[:0]
        k = min(n, len(h))
        m = len(h) - k + 1 if k else 0
        x = np.full(m, k, np.uint64)
        for j in range(k):
            x = _mix(x + h[j : j + m] * np.uint64(2 * j + 1))
        x = np.unique(x)
        out.append(x)
        start[i + 1] = start[i] + len(x)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), start


@lru_cache(maxsize=8)
def _turns(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20)
    return r.integers(0, 1 << 32, count, dtype=np.uint32), r.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash(flat: np.ndarray, start: np.ndarray, count: int) -> np.ndarray:
    """count values a text; texts without shingles must not be among them."""
    low = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(start) - 1, count), np.uint32)
    if len(out):
        for k, (x, m) in enumerate(zip(*_turns(count), strict=True)):
            out[:, k] = np.minimum.reduceat((low ^ x) * m, start[:-1])
    return out


def band_keys(signs: np.ndarray, p: Join) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), (len(signs), p.bands)).copy()
    parts = signs.reshape(len(signs), p.bands, p.rows).astype(np.uint64)
    for r in range(p.rows):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys.view(np.int64)


@lru_cache(maxsize=8)
def least_agreements(p: Join) -> tuple[int, ...]:
    """After each step of n values: the fewest agreements with which P(similarity >= threshold | agreements) is still the tolerance.
    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and its upper tail at t is P(Binomial(n + 1, t) <= m)."""
    t, out = p.num / p.den, []
    for n in range(p.step, p.bands * p.rows + 1, p.step):
        tail, m = 0.0, -1
        while tail < p.tolerance:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def linked(flat: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray, p: Join, signs: np.ndarray | None = None, size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, b) of texts, those linked: first by length, then by steps of MinHash bytes, then exactly. flat, start: each text's shingles, or, where
    signs and size are given beside them, its difference from one set that all texts share."""
    held = np.diff(start)
    size = held if size is None else size
    fits = np.minimum(size[a], size[b]) * p.den >= np.maximum(size[a], size[b]) * p.num
    a, b = a[fits], b[fits]
    signs = minhash(flat, start, p.bands * p.rows).astype(np.uint8) if signs is None else signs
    agreed = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_agreements(p)):
        part = slice(k * p.step, (k + 1) * p.step)
        agreed += (signs[a, part] == signs[b, part]).sum(axis=1)
        live = agreed >= least
        a, b, agreed = a[live], b[live], agreed[live]
    if not len(a):
        return a, b
    common = np.empty(len(a), np.int64)
    if len(a) > 4 * len(held):  # many pairs: all intersections at once, by the shingles that more than one text has
        used = np.unique(np.concatenate([a, b]))
        at = np.full(len(held), -1)
        at[used] = np.arange(len(used))
        owner = np.repeat(np.arange(len(held)), held)
        mine = at[owner] >= 0
        _, column, often = np.unique(flat[mine], return_inverse=True, return_counts=True)
        shared = often[column] > 1
        rank = np.cumsum(often > 1) - 1
        row, column = at[owner[mine][shared]], rank[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total = np.zeros((len(used), len(used)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            lo, hi = np.searchsorted(column, [low, low + 4096])
            hit = np.zeros((len(used), 4096), np.float32)
            hit[row[lo:hi], column[lo:hi] - low] = 1
            total += hit @ hit.T
        common = total[at[a], at[b]].astype(np.int64)
    else:
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            common[k] = len(np.intersect1d(flat[start[i] : start[i + 1]], flat[start[j] : start[j + 1]], assume_unique=True))
    apart = held[a] + held[b] - 2 * common  # shingles that just one of the two has
    both = (size[a] + size[b] - apart) // 2
    near = both * p.den >= (size[a] + size[b] - both) * p.num
    return a[near], b[near]


def _bands(p: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                flat, start = shingle_sets(texts, p.words)
                full = np.flatnonzero(np.diff(start))
                keys = band_keys(minhash(flat, np.append(start[:-1][full], start[-1]), p.bands * p.rows), p)
                node = batch.column(0).slice(at, len(texts)).to_numpy(zero_copy_only=False)[full]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(node, p.bands))], names=["band", "node"])
        give_back()

    return run


HELD = pa.schema([("comp", pa.int64()), ("node", pa.int64()), ("md5", pa.string()), ("copies", pa.int64()), ("n", pa.int64()), ("signs", pa.binary()), ("grams", pa.binary())])
T_HELD = "comp long, node long, md5 string, copies long, n long, signs binary, grams binary"


def _read(p: Join):
    """(comp, node, md5, copies, text, more) to what a unit needs of each: size, MinHash bytes and sorted shingles, and what else there is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(4)):
                flat, start = shingle_sets(texts, p.words)
                signs = minhash(flat, start, p.bands * p.rows).astype(np.uint8)
                part = batch.slice(at, len(texts))
                at += len(texts)
                grams = [flat[i:j].tobytes() for i, j in zip(start, start[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(np.diff(start)), pa.array([x.tobytes() for x in signs], pa.binary()), pa.array(grams, pa.binary()), *part.columns[5:]], names=[*HELD.names, *part.schema.names[5:]])
        give_back()

    return run


def _differ(p: Join):
    """The same columns and `pivot` to T_HELD with differences from the pivot as grams, and `step`: the distance from the pivot, in steps of what two linked texts can differ by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, steps = [], []
            for own, pivot in zip(batch.column(6), batch.column(7), strict=True):
                x, y = np.frombuffer(own.as_py(), np.uint64), np.frombuffer(pivot.as_py(), np.uint64)
                d = np.setxor1d(x, y, assume_unique=True)
                grams.append(d.tobytes())
                steps.append(2 * len(d) * p.den // ((len(x) + len(y) + len(d)) * (p.den - p.num)))  # distance: what differs, of the union
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(grams, pa.binary()), pa.array(steps, pa.int32())], names=[*HELD.names, "step"])

    return run


def _units(p: Join):
    def unit(table: pa.Table) -> pa.Table:
        node, side, size = (table.column(c).to_numpy() for c in ("node", "side", "n"))
        copies = table.column("copies").to_numpy()
        n = len(node)
        grams = table.column("grams").to_pylist()
        flat, start = np.frombuffer(b"".join(grams), np.uint64), np.append(0, np.cumsum([len(g) // 8 for g in grams]))
        signs = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint8).reshape(n, -1)
        if (side < 0).any():  # one block with itself, or a whole small group
            a, b = np.triu_indices(n, 1)
        else:
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            a, b = np.repeat(one, len(two)), np.tile(two, len(one))
        a, b = linked(flat, start, a, b, p, signs, size)
        links = np.bincount(np.concatenate([a, b]), minlength=n)
        others = np.bincount(np.concatenate([a, b]), np.concatenate([copies[b], copies[a]]), n).astype(np.int64)
        root = np.arange(n)
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            while root[i] != i:
                root[i] = i = root[root[i]]
            while root[j] != j:
                root[j] = j = root[root[j]]
            if i != j:
                root[max(i, j)] = min(i, j)
        for i in range(n):
            root[i] = root[root[i]]
        some = links > 0
        return pa.table({"md5": table.column("md5").filter(pa.array(some)), "node": node[some], "root": node[root[some]], "links": links[some], "others": others[some]})

    return unit


STEPS = 1024  # above the most steps of distance, so that size and distance make one number


def classes(df: DataFrame, p: Join = Join()) -> DataFrame:
    """df: doc_id, text (not null). (md5, node, class, copies, group, key, links, others) of each class; key is the group's own, whatever its ids."""
    small_batches(df.sparkSession)
    node, key = F.xxhash64("text").alias("node"), F.md5(F.col("text").cast("binary")).alias("md5")
    bands = df.select(node, "text").mapInArrow(_bands(p), "band long, node long")
    met = reliable(bands.distinct())
    least = met.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").withColumnRenamed("band", "b")
    ties = met.join(least, F.col("band") == F.col("b")).select(F.col("node").alias("u"), F.col("low").alias("v"))
    groups = components(ties).withColumnsRenamed({"node": "n", "root": "comp"})

    named = df.select("doc_id", node, key).groupBy("node", "md5").agg(F.min("doc_id").alias("class"), F.count("*").alias("copies"))
    named = reliable(named)
    sought = reliable(named.join(groups, F.col("node") == F.col("n")).select("comp", "node", "md5", "class", "copies"))
    # groups of over one block, each once for every salt, so that such a group's classes aren't dealt to one task by its number
    salted = lambda df: df.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("md5"), F.lit(SALTS)).cast("int").alias("salt")
    many = salted(sought.groupBy(F.col("comp").alias("c")).agg(F.count("*").alias("all")).where(F.col("all") > p.block).select("c"))
    told = sought.select("*", salt).join(many, (F.col("comp") == F.col("c")) & (F.col("salt") == F.col("s")), "left").select(*sought.columns, F.col("c").isNotNull().alias("many"))
    # the text of one document of each class; ids are not hot, as md5s may be
    own = df.select(F.col("doc_id").alias("d"), F.md5(F.col("text").cast("binary")).alias("m"), "text")
    one = told.join(own, F.col("class").eqNullSafe(F.col("d")) & (F.col("md5") == F.col("m"))).dropDuplicates(["md5", "node"])
    held = reliable(one.select("comp", "node", "md5", "copies", "text", "many").mapInArrow(_read(p), f"{T_HELD}, many boolean"))
    large, small = held.where("many"), held.where("not many")
    pivots = salted(large.groupBy(F.col("comp").alias("c")).agg(F.min_by("grams", "md5").alias("pivot")))
    near = large.select("*", salt).join(pivots, (F.col("comp") == F.col("c")) & (F.col("salt") == F.col("s"))).select(*HELD.names, "pivot")
    width = math.log(p.den / p.num) * 1.0001
    size = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    near = reliable(near.mapInArrow(_differ(p), f"{T_HELD}, step int").withColumn("k", size * STEPS + F.col("step")))
    parts = near.groupBy("comp", "k").agg(F.ceil(F.count("*") / p.block).cast("int").alias("blocks"))
    per = salted(parts.groupBy(F.col("comp").alias("c")).agg(F.map_from_entries(F.collect_list(F.struct("k", "blocks"))).alias("blocks")))  # steps of size and distance are few
    dealt = near.select("*", salt).join(per, (F.col("comp") == F.col("c")) & (F.col("salt") == F.col("s")))
    k = F.col("k")
    sub = F.pmod(F.xxhash64("md5", F.lit(1)), F.element_at("blocks", k)).cast("int")
    unit = lambda k1, b1, k2, b2, side: F.struct(k1.alias("k1"), b1.alias("b1"), k2.alias("k2"), b2.alias("b2"), side.alias("side"))
    none = F.array().cast("array<struct<k1:int,b1:int,k2:int,b2:int,side:int>>")
    upto = lambda other: F.sequence(F.lit(0), F.try_element_at("blocks", other) - 1)
    within = F.transform(upto(k), lambda s: unit(k, F.least(s, sub), k, F.greatest(s, sub), F.when(s == sub, -1).when(s > sub, 0).otherwise(1)))
    above = lambda m: F.coalesce(F.transform(upto(k + m), lambda s: unit(k, sub, k + m, s, F.lit(0))), none)
    below = lambda m: F.coalesce(F.transform(upto(k - m), lambda s: unit(k - m, s, k, sub, F.lit(1))), none)
    where = [within, *[side(m) for m in (1, STEPS - 1, STEPS, STEPS + 1) for side in (above, below)]]
    carried = ("node", "md5", "copies", "n", "signs", "grams")
    units = dealt.select("comp", F.explode(F.concat(*where)).alias("u"), *carried).select("comp", "u.*", *carried)
    zero = F.lit(0)
    units = units.unionByName(small.select("comp", *[zero.alias(c) for c in ("k1", "b1", "k2", "b2")], F.lit(-1).alias("side"), *carried))
    shape = ("comp", "k1", "b1", "k2", "b2")
    units = units.groupBy(*shape).applyInArrow(_units(p), "md5 string, node long, root long, links long, others long")
    units = reliable(units)
    found = units.groupBy("md5", "node").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))
    roots = components(units.select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnsRenamed({"node": "n", "root": "r"})
    joined = named.join(found.withColumnsRenamed({"md5": "m", "node": "o"}), (F.col("md5") == F.col("m")) & (F.col("node") == F.col("o")), "left").join(roots, (F.col("node") == F.col("n")) & F.col("m").isNotNull(), "left")
    joined = joined.select("md5", "node", "class", "copies", F.col("r").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("others", F.lit(0)).alias("others"))
    first = joined.where("root is not null").groupBy("root").agg(F.min("class").alias("group")).withColumnRenamed("root", "r")
    return joined.join(first, F.col("root") == F.col("r"), "left").select("md5", "node", "class", "copies", F.coalesce("group", "class").alias("group"), F.coalesce(F.col("root").cast("string"), "md5").alias("key"), "links", "others")


def near_duplicates(df: DataFrame, p: Join = Join(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows in a struct `row`, with class, group, the group's key, links (different texts) and others (documents linked, copies included)."""
    plain = F.coalesce(F.col(text), F.lit(""))
    found = classes(df.select(F.col(id).cast("long").alias("doc_id"), plain.alias("text")), p).withColumnsRenamed({"md5": "m", "node": "n"})
    rows = df.select(F.struct("*").alias("row"), F.md5(plain.cast("binary")).alias("own_md5"), plain.rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    joined = rows.join(found, F.col("own_md5") == F.col("m"))
    own = F.col(f"row.`{id}`").cast("long")
    pick = lambda c, empty: F.when(F.col("worded"), c).otherwise(empty)
    return joined.select("row", pick(F.col("class"), own).alias("class"), pick(F.col("group"), own).alias("group"), pick(F.col("key"), F.lit(None)).alias("key"), F.col("links"), pick(F.col("others") + F.col("copies") - 1, F.lit(0)).alias("others"))


def keep_one(df: DataFrame, p: Join = Join(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that stay: of each group, told by its key, the one of the least id (rows of that id, or without any id: the text of least MD5, and one of them); texts without
    words all stay. Rows are looked up by id and text at once, which is not hot however many copies there are."""
    plain = F.coalesce(F.col(text), F.lit(""))
    worded = plain.rlike(r"[^\x20\x09-\x0D]")
    found = classes(df.where(worded).select(F.col(id).cast("long").alias("doc_id"), plain.alias("text")), p)
    least = F.min(F.struct(F.col("class").isNull().alias("none"), "class", "md5"))  # a null id is the least only where the group has no other
    first = found.groupBy("key").agg(least.alias("least")).select("least.class", F.col("least.md5").alias("m"))
    rows = df.where(worded).select(F.struct("*").alias("row"), F.col(id).cast("long").alias("own"), F.md5(plain.cast("binary")).alias("own_md5"))
    kept = rows.join(first, F.col("own").eqNullSafe(F.col("class")) & (F.col("own_md5") == F.col("m")))
    one = kept.groupBy("class", "m").agg(F.first("row").alias("row"))
    return one.select("row.*").unionByName(df.where(~worded))
