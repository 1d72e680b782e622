"""A versioned store of Parquet tables, each a list of folders that a manifest names.

Every table only grows: a batch adds a folder to the facts (partitioned by `height_bucket`) and one to each derived log. A derived log holds changes, which fold() sums up in any order
and grouping: outputs that open (+1) or close (-1), parts of balances, history rows. So a batch writes what it changes, however much is there; a read folds a few folders.
Folders are merged as they gather, FAN of one level into one of the next, so a row is rewritten once a level.

Nothing is visible until a manifest names it. Manifests are numbered files; a new one is renamed into place without overwriting, which Hadoop file systems do in one step,
so a batch's facts and changes appear together or not at all, and of two writers that start from one version the second gets a Conflict. Heights that are in are listed
as ranges, for good: a replay is known by its heights, whatever stream or checkpoint it comes from. Older versions stay until vacuum().

Lookups: files are sorted by their key (facts by height) and have Bloom filters on ids and addresses, so a literal filter on one reads the few row groups that may hold it.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from satlake.operators import derive

FACTS = {"blocks": ("hash",), "transactions": ("txid",), "tx_outputs": ("txid", "address"), "tx_inputs": ("txid", "prev_txid")}
LOGS = {"outputs_open": ("txid", "address"), "address_balances": ("address",), "address_transactions": ("address",)}
KEYS = {"outputs_open": ("txid", "vout_idx"), "address_balances": ("address",), "address_transactions": ("address", "block_height")}
STEPS = ("spend", "receivers", "senders", "balances", "utxo_counts")
FAN = 16

Ranges = list[list[int]]  # [first, last], both inclusive, in order and apart


class Conflict(RuntimeError):
    """Another writer has committed since the version that this commit started from."""


def joined(ranges: Ranges, more: Ranges) -> Ranges:
    out: Ranges = []
    for a, b in sorted([*map(list, ranges), *map(list, more)]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def common(ranges: Ranges, other: Ranges) -> Ranges:
    return [[max(a, c), min(b, d)] for a, b in ranges for c, d in other if max(a, c) <= min(b, d)]


def without(ranges: Ranges, other: Ranges) -> Ranges:
    out = [list(r) for r in ranges]
    for c, d in other:
        out = [r for a, b in out for r in ([a, min(b, c - 1)], [max(a, d + 1), b]) if r[0] <= r[1]]
    return out


def bridged(ranges: Ranges, other: Ranges) -> Ranges:
    """Ranges joined over gaps that hold nothing of the others: as a filter on rows of both, the same with fewer terms."""
    out: Ranges = []
    for a, b in ranges:
        if out and not common(other, [[out[-1][1] + 1, a - 1]]):
            out[-1][1] = b
        else:
            out.append([a, b])
    return out


def runs_of(heights: DataFrame) -> Ranges:
    """The ranges of a column of heights, each of which must occur once."""
    n, distinct, low, high = heights.agg(F.count("*"), F.countDistinct("height"), F.min("height"), F.max("height")).first()
    if n != distinct:
        raise ValueError(f"{n - distinct} heights occur more than once")
    if not n:
        return []
    if n == high - low + 1:
        return [[low, high]]
    runs = heights.withColumn("run", F.col("height") - F.row_number().over(Window.orderBy("height"))).groupBy("run").agg(F.min("height").alias("a"), F.max("height").alias("b"))
    return joined([], [[r.a, r.b] for r in runs.collect()])


def inside(ranges: Ranges, height: Column) -> Column:
    out = F.lit(False)
    for a, b in ranges:
        out = out | height.between(a, b)
    return out


def fold(table: str, parts: DataFrame) -> DataFrame:
    """The changes of a log summed up; also what merging folders does."""
    if table == "outputs_open":
        rest = [c for c in parts.columns if c != "change"]
        return parts.groupBy(*rest).agg(F.sum("change").cast("int").alias("change")).where("change <> 0")
    return derive.fold_balances(parts) if table == "address_balances" else parts


class Store:
    """All paths go through Spark's Hadoop file systems, so a store may lie in any that Spark can open."""

    def __init__(self, spark: SparkSession, root: str, width: int = 100_000):
        self.spark, self.root, self.width = spark, root.rstrip("/"), width
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- the manifest

    def _list(self, folder: str) -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def manifest(self) -> dict:
        found = [n for n in self._list("manifest") if n.endswith(".json") and not n.startswith(".")]
        if not found:
            return {"version": 0, "last_height": None, "last_hash": None, "tables": {t: [] for t in (*FACTS, *LOGS)}, "ranges": [], "done": {s: [] for s in STEPS}, "batches": []}
        stream = self._fs.open(self._path(f"{self.root}/manifest/{max(found)}"))
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _publish(self, m: dict) -> None:
        """Make m the next version, if nobody has made one since."""
        m["version"] += 1
        new, at = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}"), self._path(f"{self.root}/manifest/{m['version']:012d}.json")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(new), self._fs.makeQualified(at), none)
        except Exception as e:
            self._fs.delete(new, False)
            if "AlreadyExists" in str(e):
                raise Conflict(f"version {m['version']} has been committed by another writer") from e
            raise

    # ---- reading

    def _read(self, table: str, parts: list[dict]) -> DataFrame | None:
        """One scan of some folders; their names are a partition column that is dropped."""
        if not parts:
            return None
        return self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*[f"{self.root}/{p['at']}" for p in parts]).drop("batch")

    def facts(self, table: str) -> DataFrame | None:
        return self._read(table, self.manifest()["tables"][table])

    def log(self, table: str) -> DataFrame | None:
        """The changes of a derived table, not folded."""
        return self._read(table, self.manifest()["tables"][table])

    def derived(self, table: str) -> DataFrame | None:
        """A derived table as of the last commit; `utxo_set` is `outputs_open` with an address. None if nothing is derived."""
        if table == "utxo_set":
            whole = self.derived("outputs_open")
            return None if whole is None else whole.where("address is not null")
        parts = self.manifest()["tables"][table]
        df = self._read(table, parts)
        if df is None:
            return None
        df = fold(table, df) if len(parts) > 1 else df
        return df.where("change > 0").drop("change") if table == "outputs_open" else df

    def whole(self, *steps: str) -> bool:
        """Whether these steps have been derived for all heights that are in."""
        m = self.manifest()
        return bool(m["ranges"]) and not any(without(m["ranges"], m["done"][s]) for s in steps)

    def last_height(self) -> int:
        """The highest block; -1 if there is none."""
        h = self.manifest()["last_height"]
        return -1 if h is None else h

    # ---- writing

    def _write(self, table: str, df: DataFrame, at: str) -> None:
        keys = KEYS.get(table) or (("height",) if table == "blocks" else ("height_bucket", "block_height"))
        w = df.sortWithinPartitions(*keys).write.mode("errorifexists").option("parquet.bloom.filter.adaptive.enabled", "true")
        for c in FACTS.get(table) or LOGS[table]:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
        (w.partitionBy("height_bucket") if "height_bucket" in df.columns else w).parquet(f"{self.root}/{at}")

    def _add(self, m: dict, tables: list[tuple[str, DataFrame]], tag: str) -> None:
        """Write folders, side by side as they don't depend on each other, and list them in m."""
        ats = [f"{t}/batch={tag}-{i}" for i, (t, _) in enumerate(tables)]
        with ThreadPoolExecutor(len(tables) or 1) as pool:
            list(pool.map(lambda x: self._write(x[0][0], x[0][1], x[1]), zip(tables, ats, strict=True)))
        for (t, _), at in zip(tables, ats, strict=True):
            m["tables"][t] = [*m["tables"][t], {"at": at, "level": 0}]

    def _tag(self, m: dict) -> str:
        return f"{m['version'] + 1:010d}-{uuid.uuid4().hex[:8]}"

    @contextlib.contextmanager
    def staging(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """A function that writes a DataFrame and reads it back, so that what follows doesn't compute it again. The files go at the end."""
        folder = f"{self.root}/staging/{uuid.uuid4().hex}"

        def stage(df: DataFrame) -> DataFrame:
            at = f"{folder}/{uuid.uuid4().hex}"
            df.write.parquet(at)
            return self.spark.read.schema(df.schema).parquet(at)

        try:
            yield stage
        finally:
            self._fs.delete(self._path(folder), True)

    def commit(self, facts: dict[str, DataFrame], heights: Ranges, batch: str | None = None, changes: Callable[[dict[str, DataFrame]], list[tuple[str, DataFrame]]] | None = None) -> bool:
        """Append a batch's facts and the changes that `changes` makes of them, for all steps. False if a batch of this name is in already.
        A height that is in already is an error, as a primary key would make it."""
        m = self.manifest()
        if batch is not None and batch in m["batches"]:
            return False
        if again := common(m["ranges"], heights):
            raise ValueError(f"heights {again} are in the store already")
        tag = self._tag(m)
        self._add(m, [(t, facts[t] if t == "blocks" else derive.with_bucket(facts[t], self.width)) for t in FACTS], tag)
        staged = {t: self._read(t, m["tables"][t][-1:]) for t in FACTS}
        if changes:
            self._add(m, changes(staged), f"{tag}-c")
            m["done"] = {s: joined(m["done"][s], heights) for s in STEPS}
        top = staged["blocks"].selectExpr("max(height) h", "lower(hex(max_by(hash, height))) x").first()
        if m["last_height"] is None or top.h >= m["last_height"]:
            m["last_height"], m["last_hash"] = top.h, top.x
        m["ranges"] = joined(m["ranges"], heights)
        m["batches"] = [*m["batches"], *([batch] if batch is not None else [])]
        self._publish(m)
        return True

    def append(self, m: dict, changes: list[tuple[str, DataFrame]], done: dict[str, Ranges]) -> None:
        """Add changes to the derived logs of version m, and what steps they complete."""
        self._add(m, changes, self._tag(m))
        m["done"] = {s: joined(m["done"][s], done.get(s, [])) for s in STEPS}
        self._publish(m)

    def _merge(self, m: dict, table: str, first: int, level: int) -> None:
        """One folder in place of all from the given one on, its rows dealt by range of the key."""
        df = self._read(table, m["tables"][table][first:])
        df = fold(table, df) if table in LOGS else df
        keys = KEYS.get(table) or (("height",) if table == "blocks" else ("height_bucket", "block_height"))
        at = f"{table}/batch={self._tag(m)}-m{level}"
        self._write(table, df.repartitionByRange(*keys), at)
        m["tables"][table] = [*m["tables"][table][:first], {"at": at, "level": level}]

    def tidy(self, fan: int = FAN) -> bool:
        """Merge folders where `fan` of one level have gathered at a table's end."""
        m, merged = self.manifest(), False
        for t in m["tables"]:
            while parts := m["tables"][t]:
                first = len(parts)
                while first and parts[first - 1]["level"] == parts[-1]["level"]:
                    first -= 1
                if len(parts) - first < fan:
                    break
                self._merge(m, t, first, parts[-1]["level"] + 1)
                merged = True
        if merged:
            self._publish(m)
        return merged

    def compact(self) -> None:
        """Each table merged into one folder, in files of disjoint key ranges: what rebuilding indexes after a bulk load does."""
        m = self.manifest()
        for t, parts in list(m["tables"].items()):
            if parts:
                self._merge(m, t, 0, 1 + max(p["level"] for p in parts))
        self._publish(m)

    def drop(self, folder: str) -> None:
        """Delete a folder beside the tables, such as a stream's checkpoint."""
        self._fs.delete(self._path(f"{self.root}/{folder}"), True)

    def vacuum(self) -> int:
        """Delete older manifests, staged files and folders that the manifest doesn't name. Not while another job reads an older version or writes."""
        m = self.manifest()
        named = {p["at"] for parts in m["tables"].values() for p in parts} | {f"manifest/{m['version']:012d}.json"}
        gone = 0
        for top in (*FACTS, *LOGS, "manifest", "staging"):
            for name in self._list(top):
                if f"{top}/{name}" not in named:
                    self._fs.delete(self._path(f"{self.root}/{top}/{name}"), True)
                    gone += 1
        return gone
