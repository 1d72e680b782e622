"""Topics of documents by a classifier that is fitted to all different texts: spherical k-means over weighted words, one set of clusters a language.

Words are what lies between ASCII white space. A text that occurs often counts once, in the least of its languages. Of a language's texts, words that over half of them hold say
little and are left out, and of the rest the `words` most common make the vocabulary, weighted by inverse document frequency. A text's topic is the cluster whose centre its words
add up to best; clusters are named t0, t1... by size, so a topic's name says which cluster of its language it is. A language with too few texts has one cluster, as have those
beyond the `languages` with most texts.

Texts are parsed once, into units of word numbers under a dictionary of the unit's own. Document frequencies are sums over the dictionaries. Most words stand in few texts and can't be among the most
common: a unit gives the words that more than its `cut` of texts hold, what it keeps back is at most the sum of cuts, and so these partial sums bound each word's frequency from both sides. Words that
may be among the most common by these bounds are counted exactly; where the bounds don't tell, all words are. The vocabulary then turns units into vectors, and
each step of k-means is a pass over all vectors, of which only sums by cluster and word leave a task. For each first centre a few texts are drawn, with
probabilities that grow with the distance from those chosen, by races of hashed numbers, and the one that leaves the least distance is chosen. Vectors and centres are whole multiples of 1 / ONE, whose products and sums doubles hold
exactly, so the model doesn't depend on order, partitions or retries. The driver holds vocabularies and centres, whose size the parameters bound.

Null or empty text, or none of the vocabulary's words: topic "none". Null language: a language of its own. Ties: the larger cluster.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlake.llm.common import give_back, reliable, runs_of, small_batches

#: What a vector's entries are multiples of: ONE * ONE and the sums of products of unit vectors stay below 2^53.
ONE = 1 << 26
#: Words in a unit of texts, and entries in a row of vectors, about.
UNIT = 2_000_000
ROW = 100_000
#: Bytes of packed word numbers whose vectors make a partition, about.
PART = 16 << 20
#: Words that are sorted at once, about.
RUN = 32_768
#: Texts that are drawn for each first centre.
DRAWS = 4
#: Words that may be a language's most common by their bounds: beyond this many times `words`, all words are counted.
LIKELY = 16
#: Counts in a row of sums.
COUNTS = 1024
UNITS = "lang string, words binary, keys binary, sizes binary, ids binary, counts binary, docs binary, cut long"
SUMS = "lang string, cluster int, texts long, sums binary"
RACE = "lang string, pick int, draw int, left long, time double, key long, places binary, entries binary"


@dataclass(frozen=True)
class Topics:
    """fewest: texts of a cluster's language for each cluster; with fewer, a language has one. sample: None, or about how many texts a caller wants the model fitted to instead of all."""

    count: int = 6
    sample: int | None = None
    words: int = 4096
    languages: int = 64
    fewest: int = 10
    rounds: int = 15
    seed: int = 5


Model = dict[str, tuple[dict[bytes, int], np.ndarray]]  # by language: the place of each word, and its weight in each cluster
Batches = Iterator[pa.RecordBatch]


def different(df: DataFrame, text: Column, lang: Column, p: Topics) -> DataFrame:
    """(key, lang, text) of all different texts."""
    key = F.xxhash64(text, F.lit(p.seed))
    rows = df.select(key.alias("key"), F.coalesce(lang.cast("string"), F.lit("")).alias("lang"), text.alias("text")).where(F.col("text").isNotNull())
    if p.sample is not None:
        n = df.count()
        rows = rows.where(F.pmod("key", F.lit(1 << 40)) < ((1 << 40) if n <= p.sample else int((1 << 40) * p.sample / n)))
    return rows.groupBy("key").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each has."""
    parts = pc.ascii_split_whitespace(texts)
    words, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy()
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at either end makes an empty word
    return words.filter(real), np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real.to_numpy(zero_copy_only=False)], minlength=len(sizes))


def pack(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="lz4", asbytes=True)


def unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="lz4", asbytes=True)


def planes(x: np.ndarray) -> bytes:
    """Whole numbers, packed byte by byte of each, as high bytes are mostly zero."""
    return pack(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Unit:
    """Texts of one language as numbers of words, in the order of a dictionary that has the unit's words only."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.words: list[pa.Array] = []
        self.n = 0

    def add(self, keys: np.ndarray, texts: pa.Array) -> None:
        words, sizes = words_of(texts)
        self.keys.append(keys)
        self.sizes.append(sizes)
        self.words.append(words)
        self.n += len(words)

    def row(self, lang: str, most: int) -> pa.RecordBatch:
        """Each text's different words, how often it has them, how many texts hold each word, and as cut half the count of the `most`-th most common."""
        coded = pa.chunked_array(self.words, pa.string()).combine_chunks().dictionary_encode()
        sizes, n = np.concatenate(self.sizes), max(1, len(coded.dictionary))
        at = np.repeat(np.arange(len(sizes)), sizes) * n + coded.indices.to_numpy()
        end = np.cumsum(sizes)
        cuts = np.unique([0, *end[np.searchsorted(end, np.arange(RUN, len(at), RUN))], len(at)])  # a text's words stay together
        for i, j in zip(cuts, cuts[1:], strict=False):
            at[i:j].sort()
        first = np.flatnonzero(np.diff(at, prepend=-1))
        doc, ids = np.divmod(at[first], n)
        held = pack(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), "\n")[0].as_buffer().to_pybytes())
        docs = np.bincount(ids, minlength=len(coded.dictionary))
        cut = int(np.partition(docs, -most)[-most]) // 2 if len(docs) >= most else 0
        values = [lang, held, np.concatenate(self.keys).tobytes(), np.bincount(doc, minlength=len(sizes)).astype(np.int32).tobytes(), planes(np.diff(ids, prepend=0)), planes(np.diff(first, append=len(at))), planes(docs), cut]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=UNITS.replace(",", "").split()[::2])


def units(texts: Batches, most: int = Topics.words) -> Batches:
    begun: dict[str, Unit] = {}
    for b in texts:
        keys, langs, column = b.column(0).to_numpy(), b.column(1).dictionary_encode(), b.column(2)
        codes = langs.indices.to_numpy()
        for i, name in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(codes == i)
            begun.setdefault(name, Unit()).add(keys[at], column.take(pa.array(at)))
            if begun[name].n >= UNIT:
                yield begun.pop(name).row(name, most)
        if sum(u.n for u in begun.values()) >= 2 * UNIT:  # many languages
            largest = max(begun, key=lambda g: begun[g].n)
            yield begun.pop(largest).row(largest, most)
    for name, u in begun.items():
        yield u.row(name, most)
    give_back()


def dictionary(data: bytes) -> pa.Array:
    """A unit's words."""
    words = unpack(data)
    return pc.split_pattern(pa.array([words], pa.binary()), "\n").flatten() if words else pa.array([], pa.binary())


def read(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, words, keys, sizes, ids, counts) of each unit."""
    for lang, words, *more in arrays(b):
        yield lang, words.to_pylist(), *more


def arrays(b: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The same, with the words as an array."""
    for r in b.select(["lang", "words", "keys", "sizes", "ids", "counts"]).to_pylist():
        ids = np.cumsum(numbers(r["ids"]), dtype=np.uint32).astype(np.int64)
        yield r["lang"], dictionary(r["words"]), np.frombuffer(r["keys"], np.int64), np.frombuffer(r["sizes"], np.int32), ids, numbers(r["counts"])


def counted(b: pa.RecordBatch, docs: dict[str, int]) -> Iterator[tuple[str, pa.Array, np.ndarray, int]]:
    """(language, words, texts that hold each, cut) of each unit."""
    for lang, words, held, cut in zip(*(b.column(c) for c in ("lang", "words", "docs", "cut")), strict=True):
        if lang.as_py() in docs:
            yield lang.as_py(), dictionary(words.as_py()), numbers(held.as_py()).astype(np.int64), cut.as_py()


def frequencies(batches: Batches, docs: dict[str, int], cuts: bool) -> Batches:
    """(lang, word, n, cut) by unit, with cuts only of words that more texts hold."""
    for b in batches:
        for lang, words, n, cut in counted(b, docs):
            if cuts and cut:
                at = np.flatnonzero(n > cut)
                words, n = words.take(pa.array(at)), n[at]
            whole = pa.RecordBatch.from_arrays([pa.repeat(lang, len(words)), words, pa.array(n), pa.repeat(pa.scalar(cut, pa.int64()), len(words))], names=["lang", "word", "n", "cut"])
            for at in range(0, len(words), 50_000):
                yield whole.slice(at, 50_000)
    give_back()


def exact(batches: Batches, words: dict[str, pa.Array]) -> Batches:
    """(lang, part, 0, texts that hold each word of the part) of this task."""
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, held, n, _ in counted(b, words):
            place = pc.index_in(held, value_set=words[lang]).fill_null(-1).to_numpy()
            sums.setdefault(lang, np.zeros(len(words[lang]), np.int64))[place[place >= 0]] += n[place >= 0]  # a unit has a word once
    yield from _rows((g, k, 0, s[at : at + COUNTS].tobytes()) for g, s in sums.items() for k, at in enumerate(range(0, len(s), COUNTS)))
    give_back()


def likely(texts: DataFrame, docs: dict[str, int], p: Topics) -> dict[str, list[tuple[bytes, int]]]:
    """The same as `vocabulary` for those languages whose most common words the bounds tell from nearly all others."""
    sc = texts.sparkSession.sparkContext
    cuts = {r.lang: r.cut for r in texts.groupBy("lang").agg(F.sum("cut").alias("cut")).collect() if r.lang in docs}
    of = lambda x: F.try_element_at(F.create_map(*[F.lit(v) for g in sorted(x) for v in (g, x[g])]), F.col("lang"))
    one = texts.mapInArrow(lambda b: frequencies(b, docs, True), "lang string, word binary, n long, cut long").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("cut").alias("cut"))
    one = reliable(one.select("lang", "word", "n", (F.col("n") + of(cuts) - F.col("cut")).alias("most")).where(2 * F.col("n") <= of(docs)))
    least: dict[str, int] = {}  # no fewer texts hold the last word of a language's vocabulary
    seen: Counter = Counter()
    for g, n, k in one.where(2 * F.col("most") <= of(docs)).groupBy("lang", "n").count().orderBy("lang", F.desc("n")).toArrow().select(["lang", "n", "count"]).to_pandas().itertuples(index=False):
        seen[g] += k
        if seen[g] >= p.words:
            least.setdefault(g, n)
    told = {g: least.get(g, 1) for g in docs if cuts[g] < least.get(g, 1)}  # no word that all units keep back is in so many texts
    if not told:
        return {}
    some = one.where(F.col("most") >= of(told)).select("lang", "word")
    few = {r.lang: r["count"] for r in some.groupBy("lang").count().collect() if r["count"] <= LIKELY * p.words}
    words: dict[str, list[bytes]] = {g: [] for g in few}
    for r in some.where(F.col("lang").isin(list(few))).orderBy("lang", "word").toArrow().to_pylist():
        words[r["lang"]].append(r["word"])
    shared = sc.broadcast({g: pa.array(w, pa.binary()) for g, w in words.items()})
    part = texts.mapInArrow(lambda b: exact(b, shared.value), SUMS)
    sums = {g: np.zeros(len(w), np.int64) for g, w in words.items()}
    for r in part.repartition("lang", "cluster").mapInArrow(added, SUMS).toArrow().to_pylist():
        n = np.frombuffer(r["sums"], np.int64)
        sums[r["lang"]][r["cluster"] * COUNTS :][: len(n)] = n
    shared.destroy()
    return {g: heapq.nsmallest(p.words, ((w, n) for w, n in zip(words[g], sums[g].tolist(), strict=True) if 2 * n <= docs[g]), key=lambda x: (-x[1], x[0])) for g in words}


def most_common(batches: Batches, docs: dict[str, int], words: int) -> Batches:
    """Of the whole table's frequencies in this task, all that can be among a language's `words` first."""
    kept: dict[str, list[tuple[int, bytes]]] = {g: [] for g in docs}
    for b in batches:
        n = b.column(2).to_numpy()
        langs = b.column(0).dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for i, g in enumerate(names):
            floor = -kept[g][-1][0] if len(kept[g]) >= words else 1
            at = np.flatnonzero((codes == i) & (n >= floor) & (2 * n <= docs[g]))
            if len(at):
                kept[g] = heapq.nsmallest(words, [*kept[g], *zip((-n[at]).tolist(), b.column(1).take(pa.array(at)).to_pylist(), strict=True)])
    for g, rows in kept.items():
        if rows:
            yield pa.RecordBatch.from_arrays([pa.repeat(g, len(rows)), pa.array([w for _, w in rows], pa.binary()), pa.array([-k for k, _ in rows], pa.int64())], names=["lang", "word", "n"])
    give_back()


def vocabulary(texts: DataFrame, docs: dict[str, int], p: Topics) -> dict[str, list[tuple[bytes, int]]]:
    """The words of each language with the texts that hold them, most common first, ties by word."""
    told = likely(texts, docs, p)
    found = {g: words for g, words in told.items() if words}
    docs = {g: n for g, n in docs.items() if g not in told}
    if not docs:
        return found
    one = texts.mapInArrow(lambda b: frequencies(b, docs, False), "lang string, word binary, n long, cut long").repartition("lang", "word").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    some = reliable(one.mapInArrow(lambda b: most_common(b, docs, p.words), "lang string, word binary, n long"))
    last: dict[str, int] = {}  # the frequency of a language's last word
    seen: Counter = Counter()
    for g, n, k in some.groupBy("lang", "n").count().orderBy("lang", F.desc("n")).toArrow().select(["lang", "n", "count"]).to_pandas().itertuples(index=False):
        if seen[g] < p.words:
            last[g] = n
            seen[g] += k
    if not last:
        return found
    floor = F.broadcast(texts.sparkSession.createDataFrame(sorted(last.items()), "lang string, last long"))
    first = some.join(floor, "lang").where("n >= last").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= p.words)
    for r in first.select("lang", "word", "n").orderBy("lang", "rank").toArrow().to_pylist():
        found.setdefault(r["lang"], []).append((r["word"], r["n"]))
    return found


def vectors(batches: Batches, places: dict[str, tuple[dict[bytes, int], np.ndarray]]) -> Batches:
    """Unit vectors of the texts that hold words of the vocabulary, one after another: keys, sizes, places and entries."""
    for b in batches:
        for lang, words, keys, sizes, ids, counts in arrays(b):
            if lang not in places:
                continue
            place, rare = places[lang]
            at = pc.index_in(words, value_set=pa.array(list(place), pa.binary())).fill_null(-1).to_numpy().astype(np.int64)[ids]
            known = at >= 0
            at = np.repeat(np.arange(len(sizes)), sizes)[known] * len(rare) + at[known]
            order = np.argsort(at)  # a text's sum of squares doesn't depend on its unit's dictionary
            doc, at = np.divmod(at[order], len(rare))
            x = counts[known][order] * rare[at]
            x = np.rint(x / np.sqrt(np.bincount(doc, x * x, len(sizes)))[doc] * ONE).astype(np.int32)
            size = np.bincount(doc, minlength=len(sizes)).astype(np.int32)
            keys, size = keys[size > 0], size[size > 0]
            end = np.cumsum(size)
            cuts = np.unique(np.searchsorted(end, [*range(ROW, len(at), ROW), len(at)], "left") + 1) if len(at) else []
            for i, j in zip([0, *cuts], cuts, strict=False):
                of = slice(end[i] - size[i], end[j - 1])
                values = [lang, keys[i:j].tobytes(), size[i:j].tobytes(), at[of].astype(_kind(len(rare))).tobytes(), x[of].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["lang", "keys", "sizes", "places", "entries"])
    give_back()


def _kind(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.uint32


def nearness(batches: Batches, centres: dict[str, np.ndarray]) -> Iterator[tuple]:
    """(language, keys, sizes, places, entries, products with each centre) of each row of vectors. Arrays but keys and sizes are used again for the next row."""
    room = 0
    for b in batches:
        for r in b.to_pylist():
            c = centres[r["lang"]]
            keys, sizes, at = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["places"], _kind(c.shape[1]))
            if len(at) > room:
                room = 2 * len(at)
                buffers = np.empty(room, np.intp), np.empty(room), np.empty(room)
            places, entries, product = (x[: len(at)] for x in buffers)
            places[:], entries[:] = at, np.frombuffer(r["entries"], np.int32)
            start, near = np.cumsum(sizes) - sizes, np.empty((len(c), len(keys)))
            for k, out in zip(c, near, strict=True):
                np.take(k, places, out=product, mode="clip")
                np.add.reduceat(np.multiply(product, entries, out=product), start, out=out)
            yield r["lang"], keys, sizes, places, entries, near


def race(batches: Batches, centres: dict[str, np.ndarray], chosen: int, seed: int) -> Batches:
    """For each candidate (the centres after those chosen), were it chosen: the distance that this task's texts have left, and its texts that come first in DRAWS races for the
    next centre. Times are drawn from a text's key, and short ones are likelier far from all centres."""
    left: dict[tuple[str, int, int], int] = {}
    best: dict[tuple[str, int, int], tuple] = {}
    for lang, keys, sizes, places, entries, near in nearness(batches, centres):
        end, waits = np.cumsum(sizes), []
        for draw in range(DRAWS):
            h = keys.astype(np.uint64) + np.uint64((seed * 64 + draw + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
            waits.append(-np.log((((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)))
        for pick, candidate in enumerate(near[chosen:]):
            far = np.maximum(0, ONE * ONE - np.maximum(near[:chosen].max(axis=0, initial=0), candidate))
            rest = int((far // ONE).astype(np.int64).sum())
            for draw, wait in enumerate(waits):
                time = np.divide(wait, far, out=np.full(len(far), np.inf), where=far > 0)
                first = np.flatnonzero(time == time.min())
                i = int(first[keys[first].argmin()])
                at, mine = (lang, pick, draw), (float(time[i]), int(keys[i]))
                left[at] = left.get(at, 0) + rest
                if at not in best or mine < best[at][:2]:
                    of = slice(int(end[i] - sizes[i]), int(end[i]))
                    best[at] = *mine, places[of].astype(np.int64).tobytes(), entries[of].tobytes()
    if best:
        columns = zip(*((*at, left[at], *best[at]) for at in best), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=RACE.replace(",", "").split()[::2])


def own_sums(batches: Batches, centres: dict[str, np.ndarray]) -> Batches:
    """(lang, cluster, texts, sums by word) of the texts nearest to each centre."""
    sums: dict[str, np.ndarray] = {}
    texts: dict[str, np.ndarray] = {}
    for lang, _, sizes, places, entries, near in nearness(batches, centres):
        count, words = centres[lang].shape
        own = near.argmax(axis=0)
        places += np.repeat(own * words, sizes)
        new = np.bincount(places, entries, count * words).astype(np.int64).reshape(count, words)
        sums[lang] = sums.get(lang, 0) + new
        texts[lang] = texts.get(lang, 0) + np.bincount(own, minlength=count)
    yield from _rows((g, k, int(texts[g][k]), sums[g][k].tobytes()) for g in sums for k in range(len(texts[g])) if texts[g][k])


def added(batches: Batches) -> Batches:
    sums: dict[tuple[str, int], list] = {}
    for b in batches:
        for r in b.to_pylist():
            has = sums.setdefault((r["lang"], r["cluster"]), [0, 0])
            has[0] += r["texts"]
            has[1] = has[1] + np.frombuffer(r["sums"], np.int64)
    yield from _rows((*k, n, s.tobytes()) for k, (n, s) in sums.items())


def _rows(rows: Iterator[tuple]) -> Batches:
    for lang, cluster, n, s in rows:
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([cluster], pa.int32()), pa.array([n], pa.int64()), pa.array([s], pa.binary())], names=["lang", "cluster", "texts", "sums"])


def clusters(x: DataFrame, words: dict[str, int], p: Topics) -> dict[str, np.ndarray]:
    """Centres, a row each, by language, the largest cluster first."""
    sc = x.sparkSession.sparkContext

    def over(f: Callable, shape: str, centres: dict[str, np.ndarray], *more: int) -> tuple[DataFrame, Callable]:
        shared = sc.broadcast(centres)
        return x.mapInArrow(lambda b: f(b, shared.value, *more), shape), shared.destroy

    def nearest(centres: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """Texts of each cluster and their sums."""
        part, done = over(own_sums, SUMS, centres)
        texts, sums = {g: np.zeros(len(c), np.int64) for g, c in centres.items()}, {g: np.zeros(c.shape, np.int64) for g, c in centres.items()}
        for r in part.repartition("lang", "cluster").mapInArrow(added, SUMS).toArrow().to_pylist():
            texts[r["lang"]][r["cluster"]], sums[r["lang"]][r["cluster"]] = r["texts"], np.frombuffer(r["sums"], np.int64)
        done()
        return texts, sums

    centres = {g: np.zeros((1, n)) for g, n in words.items()}  # at first one candidate that is near to nothing
    for step in range(p.count + 1):
        chosen = max(0, step - 1)
        part, done = over(race, RACE, centres, chosen, p.seed * 64 + step)
        rows = part.groupBy("lang", "pick", "draw").agg(F.sum("left").alias("left"), F.min_by(F.struct("places", "entries"), F.struct("time", "key")).alias("of")).select("lang", "pick", "draw", "left", "of.*").toArrow().to_pylist()
        done()
        for g, c in centres.items():
            mine = sorted((r for r in rows if r["lang"] == g), key=lambda r: (r["left"], r["pick"], r["draw"]))[:DRAWS]  # the races after the pick that leaves least
            new = np.zeros((DRAWS, words[g]))
            for r, row in zip(mine, new, strict=True):
                row[np.frombuffer(r["places"], np.int64)] = np.frombuffer(r["entries"])
            centres[g] = np.concatenate([c[:chosen], c[[chosen + mine[0]["pick"]]], new]) if step else new
    centres = {g: c[: p.count] for g, c in centres.items()}
    for _ in range(p.rounds):
        texts, sums = nearest(centres)
        before, centres = centres, {}
        for g, s in sums.items():
            size = np.sqrt((s.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
            centres[g] = np.where(size > 0, np.rint(s / np.maximum(size, 1) * ONE), before[g])
        if all((centres[g] == before[g]).all() for g in centres):
            break
    else:
        texts, _ = nearest(centres)
    return {g: c[np.argsort(-texts[g], kind="stable")] / ONE for g, c in centres.items()}


def fit(df: DataFrame, text: Column, lang: Column, p: Topics = Topics()) -> Model:
    """Vocabularies and clusters from all different texts."""
    small_batches(df.sparkSession)
    texts = reliable(different(df, text, lang, p).mapInArrow(lambda b: units(b, p.words), UNITS))
    n = F.sum(F.octet_length("keys") / 8).cast("long")
    size = F.sum(F.octet_length("ids"))
    rows = texts.groupBy("lang").agg(n.alias("docs"), size.alias("size")).where(F.col("docs") >= p.fewest * p.count).orderBy(F.desc("docs"), "lang").limit(p.languages).collect()
    docs = {r.lang: r.docs for r in rows}
    held = vocabulary(texts, docs, p) if docs else {}
    if not held:
        return {}
    places = {g: ({w: i for i, (w, _) in enumerate(rows)}, np.log(docs[g] / np.array([k for _, k in rows], float))) for g, rows in held.items()}
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast(places)
    parts = max(2 * sc.defaultParallelism, sum(r.size for r in rows) // PART)  # vectors are passed over often, so by few tasks
    x = reliable(texts.mapInArrow(lambda b: vectors(b, shared.value), "lang string, keys binary, sizes binary, places binary, entries binary").coalesce(parts))
    enough = [r.lang for r in x.groupBy("lang").agg(n.alias("docs")).where(F.col("docs") >= p.count).collect()]
    found = clusters(x.where(F.col("lang").isin(enough)), {g: len(places[g][1]) for g in enough}, p) if enough else {}
    return {g: (places[g][0], (c * places[g][1]).T.copy()) for g, c in sorted(found.items())}


KIND = pa.struct([("n_tokens", pa.int64()), ("topic", pa.string())])


def classify(model: Model) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """From texts and languages, none null, to structs of words and topic."""
    known = {g: (pa.array([w.decode() for w in sorted(place, key=place.get)], pa.string()), np.ascontiguousarray(weight.T)) for g, (place, weight) in model.items()}
    names = np.array([*(f"t{k}" for k in range(max((len(w) for _, w in known.values()), default=1))), "none"], object)

    def run(texts: pa.Array, langs: pa.Array) -> pa.Array:
        coded = langs.dictionary_encode()
        codes, n, topic = coded.indices.to_numpy(), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for i, lang in enumerate(coded.dictionary.to_pylist()):
            at = np.flatnonzero(codes == i)
            words, n[at] = words_of(texts.take(pa.array(at)))
            if lang in known:
                held, weight = known[lang]
                place = pc.index_in(words, value_set=held).fill_null(-1).to_numpy()
                doc = np.repeat(np.arange(len(at)), n[at])[place >= 0]
                place = place[place >= 0]
                best = np.stack([np.bincount(doc, w.take(place), len(at)) for w in weight]).argmax(axis=0)
                topic[at] = np.where(np.bincount(doc, minlength=len(at)) > 0, best, -1)
        return pa.StructArray.from_arrays([pa.array(n), pa.array(names[np.where(n > 0, topic, -1)], pa.string())], fields=list(KIND))

    return run


def topic_of(df: DataFrame, model: Model, text: Column, lang: Column) -> Column:
    """struct<n_tokens: bigint, topic: string>"""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # words x clusters x languages at most, as `Topics` says

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        some = classify(shared.value)
        for texts, langs in batches:
            parts, at = [], 0
            for part in runs_of(texts):
                parts.append(some(part.fill_null(""), langs.slice(at, len(part))))
                at += len(part)
            yield pa.concat_arrays(parts) if parts else pa.array([], KIND)
        give_back()

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<n_tokens: bigint, topic: string>")(text, F.coalesce(lang.cast("string"), F.lit("")))
