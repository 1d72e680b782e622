"""Line dedup by winnowing (Schleimer, Wilkerson and Aiken, 2003) over hashes of lines.

Only lines that hold a word count; words are what lies between ASCII white space. A run of lines that has RUN words or more and also stands
earlier (in a document before, by id and then by hash of the text, or higher up in its own) is deleted, blank lines between its lines too. The
first of equal lines always stays, as a line goes only if an equal one comes earlier.

1. A gram is the least run of lines from a line on that has GRAM words; its fingerprint is the hash of its lines. A window is the least run of
   lines, from a line on or back from one, that has RUN words. Of the grams in a window from a line on, the last of least hash is selected, whatever lies
   around it; so two places of one window have the same selected fingerprint.
2. Places are joined on fingerprints: only where one occurs twice can a window repeat.
3. There, the windows that hold the gram are looked up by their own hashes. A window that isn't the first of its hash is a later repeat. A repeated run is
   covered by its windows, those from its lines on and those back from them, so their union is the match extended both ways as far as it goes,
   whichever earlier documents its parts stand in.

A fingerprint or a window that a third of all documents hold meets in sums (how often, its first place) and in joins whose other side has
one row a hash; no pairs of documents arise.

Null text: empty, no lines deleted. Rows of equal id and text are one document and get one result. Null id: after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import give_back, reliable, small_batches

_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Winnow:
    run: int = 50
    gram: int = 25


def worded(text: str) -> tuple[list[str], list[int], list[int]]:
    """(all lines, the places of those with words, how many words each of these has)."""
    lines = text.split("\n")
    counts = [len(x.encode().split()) for x in lines]
    at = [i for i, n in enumerate(counts) if n]
    return lines, at, [counts[i] for i in at]


def least_runs(words: list[int], most: int) -> list[int]:
    """For each line the end of the least run of lines from it on that has `most` words; 0 if too few words follow."""
    out, end, total = [], 0, 0
    for n in words:
        while end < len(words) and total < most:
            total += words[end]
            end += 1
        out.append(end if total >= most else 0)
        total -= n
    return out


def windows(digests: list[bytes], words: list[int], p: Winnow) -> dict[int, tuple[int, list[tuple[int, int]]]]:
    """By selected gram's first line: (its fingerprint, the windows that are looked up through it, as (first line, end))."""
    import xxhash

    n = len(words)
    ends, on = least_runs(words, p.gram), least_runs(words, p.run)
    back = [n - e for e in least_runs(words[::-1], p.run)[::-1]]  # first line of the window back from each line; n: none
    prints = [xxhash.xxh3_64_intdigest(b"".join(digests[i:e])) if e else 0 for i, e in enumerate(ends)]
    chosen: list[int] = []
    held: list[int] = []  # starts of grams that may be selected yet, their prints growing: a sliding minimum
    at = 0
    for i in range(n):
        if not on[i]:
            break
        while at < n and ends[at] and ends[at] <= on[i]:
            while held and prints[held[-1]] >= prints[at]:
                held.pop()
            held.append(at)
            at += 1
        while held[0] < i:
            held.pop(0)
        chosen.append(held[0])
    out: dict[int, tuple[int, list[tuple[int, int]]]] = {}
    for i, g in enumerate(chosen):
        out.setdefault(g, (prints[g], []))[1].append((i, on[i]))
    for j, i in enumerate(back):
        if i < n and on[i] != j + 1:
            out[chosen[i]][1].append((i, j + 1))
    return out


WINDOW = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])
PLACE = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("gram", pa.int64()), ("windows", pa.list_(WINDOW))])


def places(df: DataFrame, p: Winnow) -> DataFrame:
    """df: doc_id, text_hash, text. A row for each selected gram, with its windows and their hashes of 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), PLACE, strict=True)], schema=PLACE)
        for b in batches:
            rows: list[tuple] = []
            for id, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                lines, at, words = worded(text.as_py() or "")
                if sum(words) < p.run:
                    continue
                digests = [xxhash.xxh3_128_digest(lines[i].encode()) for i in at]
                for g, found in windows(digests, words, p).values():
                    own = []
                    for first, end in found:
                        h = xxhash.xxh3_128_intdigest(b"".join(digests[first:end]))
                        own.append((signed(h >> 64), signed(h & _MASK), first, end))
                    rows.append((id, key, signed(g), [dict(zip(("h1", "h2", "first", "end"), w, strict=True)) for w in own]))
                    if len(rows) == 4096:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)
        give_back()

    return df.mapInArrow(run, "doc_id long, text_hash long, gram long, windows array<struct<h1: long, h2: long, first: int, end: int>>")


def runs(df: DataFrame, p: Winnow = Winnow()) -> DataFrame:
    """df: doc_id, text_hash, text. (doc_id, text_hash, runs array<struct<first, end>>): the later repeats, by worded line; they overlap.

    The small side of each join is written first: both sides are then plain exchanges, and a hash that a third of all rows have can be split."""
    found = reliable(places(df, p))
    shared = reliable(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("g")))
    near = found.join(shared, F.col("gram") == F.col("g"), "left_semi").select("doc_id", "text_hash", F.explode("windows").alias("w")).select("doc_id", "text_hash", "w.*")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "first")
    first = near.groupBy("h1", "h2").agg(F.min(order).alias("at"), F.count("*").alias("n")).where("n > 1").select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), "at")
    later = near.join(reliable(first), (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2"))).where(order != F.col("at"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "end")).alias("runs"))


CUT = pa.struct([("text", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), ("n_removed", pa.int32())])


def cut(text: str, spans: list[dict]) -> dict:
    """The text without the runs of worded lines, and the runs by line, merged."""
    lines, at, _ = worded(text)
    gone: list[list[int]] = []
    for first, end in sorted((at[s["first"]], at[s["end"] - 1] + 1) for s in spans):
        if gone and first <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], end)
        else:
            gone.append([first, end])
    kept, last = [], 0
    for first, end in gone:
        kept += lines[last:first]
        last = end
    kept += lines[last:]
    return {"text": "\n".join(kept), "removed": [{"first": a, "end": b} for a, b in gone], "n_removed": sum(b - a for a, b in gone)}


def dedup(df: DataFrame, p: Winnow = Winnow(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows in a struct `row`, with n_lines, n_removed, `removed` array<struct<first, end>> (lines from 0) and `kept_text`."""
    small_batches(df.sparkSession)
    plain = F.coalesce(F.col(text), F.lit(""))
    keyed = df.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(plain).alias("text_hash"), plain.alias("text"))
    found = runs(keyed, p).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "runs")

    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([None if s is None else cut(t, s) for t, s in zip((x.as_py() for x in texts), spans.to_pylist(), strict=True)], type=CUT)

    apply.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    of = F.arrow_udf(apply, "struct<text: string, removed: array<struct<first: int, end: int>>, n_removed: int>")
    row = F.col(f"row.`{text}`")
    rows = df.select(F.struct("*").alias("row"), F.col(id).cast("long").alias("d0"), F.xxhash64(plain).alias("h0"))
    joined = rows.join(found, F.col("d0").eqNullSafe(F.col("d")) & (F.col("h0") == F.col("h")), "left")
    done = joined.select("row", of(F.when(F.col("runs").isNotNull(), F.coalesce(row, F.lit(""))), F.col("runs")).alias("cut"))
    lines = F.length(F.coalesce(row, F.lit(""))) - F.length(F.replace(F.coalesce(row, F.lit("")), F.lit("\n"), F.lit(""))) + 1
    return done.select("row", lines.cast("long").alias("n_lines"), F.coalesce("cut.n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("cut.removed", F.array().cast("array<struct<first:int,end:int>>")).alias("removed"), F.coalesce(F.col("cut.text"), row).alias("kept_text"))
