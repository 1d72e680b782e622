"""Byte-level BPE encoding and decoding on padded matrices.

The texts of a run are split into pieces by the vocabulary's pattern, and each distinct piece is encoded once. Pieces
are put into buckets by length; a bucket is a matrix of token ids, one piece a row. In each round every row merges its
leftmost pair of least rank: ranks of pairs come from a hash table held in two arrays, and the row is then compacted by
one place, so a bucket narrows by a column a round. Rows without a pair left leave the matrix.

A pair may merge if the bytes of both tokens together are a token, whatever parts the vocabulary's author joined; a piece that
is itself a token is not split. So ids equal those of the tiktoken library. A row of over LONG bytes has as many rounds as
bytes, so beyond that length the same order of merges is taken from a heap, piece by piece.

Null text: empty, no ids. Empty text: no ids. Repeated rows: each has its ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import put, small_batches, text_udf

NONE = np.int64(1) << 40
LONG = 1024
CELLS = 250_000
EDGES = (2, 3, 4, 6, 8, 11, 16, 24, 40, 80, 200, 500, LONG)


class PairTable:
    """Open addressing over two arrays: the key of a pair, and the rank of what it merges into."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            slot, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[slot], self.values[slot] = keys[put], values[put]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The ranks; NONE where a key is absent or negative."""
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        more = np.flatnonzero((found != keys) & (found >= 0))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            found = self.keys[at[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[at[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out


class Codec:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.n = max(self.rank.values()) + 1
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        lengths = np.zeros(self.n + 1, np.int64)
        for token, r in self.rank.items():
            lengths[r + 1] = len(token)
        self.start = np.cumsum(lengths)
        flat = bytearray(int(self.start[-1]))
        for token, r in self.rank.items():
            flat[self.start[r] : self.start[r] + len(token)] = token
        self.flat = np.frombuffer(bytes(flat), np.uint8)

    def _joins(self) -> tuple[list[int], list[int]]:
        """All pairs that may merge: first token times n plus second, and the rank of both together."""
        keys, values = [], []
        for token, r in self.rank.items():
            for i in range(1, len(token)):
                a, b = self.rank.get(token[:i]), self.rank.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a * self.n + b)
                    values.append(r)
        return keys, values

    @cached_property
    def pairs(self) -> PairTable:
        return PairTable(*[np.array(x, np.int64) for x in self._joins()])

    @cached_property
    def merge(self) -> dict[int, int]:
        return dict(zip(*self._joins(), strict=True))

    def _matrix(self, rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of one bucket: (their places, their ids), as they are done."""
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        width = int(size.max())
        raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        ids = np.where(np.arange(width) < size[:, None], self.byte[raw], -1)
        place = np.arange(len(rows))

        def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return self.pairs.get(np.where((a >= 0) & (b >= 0), a * self.n + b, -1))

        rank = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(place):
            at = rank.argmin(axis=1)  # the first of the least
            row = np.arange(len(place))
            best = rank[row, at]
            if (done := best == NONE).any():
                yield place[done], ids[done]
                place, ids, rank, at, best = place[~done], ids[~done], rank[~done], at[~done], best[~done]
                row = np.arange(len(place))
                if not len(place):
                    return
            width = ids.shape[1] - 1
            ids[row, at] = best
            keep = np.arange(width) + (np.arange(width) > at[:, None])
            ids = np.take_along_axis(ids, keep, axis=1)
            if width == 1:
                yield place, ids
                return
            keep = np.arange(width - 1) + (np.arange(width - 1) >= at[:, None])
            rank = np.take_along_axis(rank, keep, axis=1)
            left = at > 0
            rank[row[left], at[left] - 1] = ranks(ids[row[left], at[left] - 1], best[left])
            right = at < width - 1
            rank[row[right], at[right]] = ranks(best[right], ids[row[right], at[right] + 1])

    def _heap(self, piece: bytes) -> list[int]:
        ids = [int(self.byte[b]) for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda i: self.merge.get(ids[i] * self.n + ids[after[i]]) if after[i] < n else None
        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [i for i in ids if i >= 0]

    def pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, where each piece starts, and the end)."""
        done: list[np.ndarray | list[int] | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (r := self.rank.get(p)) is not None:
                done[i] = [r]
            elif len(p) > LONG:
                done[i] = self._heap(p)
            else:
                buckets.setdefault(next(b for b, e in enumerate(EDGES) if len(p) <= e), []).append(i)
        for b, members in buckets.items():
            step = max(1, CELLS // EDGES[b])
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for place, ids in self._matrix([pieces[i] for i in part]):
                    size = (ids >= 0).sum(axis=1).tolist()
                    for k, row, n in zip(place.tolist(), ids.tolist(), size, strict=True):
                        done[part[k]] = row[:n]
        start = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, done), np.int64, len(done)), out=start[1:])
        flat = np.fromiter((x for d in done for x in d), np.int64, int(start[-1]))
        return flat, start

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known: dict[str, int] = {}
        codes = [np.fromiter((known.setdefault(p, len(known)) for p in self.pattern.findall(t)), np.int64) for t in texts]
        flat, start = self.pieces([p.encode() for p in known])
        return [gather(flat, start, c).astype(np.int32) for c in codes]

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n):
            raise ValueError("no such token")
        return gather(self.flat, self.start, ids).tobytes()


def gather(flat: np.ndarray, start: np.ndarray, which: np.ndarray) -> np.ndarray:
    """flat's stretches of the given numbers, one after another."""
    if not len(which):
        return flat[:0]
    size = start[which + 1] - start[which]
    end = np.cumsum(size)
    return flat[np.arange(int(end[-1])) + np.repeat(start[which] - (end - size), size)]


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(ranks: bytes, pattern: str) -> Codec:
    key = (hash(ranks), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def read_ranks(path: str) -> bytes:
    """The rank file, read once on the driver; its size doesn't depend on the data."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add the ids of each whole text (null: empty), array<int>."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    work: Callable = lambda: _codec(shared.value, pattern).encode
    return put(df, out, text_udf(work, "array<int>", pa.list_(pa.int32()))(F.col(text)))


def decode(df: DataFrame, ranks: bytes, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for (null: none); an id outside the vocabulary is an error."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared.value, pattern)
        for a in arrays:
            flat, start = a.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            yield pa.array([codec.decode(flat[start[i] : start[i + 1]]) for i in range(len(a))], type=pa.binary())

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return put(df, out, F.arrow_udf(run, "binary")(F.col(ids)))


def round_trip(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", out: str = "token_ids", back: str = "decoded") -> DataFrame:
    """encode() and decode() of the ids just made, in one Python worker a task instead of two."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def work() -> Callable:
        codec = _codec(shared.value, pattern)
        return lambda texts: [{"ids": ids, "bytes": codec.decode(ids)} for ids in codec.encode(texts)]

    both = f"{out}__{back}"
    while both in df.columns:
        both += "_"
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("bytes", pa.binary())])
    done = df.withColumn(both, text_udf(work, "struct<ids: array<int>, bytes: binary>", kind)(F.col(text)))
    return done.withColumns({out: F.col(f"`{both}`.ids"), back: F.col(f"`{both}`.bytes")}).drop(both)
