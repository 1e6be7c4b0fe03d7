"""Runs: stretches of words that repeat with a period, found while words are appended.

A square of period q holds, in its first half, a completed block of 2^k words that begins at a multiple of
2^k, if q is at least 2^(k+1) - 1; the block's copy begins q words later. So each completed block is a
catcher for the periods of its level, and each appended word completes one window of each level, which is
compared with the few catchers that lie at the right distance behind it: some two comparisons a level.
Where one agrees, the two suffixes are followed to the left and to the right as far as they stay equal. What
reaches the last word stays pending and is taken on by the next words. Stretches that agree in everything but
the period are one run, with the smallest one; so squares merge into runs.

Windows are compared by hashes of 64 bits that double in length with the level, all words of a call at once
in numpy. A run is compared word by word at its end, and a chance collision there would be an error.
Documents of a tile follow each other with a word of its own between them, which equals no other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import named

LEAST = 12
# Words that are taken together; a longer document is taken alone. A word takes 8 bytes for each level.
TILE_WORDS = 100_000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Catchers:
    """Finds the runs of a sequence of numbers that is appended in pieces of any size.

    A run has a smallest period q and at least ``max(least, 2 * q)`` places, and cannot be made longer.
    """

    def __init__(self, least: int = LEAST) -> None:
        self.least = least
        self.words = np.zeros(0, np.uint64)
        self.levels: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.pending = np.zeros((3, 0), np.int64)
        self.found: list[np.ndarray] = []

    def _periods(self, level: int) -> tuple[int, int]:
        """The periods, from and to, whose squares must hold a block of this level, and of no higher one."""
        # The first half of a run of period q has max(least, 2q) - q places or more.
        size = 1 << level
        low, high = 2 * size - 1, 4 * size - 2
        short = max(self.least, 2)  # periods below half of it have longer first halves
        inside = [q for q in range(1, short) if 2 * size - 1 <= max(self.least, 2 * q) - q < 4 * size - 1]
        if low >= short:
            return low, high
        outer = [q for q in range(short, high + 1) if q >= low]
        every = inside + outer
        return (min(every), max(every)) if every else (1, 0)

    def _right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many places from ``i`` on equal those from ``j`` (> i) on."""
        n, done = len(self.words), np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            hashes, live = self.levels[level], np.arange(len(i))
            while len(live):
                at = j[live] + done[live]
                live = live[at + (1 << level) <= n]
                a, b = i[live] + done[live], j[live] + done[live]
                live = live[hashes[a] == hashes[b]]
                done[live] += 1 << level
                if level < len(self.levels) - 1:
                    break
        return done

    def _left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many places before ``i`` equal those before ``j``."""
        done = np.zeros(len(i), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            hashes, live = self.levels[level], np.arange(len(i))
            while len(live):
                live = live[i[live] - done[live] >= 1 << level]
                a, b = i[live] - done[live] - (1 << level), j[live] - done[live] - (1 << level)
                live = live[hashes[a] == hashes[b]]
                done[live] += 1 << level
                if level < len(self.levels) - 1:
                    break
        return done

    def append(self, words: np.ndarray, longest: int | None = None) -> None:
        """Takes in words; ``longest`` bounds the length of a run, if it is known, which saves levels."""
        n0 = len(self.words)
        self.words = self.levels[0] = np.concatenate([self.words, words.astype(np.uint64)])
        n = len(self.words)
        most = min(n, longest or n)
        matches = []
        level = 0
        while True:
            size = 1 << level
            if level == len(self.levels):
                self.levels.append(np.zeros(0, np.uint64))
            known = len(self.levels[level]) if level else n0
            if level and n - size + 1 > known:
                below, half = self.levels[level - 1], size >> 1
                new = _mix(below[known : n - size + 1] * _ODD + below[known + half : n - half + 1])
                self.levels[level] = np.concatenate([self.levels[level], new])
            matches += self._caught(level, max(known, 0), n - size + 1)
            level += 1
            # The next level catches periods from 2^(level+1) - 1 on.
            if 2 * ((2 << level) - 1) > most and 2 << level > self.least:
                break
        i, q = np.array([m for part in matches for m in part[0]], np.int64), np.array([m for part in matches for m in part[1]], np.int64)
        self._merge(i, q, n0, n)

    def _caught(self, level: int, first: int, end: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Blocks and distances at which the windows that begin at ``first`` to ``end`` - 1 equal a block."""
        low, high = self._periods(level)
        if low > high or end <= first:
            return []
        out, hashes, size = [], self.levels[level], 1 << level
        begin = np.arange(first, end)
        block = (begin - low) >> level << level
        for _ in range((high - low) // size + 1):
            ok = np.flatnonzero((block >= 0) & (begin - block <= high))
            ok = ok[hashes[block[ok]] == hashes[begin[ok]]]
            if len(ok):
                out.append((block[ok], begin[ok] - block[ok]))
            block = block - size
        if not out:
            return []
        at, q = np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
        order = np.lexsort((at, q))
        at, q = at[order], q[order]
        # Neighbouring blocks that agree at one distance are one stretch: the first of them stands for all.
        fresh = np.ones(len(at), bool)
        fresh[1:] = (q[1:] != q[:-1]) | (at[1:] != at[:-1] + size)
        return [(at[fresh], q[fresh])]

    def _merge(self, i: np.ndarray, q: np.ndarray, n0: int, n: int) -> None:
        old = self.pending
        if old.shape[1]:
            grown = old[1] + self._right(old[1] - old[2], old[1])
            old = np.stack([old[0], grown, old[2]])
        if len(i):
            left, right = self._left(i, i + q), self._right(i, i + q)
            old = np.concatenate([old, np.stack([i - left, i + q + right, q])], axis=1)
        old = np.unique(old, axis=1) if old.shape[1] else old
        still = old[1] == n
        ended = old[:, ~still]
        self.pending = old[:, still]
        if ended.shape[1]:
            self.found.append(ended[:, ended[1] - ended[0] >= np.maximum(self.least, 2 * ended[2])])

    def runs(self) -> np.ndarray:
        """Rows of start, end and period of all runs of the words so far, in order of start, then period."""
        last = self.pending
        last = last[:, last[1] - last[0] >= np.maximum(self.least, 2 * last[2])]
        every = np.concatenate([*self.found, last], axis=1)
        every = every[:, np.lexsort((every[2], every[1], every[0]))]
        smallest = np.ones(every.shape[1], bool)
        smallest[1:] = (every[0, 1:] != every[0, :-1]) | (every[1, 1:] != every[1, :-1])
        out = every[:, smallest].T
        for a, b, q in out:
            if not np.array_equal(self.words[a : b - q], self.words[a + q : b]):
                raise ArithmeticError("two different windows have one hash")
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of(words: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """For each list of words its runs: rows of start, length and period."""
    numbers: dict[bytes, int] = {}
    flat = np.empty(sum(len(w) + 1 for w in words), np.uint64)
    edges, at, longest = [], 0, 0
    for k, own in enumerate(words):
        edges.append(at)
        # Words get even numbers, and the word that closes a document an odd one.
        flat[at : at + len(own)] = [2 * numbers.setdefault(w, len(numbers)) for w in own]
        flat[at + len(own)] = 2 * k + 1
        at += len(own) + 1
        longest = max(longest, len(own))
    catchers = Catchers(least)
    catchers.append(_mix(flat * _ODD), longest)
    found = catchers.runs()
    of = np.searchsorted(edges, found[:, 0], "right") - 1
    start = found[:, 0] - np.array(edges, np.int64)[of]
    rows = np.stack([start, found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    cuts = np.searchsorted(of, np.arange(len(words) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by blanks, without what any run holds beyond its first period."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return b" ".join([words[k] for k in kept])


def _tiles(texts: pa.Array):
    tile, size = [], 0
    for text in texts:
        # bytes.split without arguments cuts at blanks and at the five controls from tab to carriage return.
        words = (text.as_py() or "").encode().split()
        tile.append(words)
        size += len(words)
        if size >= TILE_WORDS:
            yield tile
            tile, size = [], 0
    if tile:
        yield tile


def _find(least: int, key: pa.Field):
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([key, ("n_words", pa.int64()), ("runs", pa.list_(item)), ("collapsed", pa.string())])

    def run(batches):
        for batch in batches:
            row = 0
            for tile in _tiles(batch.column(1)):
                found = runs_of(tile, least)
                sizes = [len(r) for r in found]
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(item)),
                )
                texts = pa.array([collapsed(w, r).decode() for w, r in zip(tile, found, strict=True)], pa.string())
                words = pa.array([len(w) for w in tile], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(tile)), words, lists, texts], schema=schema)
                row += len(tile)

    return run


def periodic_runs(df: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """One row for each row of ``df``: key, n_words, runs (start, length and period in words) and the collapsed text.

    Runs are ordered by start, then period. In the collapsed text only the first period of a run stays, and words are
    joined by one blank. Null texts count as empty: no words, no runs, an empty text. Repeated rows stay repeated, other
    columns are left out. Nothing is shuffled. Texts go by tiles of ``TILE_WORDS`` words; a longer text takes some 8 bytes
    for each word and each power of two below its length.
    """
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType
    field = pa.field("key", to_arrow_type(kind))
    schema = f"key {kind.simpleString()}, n_words bigint, runs {RUNS}, collapsed string"
    return slim.mapInArrow(_find(least, field), schema)
