"""Packing of tokenised documents into sequences of a fixed capacity.

Only lengths decide, and there are at most ``capacity`` of them, so the plan is made on their histogram:
pieces above a third of the capacity are matched greedily, at most two to a sequence (largest first, with
the largest that still fits), then the smaller ones, largest first, go into the smallest gap that holds
them. The plan says which places of which length go where; every piece then finds its sequence by its
length and its number among the pieces of that length. The result is that of one global best fit,
whatever the size of the corpus, and no task ever sees more than its own rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, number_rows
from tidemark.llm.memory import released, slices
from tidemark.session import stage


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first number, pieces, first sequence, pieces in a sequence, offset) that place every piece.

    ``counts`` gives the number of pieces of each length from 1 to ``capacity``. In a run, number r of a length
    goes to sequence ``first sequence + (r - first) // k`` at ``offset + (r - first) % k * length``.
    """
    left = {length: n for length, n in counts.items() if n}
    if any(not 1 <= length <= capacity for length in left):
        raise ValueError("a length is outside the capacity")
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # those that occur, ascending
    bins: dict[int, list[list[int]]] = {}  # gap -> [first sequence, how many]
    sequences = 0

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in bins:
                bins[gap] = []
                insort(gaps, gap)
            bins[gap].append([first, n])

    def put(length: int, first: int, n: int, each: int, offset: int) -> None:
        runs.append((length, used[length], n * each, first, each, offset))
        used[length] += n * each
        left[length] -= n * each

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for length in large:
        while left[length]:
            mate = next((x for x in large if x <= capacity - length and left[x] > (x == length)), None)
            n = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            first = sequences
            sequences += n
            put(length, first, n, 1, 0)
            if mate is not None:
                put(mate, first, n, 1, length)
            keep(capacity - length - (mate or 0), first, n)
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                first, n = bins[gap].pop()
                if not bins[gap]:
                    del bins[gap], gaps[k]
            else:
                gap, first, n = capacity, sequences, -(-left[length] // (capacity // length))
                sequences += n
            each = gap // length
            full = min(n, left[length] // each)
            if full:
                put(length, first, full, each, capacity - gap)
                keep(gap - each * length, first, full)
            rest = left[length] if full < n else 0
            if rest:  # fewer than ``each``: they share one further sequence
                put(length, first + full, 1, rest, capacity - gap)
                keep(gap - rest * length, first + full, 1)
            keep(gap, first + full + bool(rest), n - full - bool(rest))
    return runs


def _cut(path: str, end: int | None, capacity: int, with_ids: bool):
    def run(batches):
        from tidemark.llm.pieces import encoder

        for batch in (part for whole in batches for part in slices(whole, [1])):
            keys, row, number, start, size, sums, kept = batch.column(0), [], [], [], [], [], []
            for k, ids in enumerate(encoder(path).encode(batch.column(1).to_pylist())):
                ids = ids.astype("<u4") if end is None else np.append(ids, end).astype("<u4")
                edge = 0
                # Only the first piece may be shorter than the capacity.
                following = len(ids) % capacity or min(len(ids), capacity)
                while edge < len(ids):
                    piece = ids[edge:following]
                    row.append(k)
                    number.append(len(row) and (number[-1] + 1 if edge else 0))
                    start.append(edge)
                    size.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    if with_ids:
                        kept.append(piece.astype(np.int32))
                    edge, following = following, following + capacity
            columns = [
                keys.take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(sums, pa.int64()),
            ]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return released(run)


def cut(df: DataFrame, key: str, text: str, path: str, capacity: int, end: int | None, with_ids: bool = False) -> DataFrame:
    """The pieces of every whole text: key, piece, start, length, ids_crc32 (and ids), staged, with a ``row`` of their own.

    A document with at most ``capacity`` ids (``end`` included) is one piece; a longer one is cut so that only
    its first piece may be shorter. Null texts count as empty; without ``end`` an empty text has no piece.
    """
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"))
    schema = f"key {dict(slim.dtypes)['key']}, piece int, start bigint, length bigint, ids_crc32 bigint"
    cells = slim.mapInArrow(_cut(path, end, capacity, with_ids), schema + ", ids array<int>" * with_ids)
    return stage(cells.withColumn("row", F.monotonically_increasing_id()))


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with length and row) and their ``sequence_id`` and ``offset``."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 6)
    shared = pieces.sparkSession.sparkContext.broadcast(runs)
    numbered = number_rows(pieces.select("length", "row"), ["length"], ["row"], "number")
    fields = "row bigint, sequence_id bigint, offset bigint"

    def find(batches):
        lengths, firsts, _, bases, each, offsets = shared.value.T
        # Runs are in order of length, and of number within a length.
        top = int(lengths.max()) + 1 if len(lengths) else 1
        bounds = np.searchsorted(lengths, np.arange(top + 1))
        for batch in batches:
            length, row, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            at = np.empty(len(length), np.int64)
            for x in np.unique(length):
                here = np.flatnonzero(length == x)
                a, b = bounds[x], bounds[x + 1]
                at[here] = a + np.searchsorted(firsts[a:b], number[here], "right") - 1
            past = number - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(bases[at] + past // each[at]), pa.array(offsets[at] + past % each[at] * length)],
                names=["row", "sequence_id", "offset"],
            )

    placed = numbered.select("length", "row", "number").mapInArrow(find, fields)
    return pieces.join(placed, "row").drop("row")


def pack(df: DataFrame, key: str, text: str, path: str, capacity: int, end: int | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32 (ids), sequence_id and offset in the sequence."""
    return place(cut(df, key, text, path, capacity, end, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids themselves, from ``pack(with_ids=True)``: at most ``capacity`` ids in each row."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
