"""Packing of training examples under several limits at once: tokens, segments and tokens that bear loss.

An example is one or more texts in a row, of which some bear loss (a response) and some do not (a prompt).
Pieces that fit the limits are put into sequences by the dot-product heuristic for vector bin packing: into
the open sequence goes the piece whose demands, weighted by how scarce each dimension is over all pieces,
have the largest dot product with what is left; a sequence closes when nothing fits.

Pieces that bear loss everywhere or nowhere may be cut to fill what is left; a mixed example is cut only if
it alone breaks a limit, as a cut would part a response from its prompt. A sequence that cannot be filled is
made as long as a power of two (unless told otherwise), if that is possible without padding.

Pieces with the same demands are alike, so the plan is made on their histogram, and a pattern is used as
often as its pieces last: the plan is that of one global run at any size of corpus. It says which numbers of
a class go where, and a piece finds its places by its class and number; what is cut off becomes a further
number of another class.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import named, number_rows
from tidemark.llm.memory import released, slices
from tidemark.session import stage

# The loss of mixed pieces is rounded up to a multiple of this in the plan, which bounds the number of classes.
LOSS_STEP = 16


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int
    segments: int
    loss: int

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")

    @property
    def _steps(self) -> int:
        return -(-min(self.tokens, self.loss) // LOSS_STEP) + 1

    def code(self, length: Column, loss: Column) -> Column:
        """The class of a piece: without loss, all loss, or mixed."""
        mixed = 2 * (self.tokens + 1) + length * self._steps + F.ceil(loss / LOSS_STEP)
        return F.when(loss == 0, length).when(loss == length, self.tokens + 1 + length).otherwise(mixed).cast("bigint")

    def demand(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and (rounded) loss of classes."""
        wide = self.tokens + 1
        rest = code - 2 * wide
        tokens = np.where(code < wide, code, np.where(rest < 0, code - wide, rest // self._steps))
        loss = np.where(code < wide, 0, np.where(rest < 0, code - wide, np.minimum(rest % self._steps * LOSS_STEP, self.loss)))
        return tokens, loss


def _power(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def plan(counts: dict[int, int], limits: Limits, shorten: bool = True) -> np.ndarray:
    """Rows (code, first, pieces, sequence, offset, take, rest code, rest first), sorted by code and first.

    Numbers ``first`` to ``first + pieces - 1`` of a class go to ``sequence``, ``sequence + 1`` ... at ``offset``, with
    their first ``take`` tokens; where tokens remain, these are numbers of the class ``rest code`` from ``rest first`` on.
    ``shorten`` allows sequences of a power of two of tokens, which need no padding, in place of ones that stay partly empty.
    """
    wide = limits.tokens + 1
    uniform = [kind * wide + t for kind in (0, 1) if any(kind * wide <= c < (kind + 1) * wide for c in counts) for t in range(1, wide)]
    codes = np.array(sorted({*uniform, *counts}), np.int64)
    tokens, loss = limits.demand(codes)
    kind = np.minimum(codes // wide, 2)
    left = np.array([counts.get(int(c), 0) for c in codes], np.int64)
    total, used = left.copy(), np.zeros(len(codes), np.int64)
    where = {int(c): k for k, c in enumerate(codes)}
    if len(codes) and (tokens.min() < 1 or (tokens[left > 0] > limits.tokens).any() or (loss[left > 0] > limits.loss).any()):
        raise ValueError("a piece is outside the limits")
    demands = np.stack([tokens / limits.tokens, np.full(len(codes), 1 / limits.segments), loss / limits.loss])
    weights = (demands * left).sum(axis=1) / max(int(left.sum()), 1)
    caps = np.array([limits.tokens, limits.segments, limits.loss], float)

    def pattern(capacity: int) -> tuple[list[tuple[int, int]], int]:
        """Classes and tokens taken of each piece, in order, and the tokens that stay free."""
        free, picked = left.copy(), []
        room, segments, bearing = capacity, limits.segments, limits.loss
        while room and segments:
            fits = np.flatnonzero((free > 0) & (tokens <= room) & (loss <= bearing))
            k = -1
            if len(fits):
                score = (weights * (np.array([room, segments, bearing]) / caps)) @ demands[:, fits]
                k = int(fits[np.argmax(score)])
            take = int(tokens[k]) if k >= 0 else 0
            if k < 0 or (segments == 1 and take < room):
                donors = np.flatnonzero((free > 0) & (tokens > room) & ((kind == 0) | (kind == 1) & (room <= bearing)))
                if len(donors):
                    k, take = int(donors[np.argmax(tokens[donors])]), room
            if k < 0:
                break
            picked.append((k, take))
            free[k] -= 1
            room, segments = room - take, segments - 1
            bearing -= take if kind[k] == 1 else int(loss[k])
        return picked, room

    rows, sequence, remaining = [], 0, int((tokens * left).sum())
    while remaining:
        capacity = limits.tokens if remaining >= limits.tokens or not shorten else _power(remaining)
        picked, room = pattern(capacity)
        if room and capacity < limits.tokens:
            picked, room = pattern(limits.tokens)
        shorter = limits.tokens
        while shorten and room and shorter > 1:
            # Nothing fills it: a power of two at or below what it holds may be filled to the last place.
            filled = sum(take for _, take in picked)
            shorter = min(_power(filled), shorter // 2)
            other, other_room = pattern(shorter)
            if not other_room:
                picked, room = other, 0
        uses = np.bincount([k for k, _ in picked], minlength=len(codes))
        times = int((left[uses > 0] // uses[uses > 0]).min())
        offset = 0
        for k, take in picked:
            rest, first = -1, 0
            if take < tokens[k]:
                rest = where[int(codes[k]) - take]
                first = int(total[rest])
                total[rest] += times
                left[rest] += times
            rows.append((codes[k], used[k], times, sequence, offset, take, codes[rest] if rest >= 0 else -1, first))
            used[k] += times
            left[k] -= times
            offset += take
        sequence += times
        remaining -= offset * times
    out = np.array(rows, np.int64).reshape(-1, 8)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _cut(path: str, end: int | None, bearing: list[bool], limits: Limits, names: list[str], key_type: pa.DataType, every_id: bool):
    schema = pa.schema(
        [("key", key_type)] + [(n, pa.int64()) for n in names[1:-1]] + [(names[-1], pa.binary())]
    )
    mixed = len(set(bearing)) > 1

    def pieces_of(parts: list[np.ndarray]):
        ids = np.concatenate([*parts, [] if end is None else [end]]).astype("<u4")
        if not mixed:
            most = min(limits.tokens, limits.loss) if bearing[0] else limits.tokens
            cuts = list(range(0, len(ids), most))
            return ids, [(a, b, (b - a) * bearing[0]) for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
        flags = np.repeat([*bearing, bearing[-1]], [*map(len, parts), end is not None])
        upto = np.concatenate([[0], np.cumsum(flags)])
        found, a = [], 0
        while a < len(ids):
            b = min(a + limits.tokens, int(np.searchsorted(upto, upto[a] + limits.loss, "right")) - 1)
            found.append((a, b, int(upto[b] - upto[a])))
            a = b
        return ids, found

    def run(batches):
        from tidemark.llm.pieces import encoder

        for batch in batches:
            for part in slices(batch, range(1, 1 + len(bearing))):
                texts = [encoder(path).encode(part.column(1 + c).to_pylist()) for c in range(len(bearing))]
                keys, cells = [], []
                for k, own in enumerate(zip(*texts, strict=True)):
                    ids, found = pieces_of(list(own))
                    for a, b, loss in found:
                        own_ids = ids[a:b].tobytes()
                        # A piece that fills a sequence is never cut again.
                        held = own_ids if every_id or b - a < limits.tokens else None
                        cells.append((a, b - a, loss, zlib.crc32(own_ids), len(ids), held))
                        keys.append(k)
                columns = [pa.array(c, t.type) for c, t in zip(zip(*cells, strict=True), list(schema)[1:], strict=True)] if cells else []
                if cells:
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keys, pa.int64())), *columns], schema=schema)

    return released(run)


def cut(df: DataFrame, key: str, parts: list[tuple[str, bool]], path: str, limits: Limits, end: int | None, every_id: bool) -> DataFrame:
    """Pieces that fit the limits: key, start, length, loss, ids_crc32, doc_tokens, ids (four bytes each), row; staged.

    Without ``every_id`` those ids are null that fill a sequence.
    """
    slim = df.select(named(df, key).alias("key"), *[named(df, c).cast("string").alias(f"t{i}") for i, (c, _) in enumerate(parts)])
    kind = slim.schema["key"].dataType
    names = ["key", "start", "length", "loss", "ids_crc32", "doc_tokens", "ids"]
    schema = f"key {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", ids binary"
    run = _cut(path, end, [b for _, b in parts], limits, names, to_arrow_type(kind), every_id)
    return stage(slim.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))


def _places(shared):
    def run(batches):
        rows = shared.value
        wide = int((rows[:, 1] + rows[:, 2]).max()) + 1 if len(rows) else 1
        keys = rows[:, 0] * wide + rows[:, 1]
        for batch in batches:
            row, code, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            at = np.zeros(len(row), np.int64)
            while len(row):
                k = np.searchsorted(keys, code * wide + number, "right") - 1
                hit = rows[k]
                past = number - hit[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (row, at, hit[:, 5].copy(), hit[:, 3] + past, hit[:, 4].copy())],
                    names=["row", "at", "take", "sequence_id", "offset"],
                )
                on = hit[:, 6] >= 0
                row, code, number, at = row[on], hit[on, 6], hit[on, 7] + past[on], at[on] + hit[on, 5]

    return released(run)


def _checked(ids: Column, at: Column, take: Column) -> Column:
    return F.crc32(F.substring(ids, (at * 4 + 1).cast("int"), (take * 4).cast("int")))


def pack(
    df: DataFrame, key: str, parts: list[tuple[str, bool]], path: str, limits: Limits, end: int | None = None, with_ids: bool = False,
    shorten: bool = True,
) -> DataFrame:
    """One row for each piece: key, start, length, loss, ids_crc32, doc_tokens, sequence_id, offset (and ids, four bytes each).

    ``parts`` names the text columns of an example in order, and says of each if its tokens bear loss; ``end`` follows
    the last and bears what that bears. Null texts count as empty; an example without any id has no piece. Equal rows are
    examples of their own. ``doc_tokens`` counts all ids of the example. In a sequence the pieces lie without a gap.
    """
    pieces = cut(df, key, parts, path, limits, end, with_ids)
    coded = pieces.select("row", limits.code(F.col("length"), F.col("loss")).alias("code"))
    counts = {r["code"]: r["n"] for r in coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = pieces.sparkSession.sparkContext.broadcast(plan(counts, limits, shorten))
    numbered = number_rows(coded, ["code"], ["row"], "number").select("row", "code", "number")
    fields = "row bigint, at bigint, take bigint, sequence_id bigint, offset bigint"
    placed = numbered.mapInArrow(_places(shared), fields)
    cells = placed.join(pieces, "row")
    whole = F.col("take") == F.col("length")
    out = cells.select(
        "key", (F.col("start") + F.col("at")).alias("start"), F.col("take").alias("length"),
        F.when(F.col("loss") == F.col("length"), F.col("take")).otherwise(F.col("loss")).alias("loss"),
        F.when(whole, F.col("ids_crc32")).otherwise(_checked(F.col("ids"), F.col("at"), F.col("take"))).alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
        *([F.substring("ids", (F.col("at") * 4 + 1).cast("int"), (F.col("take") * 4).cast("int")).alias("ids")] if with_ids else []),
    )
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences, from ``pack(with_ids=True)``: ids (four bytes each) and the lengths of the segments."""
    item = F.struct("offset", "ids", "length")
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(item)).alias("parts"))
    joined = F.aggregate("parts.ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return parts.select("sequence_id", joined.alias("ids"), F.col("parts.length").alias("segments"))
