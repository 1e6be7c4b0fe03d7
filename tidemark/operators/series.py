"""Row-order operators over keyed series that may be far too long for one task.

A plain ``Window.partitionBy(key).orderBy(time)`` puts a whole series into one task. That is right
for bars (a century of daily bars is 36,000 rows) and wrong for ticks when one symbol holds a third
of them. ``over_series`` first profiles the keys with one column-pruned aggregate. If no key exceeds
``rows_per_chunk`` the plain window is used. Otherwise the rows of the hot series are numbered and cut
into chunks of exactly so many rows, and each chunk also receives the rows just before (and after) it, so
a frame that looks a bounded number of rows back sees exactly the rows it would have seen.

``running`` covers the frames without a bound (running maximum, running sum, fill from the last or
next value): chunks are summarised, the summaries are carried along the few chunks of a key, and
each row combines its own chunk with what was carried in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import pin, small, stage

ROWS_PER_CHUNK = 5_000_000
# Tasks that number rows follow the rows, not the chunks: a chunk may be shorter than a task is worth.
ROWS_PER_TASK = 200_000


@dataclass(frozen=True)
class Series:
    """How rows form series: the key columns, the time column, and columns that break ties."""

    keys: tuple[str, ...]
    time: str
    ties: tuple[str, ...] = ()

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]

    def window(self, *extra: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *extra).orderBy(*self.order)


def series(keys: str | Sequence[str], time: str, ties: str | Sequence[str] = ()) -> Series:
    as_tuple = lambda names: (names,) if isinstance(names, str) else tuple(names)
    return Series(as_tuple(keys), time, as_tuple(ties))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join that keeps null keys together; ``right`` contributes its non-key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring per-key statistics back to the rows.

    The statistics are pinned and counted; they are broadcast only when the count proves them small.
    """
    return join_on(df, small(pin(stats)), keys)


def _hot_keys(df: DataFrame, s: Series, rows_per_chunk: int) -> DataFrame | None:
    """Keys of the series that are too long for one task, or None when there are none."""
    counts = df.groupBy(*s.keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = pin(counts.filter(F.col("_rows") > rows_per_chunk))
    return None if hot.isEmpty() else hot


def _numbered(rows: DataFrame, s: Series, partitions: int) -> DataFrame:
    """``rows`` and ``_idx``: their places in their series, from 0, without a gap; staged.

    Rows are dealt by ranges of the keys and the order, whose bounds Spark draws from a sample, so a task holds
    about as many rows whatever the clock says, also inside one instant. The place in a task and the counts of
    the tasks before give the place in the series exactly.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))])
    by = [F.col(c).asc_nulls_first() for c in (*s.keys, *s.order)] + [F.col("_tie").asc()]
    dealt = rows.withColumn("_tie", tie).repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    laid = stage(dealt.drop("_tie").withColumn("_place", F.monotonically_increasing_id()))
    # The upper bits of the id are the partition.
    laid = laid.withColumn("_part", F.shiftright("_place", 33))
    counts = laid.groupBy(*s.keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*s.keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    shifts = small(pin(counts.select(*s.keys, "_part", shift.alias("_shift"))))
    placed = join_on(laid, shifts, [*s.keys, "_part"])
    return placed.withColumn("_idx", F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def chunked(df: DataFrame, s: Series, rows_per_chunk: int) -> tuple[DataFrame, DataFrame] | None:
    """(rows of the hot series with ``_idx``, rows of the others), or None when no series is hot."""
    hot = _hot_keys(df, s, rows_per_chunk)
    if hot is None:
        return None
    total = hot.agg(F.sum("_rows")).first()[0]
    wide = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // max(rows_per_chunk, ROWS_PER_TASK)))
    flagged = join_on(df, small(hot), s.keys)
    laid = _numbered(flagged.filter(F.col("_rows").isNotNull()).drop("_rows"), s, wide)
    return laid, flagged.filter(F.col("_rows").isNull()).drop("_rows")


def in_chunks(df: DataFrame, s: Series, rows_per_chunk: int) -> tuple[DataFrame, Series] | None:
    """All rows with ``_chunk`` (0 where a series is not cut) and ``_idx``, and the series of the chunks."""
    parts = chunked(df, s, rows_per_chunk)
    if parts is None:
        return None
    hot, cold = parts
    hot = hot.withColumn("_chunk", F.floor(F.col("_idx") / rows_per_chunk).cast("bigint"))
    cold = cold.withColumns({"_idx": F.lit(None).cast("bigint"), "_chunk": F.lit(0).cast("bigint")})
    return hot.unionByName(cold), Series((*s.keys, "_chunk"), s.time, (*s.ties, "_idx"))


def over_series(
    df: DataFrame,
    s: Series,
    steps: Callable[[DataFrame, Series], DataFrame],
    lookback: int,
    lookahead: int = 0,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Apply window steps to every series, whatever its length.

    ``steps(frame, series)`` adds columns using only windows of the series it is given (which may be
    a chunk of the original one); together they may look at most ``lookback`` rows back and
    ``lookahead`` rows ahead of a row.
    """
    size = max(rows_per_chunk, lookback, lookahead)
    parts = chunked(df, s, size)
    if parts is None:
        return steps(df, s)
    hot, cold = parts
    idx, chunk = F.col("_idx"), F.floor(F.col("_idx") / size).cast("bigint")

    def target(number: Column, context: bool) -> Column:
        return F.struct(number.alias("_chunk"), F.lit(context).alias("_context"))

    # No frame is longer than a chunk, so only the neighbours can need a row.
    targets = F.array_compact(
        F.array(
            target(chunk, False),
            F.when((chunk + 1) * size - idx <= lookback, target(chunk + 1, True)),
            F.when((chunk > 0) & (idx - chunk * size < lookahead), target(chunk - 1, True)),
        )
    )
    unset = F.lit(None).cast("bigint")
    cold = cold.withColumns({"_idx": unset, "_chunk": unset, "_context": F.lit(False)})
    placed = hot.select("*", F.inline(targets)).unionByName(cold)
    done = steps(placed, Series((*s.keys, "_chunk"), s.time, (*s.ties, "_idx")))
    return done.filter(~F.col("_context")).drop("_idx", "_chunk", "_context")


def running(
    df: DataFrame,
    s: Series,
    columns: dict[str, tuple[str, str]],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add columns whose frame reaches the start or the end of the series.

    ``columns`` maps a new column to ``(kind, source)``; kinds are ``max`` and ``sum`` so far,
    ``last`` (last value that is not null, up to this row) and ``next`` (first value that is not
    null, from this row on).
    """
    cut = in_chunks(df, s, rows_per_chunk)
    if cut is None:
        return local_running(df, s, columns)
    placed, chunk = cut

    order = F.struct(*chunk.order)
    summaries = placed.groupBy(*s.keys, "_chunk").agg(
        *[_summary(kind, source, order).alias(f"_sum_{name}") for name, (kind, source) in columns.items()]
    )
    carried = summaries.select(
        *s.keys,
        "_chunk",
        *[_carry(kind, f"_sum_{name}", s.keys).alias(f"_in_{name}") for name, (kind, _) in columns.items()],
    )
    rows = join_on(placed, small(pin(carried)), [*s.keys, "_chunk"])
    rows = rows.withColumns(
        {
            name: _combine(kind, _local(kind, source, chunk), F.col(f"_in_{name}"))
            for name, (kind, source) in columns.items()
        }
    )
    return rows.drop("_chunk", "_idx", *[f"_in_{name}" for name in columns])


def local_running(df: DataFrame, s: Series, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """``running`` for series that are known to fit a task, such as bars a calendar bounds."""
    return df.withColumns({name: _local(kind, source, s) for name, (kind, source) in columns.items()})


def _local(kind: str, source: str, s: Series) -> Column:
    back = s.window().rowsBetween(Window.unboundedPreceding, 0)
    if kind == "max":
        return F.max(source).over(back)
    if kind == "sum":
        return F.sum(source).over(back)
    if kind == "last":
        return F.last(source, ignorenulls=True).over(back)
    if kind == "next":
        # A frame that ends at the last row is evaluated anew for every row, so it would take time
        # in the square of the series; the reversed order needs one more sort instead.
        reverse = Window.partitionBy(*s.keys).orderBy(*[F.col(c).desc_nulls_last() for c in s.order])
        return F.last(source, ignorenulls=True).over(reverse.rowsBetween(Window.unboundedPreceding, 0))
    raise ValueError(f"unknown running kind: {kind}")


def _summary(kind: str, source: str, order: Column) -> Column:
    if kind in ("max", "sum"):
        return getattr(F, kind)(source)
    held = F.when(F.col(source).isNotNull(), order)
    return F.max_by(source, held) if kind == "last" else F.min_by(source, held)


def _carry(kind: str, source: str, keys: Sequence[str]) -> Column:
    order = F.desc("_chunk") if kind == "next" else F.asc("_chunk")
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if kind in ("last", "next"):
        return F.last(source, ignorenulls=True).over(before)
    return getattr(F, kind)(source).over(before)


def _combine(kind: str, local: Column, carried: Column) -> Column:
    if kind == "max":
        return F.greatest(local, carried)
    if kind == "sum":
        return F.when(carried.isNull(), local).otherwise(carried + F.coalesce(local, F.lit(0)))
    return F.coalesce(local, carried)
