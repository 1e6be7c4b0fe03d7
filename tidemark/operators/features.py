"""Time-series features and market metrics.

Every function takes bars of one granularity. By default the series are cut when one is too long for
a task (see ``series``); bars a calendar bounds pass ``rows_per_chunk=None`` and skip that profile.
All windows of a function share one partitioning and order, so Spark shuffles and sorts once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalar import calendar_features, log_return, pct_change, safe_div
from tidemark.operators.series import ROWS_PER_CHUNK, Series, in_chunks, join_on, local_running, over_series, running
from tidemark.session import pin, small, stage

LAGS = (1, 2, 3, 5, 7, 14, 21, 30)
WINDOWS = (3, 7, 14, 30)
# Chunks of a cut series whose maps are composed in one row.
CHUNKS_PER_FOLD = 256


def _apply(df: DataFrame, s: Series, steps: Callable, lookback: int, rows_per_chunk: int | None) -> DataFrame:
    if rows_per_chunk is None:
        return steps(df, s)
    return over_series(df, s, steps, lookback, rows_per_chunk=rows_per_chunk)


def rolling(c: str | Column, w: WindowSpec, n: int, how: Callable = F.avg, at_least: int = 1) -> Column:
    """Aggregate of the last ``n`` rows; null while fewer than ``at_least`` of them hold a value."""
    frame = w.rowsBetween(-(n - 1), 0)
    value = how(c).over(frame)
    return value if at_least <= 1 else F.when(F.count(c).over(frame) >= at_least, value)


def rolling_corr(x: str, y: str, w: WindowSpec, n: int) -> Column:
    """Pearson correlation of the last ``n`` rows; null unless all are present and both vary."""
    frame = w.rowsBetween(-(n - 1), 0)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = F.stddev_pop(a).over(frame) * F.stddev_pop(b).over(frame)
    return F.when(
        F.count(F.when(both, F.lit(1))).over(frame) == n,
        safe_div(F.covar_pop(a, b).over(frame), spread),
    )


def true_range(high: str, low: str, previous_close: str) -> Column:
    h, l, p = F.col(high), F.col(low), F.col(previous_close)
    return F.greatest(h - l, F.abs(h - p), F.abs(l - p))


def with_ema(df: DataFrame, s: Series, column: str, span: int, name: str, product: str | None = None) -> DataFrame:
    """Exponential moving average (recursive form, started by the first value), in linear time.

    Each observation does ``y = keep * y + take``; the old value has decayed once per row, also over
    rows without a value. Observations are numbered and cut into blocks. Inside a block the
    recurrence is a running sum, scaled by the running product of ``keep``. A block multiplies what
    it received by at most 1e-12, so what enters a block is the end of the one before plus the
    scaled end of the one before that. ``product`` adds a column with the product of ``keep`` since the
    first observation: by how much a change of that one would change this row.
    """
    alpha = 2.0 / (span + 1)
    decay = 1 - alpha
    size = max(8, math.ceil(math.log(1e-12) / math.log(decay)))
    row, seen, last, block, keep, take, scale, inner, ends = (
        f"_{name}_{x}" for x in ("row", "seen", "last", "block", "keep", "take", "scale", "inner", "ends")
    )
    x = F.col(column).cast("double")
    w = s.window()
    frame = df.withColumns({row: F.row_number().over(w), seen: F.count(x).over(w)})
    frame = frame.withColumns(
        {
            last: F.max(F.when(x.isNotNull(), F.col(row))).over(
                w.rowsBetween(Window.unboundedPreceding, -1)
            ),
            block: F.floor((F.col(seen) - 1) / size),
        }
    )
    faded = F.greatest(F.power(F.lit(decay), F.col(row) - F.col(last)), F.lit(1e-30))
    follows = x.isNotNull() & F.col(last).isNotNull()
    frame = frame.withColumns(
        {
            keep: F.when(follows, F.ln(faded / (faded + alpha))).otherwise(0.0),
            take: F.when(follows, x * alpha / (faded + alpha)).otherwise(F.coalesce(x, F.lit(0.0))),
        }
    )
    if product:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        frame = frame.withColumn(product, F.exp(F.sum(keep).over(upto)))
    inside = s.window(block).rowsBetween(Window.unboundedPreceding, 0)
    frame = frame.withColumn(scale, F.exp(F.sum(keep).over(inside)))
    frame = frame.withColumn(inner, F.col(scale) * F.sum(F.col(take) / F.col(scale)).over(inside))
    # Ordering by the block first keeps the sort of the step before.
    earlier = (
        Window.partitionBy(*s.keys)
        .orderBy(block, *s.order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    closes = x.isNotNull() & (F.col(seen) % size == 0)
    end = F.when(closes, F.struct(F.col(inner).alias("y"), F.col(scale).alias("k")))
    frame = frame.withColumn(ends, F.last(end, ignorenulls=True).over(earlier))
    chained = F.col(inner) + F.col(scale) * F.coalesce(F.col(f"{ends}.y"), F.lit(0.0))
    carried = F.last(F.when(closes, chained), ignorenulls=True).over(earlier)
    frame = frame.withColumn(
        name,
        F.when(
            F.col(seen) > 0, F.col(inner) + F.col(scale) * F.coalesce(carried, F.lit(0.0))
        ),
    )
    return frame.drop(row, seen, last, block, keep, take, scale, inner, ends)


def _carried_ema(rows: DataFrame, s: Series, column: str, name: str, product: str, alpha: float) -> DataFrame:
    """Per chunk of a cut series: the average that enters it, and by how much that moves its first observation.

    A chunk maps the average that enters it to the one that leaves it, y = a * y + b. Its part a is the product of all
    its weights, in which the first weight depends on the distance to the last observation before the chunk. The maps are
    composed along the chunks of a series, of which there are its rows divided by ``rows_per_chunk``.
    """
    x = F.col(column).cast("double")
    at = F.when(x.isNotNull(), F.col("_idx"))
    ends = rows.filter(F.col("_idx").isNotNull()).groupBy(*s.keys, "_chunk").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.min_by(x, at).alias("x"),
        F.max_by(name, at).alias("y"), F.max_by(product, at).alias("p"),
    )
    return _entering(ends, s.keys, alpha).drop("_before")


def _entering(ends: DataFrame, keys: Sequence[str], alpha: float) -> DataFrame:
    """(keys, _chunk, _enters, _moves, _before): the average that enters a chunk, its move, and the last observation before.

    ``ends`` has a row per chunk with its first and last observation, the value of the first, and the average and the
    product at the last. Consecutive chunks together have such a row too. So ``CHUNKS_PER_FOLD`` chunks are folded into
    a longer one, what enters the longer ones is found in the same way, and it is then led along the chunks of each.
    """
    of_chunk = ("first", "last", "x", "y", "p")
    along = F.array_sort(F.collect_list(F.struct("_chunk", *of_chunk)))
    block = F.floor(F.col("_chunk") / CHUNKS_PER_FOLD).cast("bigint").alias("_block")
    folds = stage(ends.groupBy(*keys, block).agg(along.alias("_along")))
    none, unset = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    empty = {"first": unset, "last": unset, "x": none, "y": none, "p": none}

    def moved(state: Column, c: Column) -> tuple[Column, Column]:
        faded = F.greatest(F.power(F.lit(1 - alpha), c["first"] - state["last"]), F.lit(1e-30))
        weight = faded / (faded + alpha)
        return weight, F.coalesce((state["y"] - c["x"]) * weight, F.lit(0.0))

    def after(state: Column, c: Column) -> dict[str, Column]:
        weight, move = moved(state, c)
        nothing, blank = state["last"].isNull(), c["first"].isNull()
        return {
            "first": F.coalesce(state["first"], c["first"]),
            "last": F.coalesce(c["last"], state["last"]),
            "x": F.when(nothing, c["x"]).otherwise(state["x"]),
            "y": F.when(blank, state["y"]).otherwise(c["y"] + c["p"] * move),
            "p": F.when(nothing, c["p"]).when(blank, state["p"]).otherwise(state["p"] * weight * c["p"]),
        }

    def as_struct(columns: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(n) for n, c in columns.items()])

    if folds.filter(F.col("_block") > 0).isEmpty():
        led = folds.withColumns({"_y": none, "_last": unset})
    else:
        longer = folds.select(
            *keys, F.col("_block").alias("_chunk"), F.aggregate("_along", as_struct(empty), lambda t, c: as_struct(after(t, c))).alias("_end")
        )
        outer = _entering(longer.select(*keys, "_chunk", "_end.*"), keys, alpha)
        outer = outer.select(*keys, F.col("_chunk").alias("_block"), F.col("_enters").alias("_y"), F.col("_before").alias("_last"))
        led = join_on(folds, outer, [*keys, "_block"])

    start = F.struct(
        F.col("_y").alias("y"), F.col("_last").alias("last"),
        F.expr("cast(array() as array<struct<_chunk:bigint,_enters:double,_moves:double,_before:bigint>>)").alias("out"),
    )

    def step(state: Column, c: Column) -> Column:
        _, move = moved(state, c)
        row = F.struct(
            c["_chunk"].alias("_chunk"), state["y"].alias("_enters"), move.alias("_moves"), state["last"].alias("_before")
        )
        return F.struct(
            F.when(c["first"].isNull(), state["y"]).otherwise(c["y"] + c["p"] * move).alias("y"),
            F.coalesce(c["last"], state["last"]).alias("last"),
            F.array_append(state["out"], row).alias("out"),
        )

    return led.select(*keys, F.aggregate("_along", start, step)["out"].alias("_out")).select(*keys, F.inline("_out"))


def ema(
    df: DataFrame,
    s: Series,
    column: str,
    spans: Sequence[int] = (20,),
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``ema_<span>`` columns. A series that is cut gives the same averages, however far apart its values are."""
    cut = None if rows_per_chunk is None else in_chunks(df, s, rows_per_chunk)
    if cut is None:
        for span in spans:
            df = with_ema(df, s, column, span, f"ema_{span}")
        return df
    rows, part = cut
    for span in spans:
        rows = with_ema(rows, part, column, span, f"ema_{span}", f"_p_{span}")
    rows = stage(rows)
    for span in spans:
        name, product = f"ema_{span}", f"_p_{span}"
        carried = small(pin(_carried_ema(rows, s, column, name, product, 2.0 / (span + 1))))
        rows = join_on(rows, carried, [*s.keys, "_chunk"])
        whole = F.col(name) + F.col(product) * F.coalesce("_moves", F.lit(0.0))
        rows = rows.withColumn(name, F.coalesce(whole, "_enters")).drop(product, "_enters", "_moves")
    return rows.drop("_chunk", "_idx")


def time_features(
    df: DataFrame,
    s: Series,
    value: str,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Lags, rolling mean and deviation, percent changes, range and calendar columns."""
    filled = f"_{value}_filled"
    carry = {filled: ("last", value)}
    df = local_running(df, s, carry) if rows_per_chunk is None else running(df, s, carry, rows_per_chunk)
    spread = (
        F.col("high") - F.col("low")
        if {"high", "low"} <= set(df.columns)
        else F.col("high") - F.col(value) if "high" in df.columns
        else F.col(value) - F.col("low") if "low" in df.columns
        else F.col(value) - F.col(value)
    )

    def steps(frame: DataFrame, part: Series) -> DataFrame:
        w = part.window()
        columns = {f"{value}_lag_{k}": F.lag(value, k).over(w) for k in lags}
        for n in windows:
            columns[f"{value}_ma_{n}"] = rolling(value, w, n)
            columns[f"{value}_std_{n}"] = rolling(value, w, n, F.stddev_samp, at_least=2)
        for k in (1, 7):
            columns[f"{value}_pct_change_{k}"] = pct_change(filled, F.lag(filled, k).over(w))
        columns[f"{value}_range"] = spread
        return frame.withColumns({**columns, **calendar_features(s.time)})

    longest = max([*lags, *windows, 7])
    return _apply(df, s, steps, longest, rows_per_chunk).drop(filled)


def asset_metrics(
    df: DataFrame, s: Series, asset: str, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Derived columns of one asset class: stock, crypto, forex, etf or index.

    Averages and volatilities need a full window and are null before it.
    """
    if asset == "index":
        carry = {"cumulative_max": ("max", "close")}
        df = local_running(df, s, carry) if rows_per_chunk is None else running(df, s, carry, rows_per_chunk)

    def steps(frame: DataFrame, part: Series) -> DataFrame:
        w = part.window()
        close_before = F.lag("close", 1).over(w)
        full = lambda n, c="close", how=F.avg: rolling(c, w, n, how, at_least=n)
        if asset == "stock":
            return frame.withColumns(
                {
                    "returns": pct_change("close", close_before),
                    "dollar_volume": F.col("close") * F.col("volume"),
                    "sma_20": full(20),
                    "sma_50": full(50),
                }
            )
        if asset == "crypto":
            frame = frame.withColumn("log_returns", log_return("close", close_before))
            return frame.withColumns(
                {
                    "volatility_20d": full(20, "log_returns", F.stddev_samp) * math.sqrt(365),
                    "market_sentiment": rolling_corr("close", "volume", w, 10),
                }
            )
        if asset == "forex":
            columns = {"pct_change": pct_change("close", close_before) * 100}
            if {"bid", "ask"} <= set(frame.columns):
                columns["spread"] = F.col("ask") - F.col("bid")
                columns["spread_pips"] = (F.col("ask") - F.col("bid")) * 10000
            return frame.withColumns(columns)
        if asset == "etf":
            frame = frame.withColumns(
                {"nav": F.col("close"), "daily_return": pct_change("close", close_before)}
            )
            return frame.withColumns(
                {
                    "volatility_20d": full(20, "daily_return", F.stddev_samp) * math.sqrt(252),
                    "volume_trend": safe_div("volume", full(10, "volume")),
                }
            )
        if asset == "index":
            frame = frame.withColumn("daily_return", pct_change("close", close_before) * 100)
            frame = frame.withColumns(
                {
                    "sma_20": full(20),
                    "sma_50": full(50),
                    "sma_200": full(200),
                    "volatility_20d": full(20, "daily_return", F.stddev_samp) * math.sqrt(252),
                    "drawdown": safe_div(F.col("close") - F.col("cumulative_max"), "cumulative_max") * 100,
                }
            )
            return frame
        raise ValueError(f"unknown asset class: {asset}")

    out = _apply(df, s, steps, 200 if asset == "index" else 51, rows_per_chunk)
    return ema(out, s, "close", (20, 50), rows_per_chunk) if asset == "index" else out
