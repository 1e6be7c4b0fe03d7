"""Resampling to bars, gap filling and granularity detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.series import ROWS_PER_CHUNK, Series, join_on, over_series
from tidemark.operators.stats import quantiles
from tidemark.session import stage

_WINDOWS = {
    "1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour",
    "2h": "2 hours", "4h": "4 hours", "6h": "6 hours",
}
_STEPS = {**_WINDOWS, "1d": "1 day", "1w": "7 days"}
_MINUTES = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "4h": 240, "6h": 360, "1d": 1440, "1w": 10080}
_MONTHS = {"1M": 1, "1q": 3, "1y": 12}
CALENDAR_BLOCK = 10_000

# Aggregate per column and data type.
RULES = {
    "stock": {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum", "exchange": "first"},
    "crypto": {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum", "exchange": "first"},
    "forex": {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum"},
    "economic": {"value": "last"},
    "weather": {"temperature": "mean", "humidity": "mean", "pressure": "mean", "wind_speed": "mean"},
    "sentiment": {"sentiment_score": "mean", "confidence": "mean"},
}


def bin_of(ts: str | Column, granularity: str) -> Column:
    """Label of the bin that holds a timestamp.

    Bins of a day or less are labelled by their start; weeks (Monday to Sunday), months, quarters
    and years by their last day.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    if granularity in _WINDOWS:
        return F.window(t, _WINDOWS[granularity]).getField("start")
    if granularity == "1d":
        return F.date_trunc("day", t)
    if granularity == "1w":
        return F.date_trunc("week", t) + F.expr("INTERVAL 6 DAYS")
    if granularity in ("1M", "1q", "1y"):
        part, months = {"1M": ("month", 1), "1q": ("quarter", 3), "1y": ("year", 12)}[granularity]
        return F.date_trunc(part, t) + F.expr(f"INTERVAL {months} MONTHS") - F.expr("INTERVAL 1 DAY")
    raise ValueError(f"unknown granularity: {granularity}")


def _bin(ts: str, kind: str, granularity: str) -> Column:
    """``date_trunc`` returns a zoned timestamp, so an unzoned column is cast back."""
    label = bin_of(ts, granularity)
    return label.cast("timestamp_ntz") if kind == "timestamp_ntz" else label


def aggregate_for(column: str, how: str, ts: str, ties: Sequence[str] = ()) -> Column:
    """One resampling rule; ``first`` and ``last`` skip nulls."""
    if how in ("first", "last"):
        order = F.struct(ts, *ties) if ties else F.col(ts)
        present = F.when(F.col(column).isNotNull(), order)
        return (F.min_by if how == "first" else F.max_by)(column, present)
    return {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg}[how](column)


def resample(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    granularity: str,
    rules: dict[str, str],
    ties: Sequence[str] = (),
    fill_gaps: bool = False,
) -> DataFrame:
    """Rows to bins, per key. Partial aggregation spreads a hot key over all map tasks.

    ``fill_gaps`` also emits the empty bins between a key's first and last one: sums are 0 there,
    everything else is null.
    """
    present = {c: how for c, how in rules.items() if c in df.columns}
    kind = dict(df.dtypes)[ts]
    out = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, _bin(ts, kind, granularity).alias("_bin"))
        .agg(*[aggregate_for(c, how, ts, ties).alias(c) for c, how in present.items()])
        .withColumnRenamed("_bin", ts)
    )
    if fill_gaps:
        out = fill_bins(out, keys, ts, granularity)
        sums = [c for c, how in present.items() if how == "sum"]
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(dict(out.dtypes)[c])) for c in sums})
    return out


def fill_bins(bars: DataFrame, keys: Sequence[str], ts: str, granularity: str) -> DataFrame:
    """Add the missing bins between the first and the last bin of each key.

    The calendar of a key is counted, dealt out as blocks of ``CALENDAR_BLOCK`` bins, and each block lists its own bins;
    so no cell holds a whole calendar, and the one of a single key is made by many tasks.
    """
    kind = dict(bars.dtypes)[ts]
    first, k = F.col("_from"), F.col("_block") * CALENDAR_BLOCK + F.col("_at")
    if granularity in _MONTHS:
        months = _MONTHS[granularity]
        upto = lambda c: F.year(c) * 12 + F.month(c)
        steps = F.floor((upto("_to") - upto("_from")) / months)
        label = F.last_day(F.add_months(first.cast("date"), (k * months).cast("int"))).cast(kind)
    else:
        minutes = _MINUTES[granularity]
        steps = F.floor(F.expr("timestampdiff(MINUTE, _from, _to)") / minutes)
        label = first + F.make_dt_interval(mins=(k * minutes).cast("int"))
    spans = bars.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to")).withColumn("_steps", steps.cast("bigint"))
    blocks = spans.select(*keys, "_from", "_steps", F.explode(F.sequence(F.lit(0), F.floor(F.col("_steps") / CALENDAR_BLOCK))).alias("_block"))
    left = F.col("_steps") - F.col("_block") * CALENDAR_BLOCK
    places = F.sequence(F.lit(0).cast("bigint"), F.least(left, F.lit(CALENDAR_BLOCK - 1)))
    calendar = blocks.repartition(*keys, "_block").select(*keys, "_from", "_block", F.explode(places).alias("_at"))
    return join_on(calendar.select(*keys, label.alias(ts)), bars, [*keys, ts]).select(*bars.columns)


def ohlcv(
    ticks: DataFrame,
    keys: Sequence[str],
    ts: str,
    price: str,
    volume: str,
    granularity: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Ticks (one price, one volume) to open/high/low/close/volume bars."""
    shaped = ticks.select(
        *keys, ts, *ties,
        F.col(price).alias("open"), F.col(price).alias("high"), F.col(price).alias("low"),
        F.col(price).alias("close"), F.col(volume).alias("volume"),
    )
    return resample(shaped, keys, ts, granularity, RULES["forex"], ties)


def gaps(df: DataFrame, s: Series, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Seconds since the previous row of the series, as ``gap``; rows without a time are left out."""
    timed = df.filter(F.col(s.time).isNotNull())
    micros = F.unix_micros(F.col(s.time).cast("timestamp"))
    return over_series(
        timed,
        s,
        lambda frame, part: frame.withColumn(
            "gap", (micros - F.lag(micros, 1).over(part.window())) / 1e6
        ),
        lookback=1,
        rows_per_chunk=rows_per_chunk,
    )


def granularity_label(seconds: str | Column) -> Column:
    gap = F.col(seconds) if isinstance(seconds, str) else seconds
    result = F
    for label, limit in schemas.GRANULARITY_LIMITS:
        result = result.when(gap <= limit, F.lit(label))
    return result.when(gap.isNotNull(), F.lit("custom"))


def granularity(df: DataFrame, s: Series, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Granularity label of each series from the median gap between its rows."""
    spaced = gaps(df.select(*s.keys, *s.order), s, rows_per_chunk).filter(F.col("gap").isNotNull())
    spaced = stage(spaced.select(*s.keys, "gap"))
    medians = quantiles(spaced, s.keys, {"gap": [0.5]})
    return medians.select(*s.keys, F.col("gap_p50").alias("median_gap"), granularity_label("gap_p50").alias("granularity"))
