"""The analytical queries over price, rate, indicator, weather and run tables.

``keys`` name the series (symbol, or base and quote currency). Functions over row windows expect bars;
series that may not fit a task go through ``over_series``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import pct_change, safe_div, volatility_level
from tidemark.operators.features import rolling, true_range
from tidemark.operators.series import ROWS_PER_CHUNK, Series, attach, join_on, over_series, running

Keys = Sequence[str]


# --- statistics per series -----------------------------------------------------------------------


def range_stats(df: DataFrame, keys: Keys, first=None, last=None, time: str = "date") -> DataFrame:
    """Lowest low, highest high and mean close per series and day, within optional bounds."""
    if first is not None:
        df = df.filter(F.col(time) >= F.lit(first))
    if last is not None:
        df = df.filter(F.col(time) <= F.lit(last))
    return df.groupBy(*keys, time).agg(
        F.min("low").alias("min_rate"), F.max("high").alias("max_rate"), F.avg("close").alias("avg_rate")
    )


def volatility_stats(df: DataFrame, keys: Keys) -> DataFrame:
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_days"),
        F.avg("close").alias("avg_close"),
        F.min("low").alias("min_low"),
        F.max("high").alias("max_high"),
        F.stddev_samp("close").alias("std_dev"),
    )
    spread = safe_div(F.col("max_high") - F.col("min_low"), "avg_close") * 100
    return stats.withColumn("range_pct", spread)


def inventory(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_records"),
        F.min(time).alias("earliest_date"),
        F.max(time).alias("latest_date"),
    )


def duplicate_keys(df: DataFrame, keys: Keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def daily_stats(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    return df.groupBy(*keys, F.to_date(time).alias("date")).agg(
        F.avg("close").alias("avg_close"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        F.sum("volume").alias("total_volume"),
    )


def intraday_range(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    day = df.groupBy(*keys, F.to_date(time).alias("trading_date")).agg(
        F.max("high").alias("daily_high"), F.min("low").alias("daily_low"), F.sum("volume").alias("total_volume")
    )
    return day.withColumn("daily_range", F.col("daily_high") - F.col("daily_low"))


def volume_stats(df: DataFrame, by: str = "timeframe") -> DataFrame:
    """Volume statistics per timeframe, from the shortest to the longest."""
    order = {"M1": 1, "M5": 2, "M15": 3, "M30": 4, "H1": 5, "H4": 6, "D1": 7, "W1": 8, "MN1": 9}
    place = F
    for name, n in order.items():
        place = place.when(F.col(by) == name, n)
    return (
        df.groupBy(by)
        .agg(
            F.avg("volume").alias("avg_volume"),
            F.min("volume").alias("min_volume"),
            F.max("volume").alias("max_volume"),
            F.stddev_samp("volume").alias("volume_stddev"),
        )
        .orderBy(place.otherwise(99), by)
    )


def trading_days(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    """Distinct days per series, in two aggregation steps, so a hot series is spread over its days."""
    days = df.select(*keys, F.to_date(time).alias("_day")).distinct()
    return days.groupBy(*keys).agg(F.count("_day").alias("trading_days"))


def counts(df: DataFrame, keys: Keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *keys)


def span_summary(df: DataFrame, time: str) -> DataFrame:
    return df.agg(
        F.min(time).alias("first"), F.max(time).alias("last"), F.avg("volume").alias("avg_volume"),
        F.count(F.lit(1)).alias("rows"),
    )


def by_frequency(df: DataFrame, keys: Keys, time: str, value: str, frequency: str, method: str = "avg") -> DataFrame:
    """Coarser frequency (week, month, quarter, year) by average, sum or end of period."""
    how = {"avg": F.avg(value), "sum": F.sum(value), "eop": F.max_by(value, time)}[method]
    return df.groupBy(*keys, F.to_date(F.date_trunc(frequency, time)).alias("period")).agg(how.alias("value"))


def load_failure(results: DataFrame, total: str = "total", failed: str = "failed", threshold: float = 0.05) -> DataFrame:
    totals = results.agg(F.sum(total).alias("total"), F.sum(failed).alias("failed"))
    rate = F.coalesce(safe_div("failed", "total"), F.lit(0.0))
    return totals.withColumn("failure_rate", rate).withColumn("ok", F.col("failure_rate") <= threshold)


# --- filters -------------------------------------------------------------------------------------


def volatile_days(df: DataFrame, limit: float = 0.02) -> DataFrame:
    """Rows that moved more than ``limit``, with the movement and its level."""
    move = safe_div(F.col("high") - F.col("low"), "low")
    return df.filter(move > limit).withColumns(
        {"volatility_pct": move * 100, "volatility_level": volatility_level("high", "low")}
    )


def with_volatility_level(df: DataFrame) -> DataFrame:
    move = safe_div(F.col("high") - F.col("low"), "low") * 100
    return df.withColumns({"volatility_pct": move, "volatility_level": volatility_level("high", "low")})


def extreme_weather(df: DataFrame, hottest: float = 35, coldest: float = -10) -> DataFrame:
    return df.filter(
        (F.col("temperature_daily_max") > hottest) | (F.col("temperature_daily_min") < coldest)
    )


def ohlc_violations(df: DataFrame) -> DataFrame:
    high = F.col("high")
    return df.filter((high < F.col("low")) | (high < F.col("open")) | (high < F.col("close")))


def since(df: DataFrame, time: str, days: int, asof: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``asof`` (default: the latest time in the table)."""
    if asof is None:
        latest = df.agg(F.max(time).alias("_asof"))
        df = df.crossJoin(F.broadcast(latest))  # one row
        asof = F.col("_asof")
    start = asof.cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    t = F.col(time).cast("timestamp_ntz")
    return df.filter((t >= start) & (t <= asof.cast("timestamp_ntz"))).drop("_asof")


def released_on(df: DataFrame, day: Column) -> DataFrame:
    return df.filter(F.col("data_release_date") == day)


def search(df: DataFrame, text: str, limit: int = 100, by: str = "popularity") -> DataFrame:
    """Series whose title contains the text, most popular first (top-k, no full sort)."""
    hit = F.contains(F.lower("title"), F.lit(text.lower()))
    return df.filter(hit).orderBy(F.desc_nulls_last(by), "series_id").limit(limit)


def failed_runs(runs: DataFrame, asof: Column, hours: int = 24) -> DataFrame:
    recent = F.col("start_time") >= asof - F.expr(f"INTERVAL {int(hours)} HOURS")
    return runs.filter((F.col("status") == "failed") & recent)


def failed_counts(runs: DataFrame, asof: Column, hours: int = 24) -> DataFrame:
    return failed_runs(runs, asof, hours).groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("failed_runs"))


# --- latest rows ---------------------------------------------------------------------------------


def latest(df: DataFrame, keys: Keys, time: str, ties: Keys = ()) -> DataFrame:
    """Latest row per series. Spark limits each group below the shuffle."""
    return last_rows(df, keys, time, 1, ties)


def last_rows(df: DataFrame, keys: Keys, time: str, n: int, ties: Keys = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last(), *[F.col(c).desc() for c in ties])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def at_latest_time(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    """Every row at the latest time of its series (for example one per broker)."""
    newest = df.groupBy(*keys).agg(F.max(time).alias("_newest"))
    return attach(df, newest, keys).filter(F.col(time) == F.col("_newest")).drop("_newest")


def latest_change(df: DataFrame, keys: Keys, time: str, value: str, ties: Keys = ()) -> DataFrame:
    """Latest value, the one before it and the change in percent.

    Only the last two rows of a series leave the map side, so its length does not matter.
    """
    two = last_rows(df, keys, time, 2, ties)
    w = Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_first(), *ties)
    both = two.withColumn("prev_close", F.lag(value, 1).over(w))
    newest = last_rows(both, keys, time, 1, ties)
    return newest.select(
        *keys, time, F.col(value).alias("latest_rate"), "prev_close",
        (pct_change(value, "prev_close") * 100).alias("change_pct"),
    )


def high_water_mark(df: DataFrame, time: str, **equal) -> DataFrame:
    """Latest loaded time among the rows that match; an aggregate, so only that column is read."""
    for name, wanted in equal.items():
        df = df.filter(F.col(name) == wanted)
    return df.agg(F.max(time).alias("latest"))


# --- row windows ---------------------------------------------------------------------------------


def _windowed(df: DataFrame, s: Series, lookback: int, build, rows_per_chunk: int) -> DataFrame:
    return over_series(
        df, s, lambda frame, part: frame.withColumns(build(part.window())), lookback, rows_per_chunk=rows_per_chunk
    )


def moving_averages(
    df: DataFrame, s: Series, value: str, spans: Sequence[int] = (7, 20, 30), rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    build = lambda w: {f"ma_{n}": rolling(value, w, n) for n in spans}
    return _windowed(df, s, max(spans), build, rows_per_chunk)


def changes(df: DataFrame, s: Series, value: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Previous value, change in points and in percent."""

    def build(w):
        before = F.lag(value, 1).over(w)
        return {
            "prev_value": before,
            "change_pts": F.col(value) - before,
            "change_pct": pct_change(value, before) * 100,
        }

    return _windowed(df, s, 1, build, rows_per_chunk)


def average_range(df: DataFrame, s: Series, n: int = 20, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    build = lambda w: {f"avg_range_{n}": rolling(F.col("high") - F.col("low"), w, n)}
    return _windowed(df, s, n, build, rows_per_chunk)


def average_true_range(df: DataFrame, s: Series, n: int = 14, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    def steps(frame: DataFrame, part: Series) -> DataFrame:
        w = part.window()
        frame = frame.withColumn("_before", F.lag("close", 1).over(w))
        frame = frame.withColumn("true_range", true_range("high", "low", "_before")).drop("_before")
        return frame.withColumn(f"atr_{n}", rolling("true_range", w, n))

    return over_series(df, s, steps, n + 1, rows_per_chunk=rows_per_chunk)


def high_volume(
    df: DataFrame, s: Series, n: int = 20, factor: float = 1.5, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Bars with more than ``factor`` times the mean volume of the last ``n`` rows."""
    name = f"ma_{n}_volume"
    out = _windowed(df, s, n, lambda w: {name: rolling("volume", w, n)}, rows_per_chunk)
    return out.filter(F.col("volume") > factor * F.col(name))


def anomalous_values(df: DataFrame, s: Series, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Large gain, large loss, or more than ten times the mean volume of the 30 rows before."""
    out = _windowed(
        df, s, 30, lambda w: {"_mean": F.avg("volume").over(w.rowsBetween(-30, -1))}, rows_per_chunk
    )
    kind = (
        F.when(F.col("close") > F.col("open") * 1.5, "large_gain")
        .when(F.col("close") < F.col("open") * 0.5, "large_loss")
        .when(F.col("volume") > F.col("_mean") * 10, "high_volume")
    )
    return out.withColumn("anomaly_type", kind).drop("_mean")


def duration_trend(runs: DataFrame, s: Series, duration: str, n: int = 8, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    return _windowed(runs, s, n, lambda w: {f"moving_avg_{n}": rolling(duration, w, n)}, rows_per_chunk)


# --- gaps and calendars --------------------------------------------------------------------------


def next_day_gaps(df: DataFrame, keys: Keys, day: str) -> DataFrame:
    """Days after which a series has no row, reported as the missing day."""
    days = df.select(*keys, F.to_date(day).alias("_day")).distinct()
    following = days.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.date_sub("_day", 1).alias("_before"))
    same = F.col("_day") == F.col("_before")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    return days.join(following, same, "left_anti").select(*keys, F.date_add("_day", 1).alias("missing_date"))


def missing_days(df: DataFrame, keys: Keys, day: str, first=None, last=None, more_than: int = 2) -> DataFrame:
    """Weekdays without a row, counted per series between two days (default: the table's span).

    The number of weekdays in the span is arithmetic on one calendar and the days present are
    counted per series, so no calendar-by-series product is built.
    """
    days = df.select(*keys, F.to_date(day).alias("_day"))
    bounds = days.agg(F.min("_day").alias("_from"), F.max("_day").alias("_to")).select(
        (F.lit(first).cast("date") if first is not None else F.col("_from")).alias("_from"),
        (F.lit(last).cast("date") if last is not None else F.col("_to")).alias("_to"),
    )
    weekdays = F.size(F.filter(F.sequence("_from", "_to"), lambda d: F.weekday(d) < 5))
    bounds = bounds.withColumn("_expected", weekdays)
    scoped = days.crossJoin(F.broadcast(bounds))  # one row
    inside = F.col("_day").between(F.col("_from"), F.col("_to")) & (F.weekday("_day") < 5)
    present = scoped.select(*keys, "_expected", F.when(inside, F.col("_day")).alias("_day")).distinct()
    found = present.groupBy(*keys).agg(F.max("_expected").alias("_expected"), F.count("_day").alias("_n"))
    return (
        found.withColumn("missing_days", (F.col("_expected") - F.col("_n")).cast("bigint"))
        .filter(F.col("missing_days") > more_than)
        .select(*keys, "missing_days")
    )


# --- comparisons ---------------------------------------------------------------------------------


def side_by_side(df: DataFrame, time: str, name: str, value: str, wanted: Sequence[str]) -> DataFrame:
    """One row per day with a column per indicator."""
    return df.groupBy(time).agg(
        *[F.max(F.when(F.col(name) == w, F.col(value))).alias(w) for w in wanted]
    )


def condition_frequency(df: DataFrame, place: str, condition: str) -> DataFrame:
    """Count and share of each condition within its place (the window runs over the counts)."""
    counted = df.groupBy(place, condition).agg(F.count(F.lit(1)).alias("frequency"))
    share = 100.0 * F.col("frequency") / F.sum("frequency").over(Window.partitionBy(place))
    return counted.withColumn("pct", F.round(share, 1))


def precipitation(df: DataFrame, keys: Keys, amount: str, at_least: float = 10) -> DataFrame:
    totals = df.groupBy(*keys).agg(
        F.sum(amount).alias("total_daily_rain"), F.count(F.lit(1)).alias("hourly_observations")
    )
    return totals.filter(F.col("total_daily_rain") > at_least)


def run_trends(runs: DataFrame) -> DataFrame:
    return runs.groupBy(F.to_date("start_time").alias("run_date"), "pipeline_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "success").alias("successful_runs"),
        F.avg("duration_seconds").alias("avg_duration_sec"),
        F.max("duration_seconds").alias("max_duration_sec"),
        F.sum("records_processed").alias("total_records_loaded"),
    )


def anomaly_trends(runs: DataFrame, details: str = "anomaly_details") -> DataFrame:
    """Runs with anomalies and the number of anomalies in their JSON array, per day and pipeline."""
    n = F.coalesce(F.json_array_length(details), F.lit(0))
    return runs.groupBy(F.to_date("start_time").alias("run_date"), "pipeline_id").agg(
        F.count_if(n > 0).alias("runs_with_anomalies"), F.sum(n).cast("bigint").alias("anomaly_count")
    )


def market_summary(quotes: DataFrame, change: str = "percent_change") -> DataFrame:
    """Quotes with the share of rising markets as a mood: Positive when more than half rise."""
    mood = quotes.agg(
        F.when(F.count_if(F.col(change) > 0) > F.count(F.lit(1)) / 2, "Positive")
        .otherwise("Negative")
        .alias("market_sentiment")
    )
    return quotes.crossJoin(F.broadcast(mood))  # one row


def union_sources(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of different sources, stacked, with the source as a column."""
    from tidemark.operators.standardize import combine

    return combine(tables, "source")


def known_at(
    moments: DataFrame, observations: DataFrame, keys: Keys, at: str, start: str = "realtime_start", end: str = "realtime_end",
    keep_unknown: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Point-in-time join: of each key the observation that was valid at a moment, both ends of its range included.

    Moments and observations go through one ordered stream per key, in which the observation that began last is carried
    on to the moments; whether it has ended is looked at afterwards. So each row is moved once, however long a range is, and
    long streams are cut. Where ranges overlap, the one that began last counts, and of those that began together the
    one that ends last. Moments without an observation are left out, or kept with nulls where ``keep_unknown`` is set.
    """
    more = [c for c in observations.columns if c not in keys]
    kind = dict(moments.dtypes)[at]
    held = observations.filter(F.col(start).isNotNull()).select(
        *keys, F.col(start).cast(kind).alias("_time"), F.lit(0).alias("_kind"), F.col(end).cast(kind).alias("_until"),
        F.struct(*more).alias("_seen"), F.lit(None).cast(moments.schema.simpleString()).alias("_row"),
    )
    asked = moments.select(
        *keys, F.col(at).alias("_time"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_until"),
        F.lit(None).cast(held.schema["_seen"].dataType).alias("_seen"), F.struct(*moments.columns).alias("_row"),
    )
    stream = Series(tuple(keys), "_time", ("_kind", "_until"))
    merged = running(held.unionByName(asked), stream, {"_valid": ("last", "_seen")}, rows_per_chunk)
    valid = F.col(f"_valid.{end}").cast(kind) >= F.col("_time")
    found = merged.filter("_kind = 1").withColumn("_valid", F.when(valid, F.col("_valid")))
    if not keep_unknown:
        found = found.filter(F.col("_valid").isNotNull())
    return found.select("_row.*", *[F.col(f"_valid.{c}").alias(c) for c in more])
