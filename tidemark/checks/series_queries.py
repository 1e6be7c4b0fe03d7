"""Bars, features and row windows over ``events`` (event type as symbol, value as price)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import Tables, query
from tidemark.operators import bars, catalogue, clean, features
from tidemark.operators.series import in_chunks, over_series, running, series

BAR = series("symbol", "ts")


def bars_sql(unit: str) -> str:
    return f"""bars AS (
  SELECT event_type AS symbol, CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS ts, arg_min(value, ts) AS open,
         max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, CAST(sum(user_id) AS BIGINT) AS volume
  FROM events GROUP BY 1, 2)"""


DAILY, HOURLY = bars_sql("day"), bars_sql("hour")
W = "(PARTITION BY symbol ORDER BY ts)"


def rows(n: int, end: str = "CURRENT ROW") -> str:
    return f"(PARTITION BY symbol ORDER BY ts ROWS BETWEEN {n} PRECEDING AND {end})"


def ticks(t: Tables) -> DataFrame:
    return t.events.withColumnRenamed("event_type", "symbol")


def bars_of(t: Tables, granularity: str) -> DataFrame:
    return bars.ohlcv(ticks(t), ["symbol"], "ts", "value", "user_id", granularity)


OHLCV = "symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume"


@query(f"WITH {HOURLY} SELECT {OHLCV} FROM bars")
def ohlcv_hourly(t):
    return bars_of(t, "1h")


@query(f"WITH {DAILY} SELECT {OHLCV} FROM bars")
def ohlcv_daily(t):
    return bars_of(t, "1d")


@query(
    """SELECT event_type AS symbol, CAST(time_bucket(INTERVAL '15 minutes', ts) AS TIMESTAMP) AS ts,
  round(arg_min(value, ts), 6) AS open, round(max(value), 6) AS high, round(min(value), 6) AS low,
  round(arg_max(value, ts), 6) AS close, CAST(sum(user_id) AS BIGINT) AS volume FROM events GROUP BY 1, 2"""
)
def ohlcv_15m(t):
    return bars_of(t, "15m")


@query(
    f"""WITH {DAILY} SELECT symbol, CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 6 DAY AS ts,
  round(arg_min(open, ts), 6) AS open, round(max(high), 6) AS high, round(min(low), 6) AS low,
  round(arg_max(close, ts), 6) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1, 2"""
)
def resample_weekly(t):
    return bars.resample(bars_of(t, "1d"), ["symbol"], "ts", "1w", bars.RULES["stock"])


@query(
    """SELECT o_orderstatus AS symbol, CAST(last_day(o_orderdate) AS TIMESTAMP) AS ts, round(sum(o_totalprice), 2) AS volume
FROM orders GROUP BY 1, 2"""
)
def resample_monthly(t):
    out = bars.resample(
        t.orders.select(F.col("o_orderstatus").alias("symbol"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("volume")),
        ["symbol"], "ts", "1M", {"volume": "sum"},
    )
    return out.withColumn("volume", F.round("volume", 2))


@query(
    """WITH b AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, arg_max(value, ts) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2),
c AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM b GROUP BY 1)
SELECT c.user_id, c.ts, round(b.close, 6) AS close, coalesce(b.volume, 0) AS volume
FROM c LEFT JOIN b ON b.user_id = c.user_id AND b.ts = c.ts"""
)
def resample_gap_fill(t):
    one = t.events.select("user_id", "ts", F.col("value").alias("close"), F.lit(1).cast("bigint").alias("volume"))
    return bars.resample(one, ["user_id"], "ts", "1h", {"close": "last", "volume": "sum"}, fill_gaps=True)


def _calendar_sql(name: str, part: str, step: str) -> str:
    last = f"date_trunc('{part}', o_orderdate) + INTERVAL {step} - INTERVAL 1 DAY"
    return f"""SELECT '{name}' AS kind, c.k AS o_custkey, CAST(c.d + INTERVAL {step} - INTERVAL 1 DAY AS TIMESTAMP) AS ts, coalesce(v, 0) AS n
FROM (SELECT o_custkey AS k, unnest(generate_series(min(date_trunc('{part}', o_orderdate)), max(date_trunc('{part}', o_orderdate)), INTERVAL {step})) AS d
  FROM orders GROUP BY 1) c LEFT JOIN (SELECT o_custkey AS k, {last} AS e, count(*) AS v FROM orders GROUP BY 1, 2) b
ON b.k = c.k AND b.e = c.d + INTERVAL {step} - INTERVAL 1 DAY"""


@query(
    " UNION ALL ".join(
        [_calendar_sql("1M", "month", "1 MONTH"), _calendar_sql("1q", "quarter", "3 MONTH"), _calendar_sql("1y", "year", "1 YEAR")]
    )
)
def calendar_gap_fill(t):
    one = t.orders.select("o_custkey", F.col("o_orderdate").alias("ts"), F.lit(1).cast("bigint").alias("n"))
    parts = [
        bars.resample(one, ["o_custkey"], "ts", g, {"n": "sum"}, fill_gaps=True).withColumn("kind", F.lit(g)) for g in ("1M", "1q", "1y")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT o_orderstatus, CAST(epoch(max(o_orderdate) - min(o_orderdate)) / 60 AS BIGINT) + 1 AS bins, CAST(min(o_orderdate) AS TIMESTAMP) AS first,
  CAST(max(o_orderdate) AS TIMESTAMP) AS last, count(DISTINCT o_orderdate) AS filled FROM orders WHERE o_orderstatus = 'P' GROUP BY 1"""
)
def minute_gap_fill(t):
    """A calendar of minutes over all years of the orders."""
    one = t.orders.filter("o_orderstatus = 'P'").select("o_orderstatus", F.col("o_orderdate").alias("ts"), F.lit(1).cast("bigint").alias("n"))
    out = bars.resample(one, ["o_orderstatus"], "ts", "1m", {"n": "sum"}, fill_gaps=True)
    return out.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("bins"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(F.col("n") > 0).alias("filled")
    )


@query(
    """SELECT event_type AS location, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp, round(avg(sqrt(value)), 6) AS temperature,
  round(avg(sqrt(user_id)), 6) AS humidity FROM events GROUP BY 1, 2"""
)
def resample_weather(t):
    w = t.events.select(
        F.col("event_type").alias("location"), F.col("ts").alias("timestamp"), F.sqrt("value").alias("temperature"),
        F.sqrt("user_id").alias("humidity"),
    )
    return bars.resample(w, ["location"], "timestamp", "1h", bars.RULES["weather"])


@query(
    """WITH n AS (SELECT event_type AS series_id, ts AS timestamp, CASE WHEN value >= 5 THEN value END AS value FROM events)
SELECT series_id, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS timestamp,
  round(arg_max(value, CASE WHEN value IS NOT NULL THEN timestamp END), 6) AS value FROM n GROUP BY 1, 2"""
)
def resample_economic(t):
    e = t.events.select(
        F.col("event_type").alias("series_id"), F.col("ts").alias("timestamp"),
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
    )
    return bars.resample(e, ["series_id"], "timestamp", "1d", bars.RULES["economic"])


@query(
    """WITH g AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap FROM events),
m AS (SELECT user_id, median(gap) AS m FROM g WHERE gap IS NOT NULL GROUP BY 1)
SELECT user_id, round(m, 3) AS median_gap, CASE WHEN m <= 60 THEN '1m' WHEN m <= 300 THEN '5m' WHEN m <= 900 THEN '15m'
  WHEN m <= 1800 THEN '30m' WHEN m <= 3600 THEN '1h' WHEN m <= 86400 THEN '1d' WHEN m <= 604800 THEN '1w'
  WHEN m <= 2592000 THEN '1M' ELSE 'custom' END AS granularity FROM m"""
)
def granularity_detect(t):
    found = bars.granularity(t.events, series("user_id", "ts", "event_id"))
    return found.withColumn("median_gap", F.round("median_gap", 3))


@query(
    f"""WITH RECURSIVE {DAILY},
n AS (SELECT *, row_number() OVER {W} AS i FROM bars),
e AS (SELECT symbol, i, close AS e20, close AS e50 FROM n WHERE i = 1
  UNION ALL SELECT n.symbol, n.i, n.close * (2.0 / 21) + e.e20 * (1 - 2.0 / 21), n.close * (2.0 / 51) + e.e50 * (1 - 2.0 / 51)
  FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1),
r AS (SELECT *, (close / nullif(lag(close) OVER {W}, 0) - 1) * 100 AS ret, max(close) OVER {rows(100000000)} AS top FROM n)
SELECT symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume,
  round(top, 6) AS cumulative_max, round(ret, 6) AS daily_return,
  CASE WHEN count(close) OVER {rows(19)} = 20 THEN round(avg(close) OVER {rows(19)}, 6) END AS sma_20,
  CASE WHEN count(close) OVER {rows(49)} = 50 THEN round(avg(close) OVER {rows(49)}, 6) END AS sma_50,
  CASE WHEN count(close) OVER {rows(199)} = 200 THEN round(avg(close) OVER {rows(199)}, 6) END AS sma_200,
  CASE WHEN count(ret) OVER {rows(19)} = 20 THEN round(stddev_samp(ret) OVER {rows(19)} * sqrt(252.0), 6) END AS volatility_20d,
  round((close - top) / top * 100, 6) AS drawdown, round(e20, 6) AS ema_20, round(e50, 6) AS ema_50
FROM r JOIN e USING (symbol, i)"""
)
def ohlcv_daily_metrics(t):
    return features.asset_metrics(bars_of(t, "1d"), BAR, "index", rows_per_chunk=None)


@query(
    f"""WITH {HOURLY} SELECT {OHLCV}, round(close / nullif(lag(close) OVER {W}, 0) - 1, 6) AS returns,
  round(close * volume, 6) AS dollar_volume,
  CASE WHEN count(close) OVER {rows(19)} = 20 THEN round(avg(close) OVER {rows(19)}, 6) END AS sma_20,
  CASE WHEN count(close) OVER {rows(49)} = 50 THEN round(avg(close) OVER {rows(49)}, 6) END AS sma_50 FROM bars"""
)
def stock_metrics(t):
    return features.asset_metrics(bars_of(t, "1h"), BAR, "stock", rows_per_chunk=None)


@query(
    f"""WITH {HOURLY}, r AS (SELECT *, ln(close / nullif(lag(close) OVER {W}, 0)) AS lr FROM bars),
m AS (SELECT *, count(*) OVER {rows(9)} AS n, covar_pop(close, volume) OVER {rows(9)} AS cv,
  stddev_pop(close) OVER {rows(9)} * stddev_pop(volume) OVER {rows(9)} AS sd FROM r)
SELECT {OHLCV}, round(lr, 6) AS log_returns,
  CASE WHEN count(lr) OVER {rows(19)} = 20 THEN round(stddev_samp(lr) OVER {rows(19)} * sqrt(365.0), 6) END AS volatility_20d,
  CASE WHEN n = 10 THEN round(cv / nullif(sd, 0), 6) END AS market_sentiment FROM m"""
)
def crypto_metrics(t):
    return features.asset_metrics(bars_of(t, "1h"), BAR, "crypto", rows_per_chunk=None)


@query(
    f"""WITH {HOURLY} SELECT {OHLCV}, round(low, 6) AS bid, round(high, 6) AS ask,
  round((close / nullif(lag(close) OVER {W}, 0) - 1) * 100, 6) AS pct_change,
  round(high - low, 6) AS spread, round((high - low) * 10000, 6) AS spread_pips FROM bars"""
)
def forex_metrics(t):
    quoted = bars_of(t, "1h").withColumns({"bid": F.col("low"), "ask": F.col("high")})
    return features.asset_metrics(quoted, BAR, "forex", rows_per_chunk=None)


@query(
    f"""WITH {HOURLY}, r AS (SELECT *, close / nullif(lag(close) OVER {W}, 0) - 1 AS ret FROM bars)
SELECT {OHLCV}, round(close, 6) AS nav, round(ret, 6) AS daily_return,
  CASE WHEN count(ret) OVER {rows(19)} = 20 THEN round(stddev_samp(ret) OVER {rows(19)} * sqrt(252.0), 6) END AS volatility_20d,
  CASE WHEN count(volume) OVER {rows(9)} = 10 THEN round(volume / avg(volume) OVER {rows(9)}, 6) END AS volume_trend FROM r"""
)
def etf_metrics(t):
    return features.asset_metrics(bars_of(t, "1h"), BAR, "etf", rows_per_chunk=None)


_LAGS = ", ".join(f"round(lag(close, {k}) OVER {W}, 6) AS close_lag_{k}" for k in features.LAGS)
_ROLL = ", ".join(
    f"round(avg(close) OVER {rows(n - 1)}, 6) AS close_ma_{n}, "
    f"CASE WHEN count(close) OVER {rows(n - 1)} >= 2 THEN round(stddev_samp(close) OVER {rows(n - 1)}, 6) END AS close_std_{n}"
    for n in features.WINDOWS
)


@query(
    f"""WITH {DAILY} SELECT {OHLCV}, {_LAGS}, {_ROLL},
  round(close / nullif(lag(close, 1) OVER {W}, 0) - 1, 6) AS close_pct_change_1,
  round(close / nullif(lag(close, 7) OVER {W}, 0) - 1, 6) AS close_pct_change_7, round(high - low, 6) AS close_range,
  isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month, month(ts) AS month, quarter(ts) AS quarter, year(ts) AS year,
  CAST(ts AS DATE) = last_day(ts) AS is_month_end,
  CAST(ts AS DATE) = last_day(ts) AND month(ts) IN (3, 6, 9, 12) AS is_quarter_end FROM bars"""
)
def ts_features(t):
    return features.time_features(bars_of(t, "1d"), BAR, "close", rows_per_chunk=None)


@query(
    f"""WITH RECURSIVE {HOURLY}, n AS (SELECT *, row_number() OVER {W} AS i FROM bars),
e AS (SELECT symbol, i, close AS e20, close AS e50 FROM n WHERE i = 1
  UNION ALL SELECT n.symbol, n.i, n.close * (2.0 / 21) + e.e20 * (1 - 2.0 / 21), n.close * (2.0 / 51) + e.e50 * (1 - 2.0 / 51)
  FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1)
SELECT n.symbol, n.ts, round(close, 6) AS close, round(e20, 6) AS ema_20, round(e50, 6) AS ema_50
FROM n JOIN e ON e.symbol = n.symbol AND e.i = n.i"""
)
def ema(t):
    out = features.ema(bars_of(t, "1h"), BAR, "close", (20, 50), rows_per_chunk=None)
    return out.select("symbol", "ts", "close", "ema_20", "ema_50")


# --- row windows straight over the ticks ----------------------------------------------------------

TICK = series("symbol", "ts", "event_id")
GAPPY = "g AS (SELECT event_type AS symbol, ts, event_id, CASE WHEN value >= 5 THEN value END AS v FROM events)"
TW = "PARTITION BY symbol ORDER BY ts, event_id"


def gappy(t: Tables) -> DataFrame:
    return ticks(t).select("symbol", "ts", "event_id", F.when(F.col("value") >= 5, F.col("value")).alias("v"))


@query(
    f"""WITH {GAPPY} SELECT symbol, ts, event_id, round(coalesce(
  last_value(v IGNORE NULLS) OVER ({TW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER ({TW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS v FROM g"""
)
def ffill_bfill(t):
    return clean.fill_both_ways(gappy(t), TICK, ["v"])


@query(
    f"""SELECT event_type AS symbol, event_id, round(max(value) OVER ({TW.replace("symbol", "event_type")}), 6) AS top
FROM events"""
)
def running_max(t):
    return running(ticks(t), TICK, {"top": ("max", "value")}).select("symbol", "event_id", "top")


@query(
    f"""WITH {GAPPY} SELECT symbol, event_id, round(lag(v, 1) OVER ({TW}), 6) AS lag_1, round(lag(v, 7) OVER ({TW}), 6) AS lag_7,
  round(avg(v) OVER ({TW} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS ma_30 FROM g"""
)
def tick_windows(t):
    return over_series(gappy(t), TICK, _tick_steps, 30).select("symbol", "event_id", "lag_1", "lag_7", "ma_30")


def _tick_steps(frame, part):
    w = part.window()
    return frame.withColumns(
        {"lag_1": F.lag("v", 1).over(w), "lag_7": F.lag("v", 7).over(w), "ma_30": features.rolling("v", w, 30)}
    )


# The same over series that count as too long for one task, so that they are cut into chunks.
CUT = 1000


@query(
    f"""WITH {GAPPY} SELECT symbol, event_id, round(lag(v, 1) OVER ({TW}), 6) AS lag_1, round(lag(v, 7) OVER ({TW}), 6) AS lag_7,
  round(avg(v) OVER ({TW} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS ma_30 FROM g"""
)
def cut_windows(t):
    out = over_series(gappy(t), TICK, _tick_steps, 30, rows_per_chunk=CUT)
    return out.select("symbol", "event_id", "lag_1", "lag_7", "ma_30")


@query(
    f"""WITH {GAPPY} SELECT symbol, event_id, round(coalesce(
  last_value(v IGNORE NULLS) OVER ({TW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER ({TW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS v FROM g"""
)
def cut_fills(t):
    return clean.fill_both_ways(gappy(t), TICK, ["v"], rows_per_chunk=CUT).select("symbol", "event_id", "v")


@query(
    f"""WITH RECURSIVE {HOURLY}, n AS (SELECT *, row_number() OVER {W} AS i FROM bars),
e AS (SELECT symbol, i, close AS e20, close AS e50 FROM n WHERE i = 1
  UNION ALL SELECT n.symbol, n.i, n.close * (2.0 / 21) + e.e20 * (1 - 2.0 / 21), n.close * (2.0 / 51) + e.e50 * (1 - 2.0 / 51)
  FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1),
r AS (SELECT *, max(close) OVER {rows(100000000)} AS top FROM n)
SELECT symbol, ts, round((close - top) / top * 100, 6) AS drawdown,
  CASE WHEN count(close) OVER {rows(199)} = 200 THEN round(avg(close) OVER {rows(199)}, 6) END AS sma_200,
  round(e20, 6) AS ema_20, round(e50, 6) AS ema_50 FROM r JOIN e USING (symbol, i)"""
)
def cut_index_metrics(t):
    # Shorter chunks than the longest look-back are widened to it.
    out = features.asset_metrics(bars_of(t, "1h"), BAR, "index", rows_per_chunk=100)
    return out.select("symbol", "ts", "drawdown", "sma_200", "ema_20", "ema_50")


def _ema_sql(span: int, alpha: str) -> str:
    """The recursive average over the observations of ``o``, where an old value fades with every row."""
    fade = f"greatest(pow(1 - {alpha}, o.i - e.i), 1e-30)"
    return f"""e{span} AS (SELECT symbol, i, j, v AS y FROM o WHERE j = 1
  UNION ALL SELECT o.symbol, o.i, o.j, ({fade} * e.y + {alpha} * o.v) / ({fade} + {alpha}) FROM e{span} e JOIN o ON o.symbol = e.symbol AND o.j = e.j + 1)"""


SPARSE = "CASE WHEN event_id % 37 = 0 THEN value END"


@query(
    f"""WITH RECURSIVE n AS (SELECT event_type AS symbol, event_id, {SPARSE} AS v,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY i) AS j FROM n WHERE v IS NOT NULL),
{_ema_sql(3, "0.5")}, {_ema_sql(20, "(2.0 / 21)")},
last AS (SELECT symbol, event_id, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY symbol ORDER BY i) AS i FROM n)
SELECT l.symbol, l.event_id, round(a.y, 6) AS ema_3, round(b.y, 6) AS ema_20
FROM last l LEFT JOIN e3 a ON a.symbol = l.symbol AND a.i = l.i LEFT JOIN e20 b ON b.symbol = l.symbol AND b.i = l.i"""
)
def cut_ema(t):
    """Values far apart, also over whole chunks without one."""
    rows_ = ticks(t).withColumn("v", F.when(F.col("event_id") % 37 == 0, F.col("value")))
    return features.ema(rows_, TICK, "v", (3, 20), rows_per_chunk=25).select("symbol", "event_id", "ema_3", "ema_20")


# Times as unlike as they come: one far off, many equal ones, some missing.
UNEVEN = """u AS (SELECT event_type AS symbol, event_id, value, CASE WHEN event_id = 7 THEN ts + INTERVAL 40000 DAY WHEN event_id % 11 = 0 THEN NULL
  WHEN event_id % 3 > 0 THEN TIMESTAMP '2024-01-15 00:00:00' ELSE ts END AS ts FROM events)"""
UW = "PARTITION BY symbol ORDER BY ts NULLS FIRST, event_id"


def uneven(t: Tables) -> DataFrame:
    moved = F.when(F.col("event_id") == 7, F.col("ts") + F.expr("interval 40000 days")).when(F.col("event_id") % 11 > 0, F.col("ts"))
    same = F.when((F.col("event_id") != 7) & (F.col("event_id") % 11 > 0) & (F.col("event_id") % 3 > 0), F.lit("2024-01-15").cast("timestamp_ntz"))
    return ticks(t).select("symbol", "event_id", "value", F.coalesce(same, moved.cast("timestamp_ntz")).alias("ts"))


@query(
    f"""WITH {UNEVEN} SELECT symbol, event_id, round(lag(value, 7) OVER ({UW}), 6) AS lag_7, round(lead(value, 3) OVER ({UW}), 6) AS lead_3,
  round(max(value) OVER ({UW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS top FROM u"""
)
def cut_uneven_times(t):
    def steps(frame, part):
        w = part.window()
        return frame.withColumns({"lag_7": F.lag("value", 7).over(w), "lead_3": F.lead("value", 3).over(w)})

    cut = over_series(uneven(t), TICK, steps, 7, 3, rows_per_chunk=CUT)
    return running(cut, TICK, {"top": ("max", "value")}, rows_per_chunk=CUT).select("symbol", "event_id", "lag_7", "lead_3", "top")


@query(
    f"""WITH {UNEVEN}, c AS (SELECT symbol, count(*) AS n FROM u GROUP BY 1)
SELECT symbol, n AS n_rows, CASE WHEN n > 64 THEN CAST(ceil(n / 64.0) AS BIGINT) ELSE 1 END AS chunks, least(n, 64) AS largest FROM c"""
)
def cut_chunk_sizes(t):
    rows_, _ = in_chunks(uneven(t), TICK, 64)
    sizes = rows_.groupBy("symbol", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("symbol").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("chunks"), F.max("n").alias("largest"))


@query(
    f"""SELECT event_type AS symbol, event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id)) / 1e6, 6) AS gap
FROM events"""
)
def tick_gaps(t):
    return bars.gaps(ticks(t), TICK).select("symbol", "event_id", "gap")


# --- the row-window part of the catalogue ---------------------------------------------------------


@query(
    f"""WITH {HOURLY} SELECT {OHLCV}, round(avg(close) OVER {rows(6)}, 6) AS ma_7, round(avg(close) OVER {rows(19)}, 6) AS ma_20,
  round(avg(close) OVER {rows(29)}, 6) AS ma_30 FROM bars"""
)
def moving_avg(t):
    return catalogue.moving_averages(bars_of(t, "1h"), BAR, "close")


@query(
    f"""WITH {HOURLY}, p AS (SELECT *, lag(close) OVER {W} AS b FROM bars) SELECT {OHLCV}, round(b, 6) AS prev_value,
  round(close - b, 6) AS change_pts, round((close / nullif(b, 0) - 1) * 100, 6) AS change_pct FROM p"""
)
def lag_change(t):
    return catalogue.changes(bars_of(t, "1h"), BAR, "close")


@query(f"WITH {HOURLY} SELECT {OHLCV}, round(avg(high - low) OVER {rows(19)}, 6) AS avg_range_20 FROM bars")
def avg_range_20(t):
    return catalogue.average_range(bars_of(t, "1h"), BAR)


@query(
    f"""WITH {HOURLY}, p AS (SELECT *, lag(close) OVER {W} AS b FROM bars),
r AS (SELECT *, greatest(high - low, abs(high - b), abs(low - b)) AS tr FROM p)
SELECT {OHLCV}, round(tr, 6) AS true_range, round(avg(tr) OVER {rows(13)}, 6) AS atr_14 FROM r"""
)
def atr_14(t):
    return catalogue.average_true_range(bars_of(t, "1h"), BAR)


@query(
    f"""WITH {HOURLY}, m AS (SELECT *, avg(volume) OVER {rows(19)} AS m FROM bars)
SELECT {OHLCV}, round(m, 6) AS ma_20_volume FROM m WHERE volume > 1.5 * m"""
)
def high_volume_bars(t):
    return catalogue.high_volume(bars_of(t, "1h"), BAR)


@query(
    f"""WITH {HOURLY}, m AS (SELECT *, avg(volume) OVER {rows(30, "1 PRECEDING")} AS m FROM bars)
SELECT {OHLCV}, CASE WHEN close > open * 1.5 THEN 'large_gain' WHEN close < open * 0.5 THEN 'large_loss'
  WHEN volume > m * 10 THEN 'high_volume' END AS anomaly_type FROM m"""
)
def volume_anomaly(t):
    return catalogue.anomalous_values(bars_of(t, "1h"), BAR)


@query(
    """SELECT event_type AS pipeline_id, event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
  ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS moving_avg_8 FROM events"""
)
def duration_ma(t):
    runs = t.events.withColumnRenamed("event_type", "pipeline_id")
    out = catalogue.duration_trend(runs, series("pipeline_id", "ts", "event_id"), "value")
    return out.select("pipeline_id", "event_id", "moving_avg_8")


@query(
    f"""WITH {HOURLY}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS k,
  lag(close) OVER {W} AS b FROM bars)
SELECT symbol, ts, round(close, 6) AS latest_rate, round(b, 6) AS prev_close, round((close / b - 1) * 100, 6) AS change_pct FROM r WHERE k = 1"""
)
def latest_change(t):
    return catalogue.latest_change(bars_of(t, "1h"), ["symbol"], "ts", "close")
