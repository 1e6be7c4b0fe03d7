"""Payload readers, sinks, streams and whole jobs over the driver tables.

Payloads are built from ``events`` in fixed-size blocks of consecutive ids, as a vendor pages its
answers, so no payload grows with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.base import Tables, query
from tidemark.checks.series_queries import HOURLY, bars_of
from tidemark.plans import jobs
from tidemark.session import shared_folder
from tidemark.sinks import tables as sinks
from tidemark.sources import payloads
from tidemark.streaming import streams

BLOCK = 64


def scratch(t: Tables, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def seconds() -> Column:
    return F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000)


def blocks(t: Tables, record: Column, wrap) -> DataFrame:
    """One payload per symbol and block of ids: at most ``BLOCK`` records each."""
    rows = t.events.select(
        F.col("event_type").alias("item"), F.floor(F.col("event_id") / BLOCK).alias("block"), "event_id", record.alias("record")
    )
    grouped = rows.groupBy("item", "block").agg(F.sort_array(F.collect_list(F.struct("event_id", "record"))).alias("r"))
    records = F.transform("r", lambda x: x.getField("record"))
    return grouped.select("item", wrap(records).alias("payload"))


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- payloads --------------------------------------------------------------------------------------------

_EVENT = "event_type AS symbol, date_trunc('second', ts)::TIMESTAMP AS timestamp"


def bar_payloads(t: Tables, price: Column, close: Column) -> DataFrame:
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        text(price).alias("open"), text(price).alias("high"), text(price).alias("low"), text(close).alias("close"),
        text("user_id").alias("volume"),
    )
    wrap = lambda r: F.to_json(
        F.struct(F.create_map(F.lit("currency"), F.lit("USD"), F.lit("interval"), F.lit("1min")).alias("meta"), r.alias("values"))
    )
    return blocks(t, record, wrap)


@query(
    f"""SELECT {_EVENT}, round(value, 6) AS open, round(CASE WHEN value <= 100 THEN value END, 6) AS close, CAST(user_id AS DOUBLE) AS volume,
  'USD' AS currency, '1min' AS "interval", 'stock' AS asset_type FROM events"""
)
def payload_bars(t):
    unreadable = F.when(F.col("value") > 100, "n/a").otherwise(text("value"))
    rows = payloads.bars(bar_payloads(t, F.col("value"), unreadable), asset_type="stock")
    return rows.select("symbol", "timestamp", "open", "close", "volume", "currency", "interval", "asset_type")


@query(f"SELECT {_EVENT}, round(value, 6) AS open, round(value / 2, 6) AS low, CAST(user_id AS DOUBLE) AS volume FROM events")
def payload_candles(t):
    record = F.struct(text(seconds()).alias("t"), "value", (F.col("value") / 2).alias("half"), "user_id")
    part = lambda r, f: F.transform(r, lambda x: x.getField(f))
    wrap = lambda r: F.to_json(
        F.struct(
            F.lit("ok").alias("s"), part(r, "t").alias("t"), part(r, "value").alias("o"), part(r, "value").alias("h"),
            part(r, "half").alias("l"), part(r, "value").alias("c"), part(r, "user_id").alias("v"),
        )
    )
    rows = payloads.candles(blocks(t, record, wrap)).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "open", "low", "volume")


@query(
    """SELECT event_type AS symbol, date_trunc('milliseconds', ts)::TIMESTAMP AS timestamp, round(value, 6) AS close, CAST(user_id AS DOUBLE) AS volume,
  event_id AS trades, 'binance' AS exchange FROM events"""
)
def payload_klines(t):
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    v = text("value")
    record = F.array(text(millis), v, v, v, v, text("user_id"), text(millis), v, text("event_id"), F.lit("0"), F.lit("0"), F.lit("0"))
    rows = payloads.klines(blocks(t, record, F.to_json)).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "close", "volume", "trades", "exchange")


@query(
    """SELECT event_type AS symbol, date_trunc('second', ts)::TIMESTAMP AS timestamp, round(value, 6) AS open, user_id AS tick_volume,
  CASE WHEN value > 50 AND user_id > 0 THEN user_id END AS real_volume, substr(event_type, 1, 3) AS from_currency, substr(event_type, 4) AS to_currency FROM events"""
)
def payload_terminal(t):
    v = F.col("value")
    real = F.when(v > 50, F.col("user_id")).otherwise(0).cast("double")
    record = F.array(seconds().cast("double"), v, v, v, v, F.col("user_id").cast("double"), F.lit(1.0), real)
    wrap = lambda r: F.to_json(F.transform(r, lambda x: F.transform(x, lambda n: F.when(n == F.floor(n), text(n.cast("bigint"))).otherwise(text(n)))))
    rows = payloads.terminal_candles(blocks(t, record, wrap)).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "open", "tick_volume", "real_volume", "from_currency", "to_currency")


@query("SELECT event_type AS series_id, CAST(ts AS DATE) AS date, round(value, 6) AS value FROM events WHERE value BETWEEN 5 AND 100")
def payload_observations(t):
    """Small values are the missing marker, large ones do not parse."""
    value = F.when(F.col("value") < 5, ".").when(F.col("value") > 100, "bad").otherwise(text("value"))
    day = F.date_format("ts", "yyyy-MM-dd")
    record = F.struct(day.alias("date"), value.alias("value"), day.alias("realtime_start"), day.alias("realtime_end"))
    raw = blocks(t, record, lambda r: F.to_json(F.struct(r.alias("observations"))))
    return payloads.observations(raw).select(F.col("item").alias("series_id"), "date", "value")


@query("SELECT event_type AS item, CAST(ts AS DATE)::VARCHAR AS date, 'bad' AS value FROM events WHERE value > 100")
def payload_rejects(t):
    value = F.when(F.col("value") < 5, ".").when(F.col("value") > 100, "bad").otherwise(text("value"))
    record = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), value.alias("value"))
    raw = blocks(t, record, lambda r: F.to_json(F.struct(r.alias("observations"))))
    return payloads.observation_rejects(raw)


@query(
    """SELECT event_type AS symbol, date_trunc('milliseconds', ts)::TIMESTAMP AS timestamp, round(value, 6) AS close,
  CAST(CASE WHEN value > 20 THEN user_id ELSE 0 END AS DOUBLE) AS volume, event_id AS transactions FROM events"""
)
def payload_aggregates(t):
    millis = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    v = F.col("value")
    record = F.struct(
        millis.alias("t"), v.alias("o"), v.alias("h"), v.alias("l"), v.alias("c"),
        F.when(v > 20, F.col("user_id")).alias("v"), F.col("event_id").alias("n"),
    )
    raw = blocks(t, record, lambda r: F.to_json(F.struct(r.alias("results"))))
    rows = payloads.aggregates(raw, forex=True).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "close", "volume", "transactions")


@query(
    """SELECT o_custkey AS item, CAST(o_orderdate AS DATE) AS date, round(max(o_totalprice), 4) AS open, round(max(o_totalprice) / 2, 4) AS close,
  count(*) AS volume FROM orders GROUP BY 1, 2"""
)
def payload_dated_series(t):
    """A map keyed by date per customer and year, so its size is bounded by the calendar."""
    day = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(
        F.max("o_totalprice").alias("o"), F.count(F.lit(1)).alias("n")
    )
    bar = F.create_map(
        F.lit("1. open"), text("o"), F.lit("2. high"), text("o"), F.lit("3. low"), text("o"),
        F.lit("4. close"), text(F.col("o") / 2), F.lit("5. volume"), text("n"),
    )
    entry = F.struct(F.date_format("d", "yyyy-MM-dd").alias("k"), bar.alias("v"))
    grouped = day.groupBy(F.col("o_custkey").alias("item"), F.year("d").alias("y")).agg(F.collect_list(entry).alias("e"))
    raw = grouped.select("item", F.to_json(F.create_map(F.lit("Time Series (Daily)"), F.map_from_entries("e"))).alias("payload"))
    rows = payloads.dated_series(raw)
    return rows.select("item", "date", F.round("open", 4).alias("open"), F.round("close", 4).alias("close"), "volume")


@query(
    """SELECT event_id, event_type AS symbol, round(value, 6) AS close, round(value / 2, 6) AS percent_change, round(value * 2, 6) AS week_high,
  concat(value, ' - ', user_id) AS week_range, user_id AS base_volume FROM events""".replace(", user_id AS base_volume", "")
)
def payload_quotes(t):
    week = F.struct(text(F.col("value") * 2).alias("high"), text("value").alias("low"), F.concat(text("value"), F.lit(" - "), text("user_id")).alias("range"))
    body = F.to_json(
        F.struct(
            F.col("event_type").alias("symbol"), text("value").alias("close"), text(F.col("value") / 2).alias("percent_change"),
            week.alias("fifty_two_week"),
        )
    )
    rows = payloads.quotes(t.events.select("event_id", body.alias("payload")))
    return rows.select("event_id", "symbol", "close", "percent_change", "week_high", "week_range")


@query("SELECT event_id, round(value, 6) AS current_price, round(value / 2, 6) AS previous_close, 0.0::DOUBLE AS volume FROM events WHERE value >= 5")
def payload_short_quotes(t):
    body = F.when(F.col("value") < 5, "{}").otherwise(
        F.to_json(F.struct(F.col("value").alias("c"), (F.col("value") / 2).alias("pc")))
    )
    rows = payloads.short_quotes(t.events.select("event_id", body.alias("payload")))
    return rows.select("event_id", "current_price", "previous_close", "volume")


@query(
    """SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS timestamp, round(value, 6) AS temperature, CAST(user_id AS DOUBLE) AS humidity,
  round(CASE WHEN value > 50 THEN value / 10 END, 6) AS rain_1h, event_type AS weather_main, 'GB' AS country FROM events WHERE value <= 120"""
)
def payload_weather(t):
    v = F.col("value")
    body = F.struct(
        F.when(v > 120, "404").otherwise("200").alias("cod"),
        seconds().alias("dt"),
        F.struct(v.alias("temp"), F.col("user_id").alias("humidity")).alias("main"),
        F.when(v > 50, F.struct((v / 10).alias("1h"))).alias("rain"),
        F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
        F.struct(F.lit("GB").alias("country")).alias("sys"),
    )
    rows = payloads.current_weather(t.events.select("event_id", F.to_json(body).alias("payload")))
    return rows.select("event_id", "timestamp", "temperature", "humidity", "rain_1h", "weather_main", "country")


@query(
    f"SELECT {_EVENT}, round(value, 6) AS temperature, round(value / 3, 6) AS wind_speed, event_type AS weather_main, '3hour' AS forecast_type FROM events"
)
def payload_forecast(t):
    record = F.struct(
        seconds().alias("dt"), F.struct(F.col("value").alias("temp")).alias("main"),
        F.struct((F.col("value") / 3).alias("speed")).alias("wind"), F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
    )
    wrap = lambda r: F.to_json(F.struct(F.lit("200").alias("cod"), F.struct(F.lit("GB").alias("country")).alias("city"), r.alias("list")))
    rows = payloads.forecast(blocks(t, record, wrap)).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "temperature", "wind_speed", "weather_main", "forecast_type")


@query(f"SELECT {_EVENT}, user_id AS aqi, round(value, 6) AS pm2_5 FROM events")
def payload_pollution(t):
    record = F.struct(
        seconds().alias("dt"), F.struct(F.col("user_id").alias("aqi")).alias("main"), F.struct(F.col("value").alias("pm2_5")).alias("components")
    )
    rows = payloads.air_pollution(blocks(t, record, lambda r: F.to_json(F.struct(r.alias("list"))))).withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "aqi", "pm2_5")


@query("SELECT page_id AS news_id, url, length(html) AS size, 'general' AS category, 'en' AS lang, false AS has_paywall FROM pages")
def payload_news(t):
    item = F.struct(F.col("page_id").alias("id"), "url", F.col("html").alias("summary"))
    raw = t.pages.select(F.to_json(F.array(item)).alias("payload"))
    rows = payloads.news(raw)
    return rows.select("news_id", "url", F.length("summary").alias("size"), "category", "lang", "has_paywall")


@query(
    """SELECT p_partkey, concat('P', p_partkey) AS symbol, p_name AS name, 'etf' AS asset_type, CASE WHEN contains(p_name, 'ark') THEN 'innovative' ELSE 'other' END
  AS category FROM part"""
)
def payload_symbols(t):
    item = F.struct(F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.col("p_name").alias("name"), F.lit("x").alias("type"))
    raw = t.part.select("p_partkey", F.to_json(F.struct(F.array(item).alias("data"))).alias("payload"))
    return payloads.symbols(raw, "etf").select("p_partkey", "symbol", "name", "asset_type", "category")


@query(
    """SELECT CASE WHEN value > 200 THEN 'unparsable' WHEN value > 100 THEN 'rate_limit' ELSE 'api_error' END AS error_kind, count(*) AS n
FROM events WHERE value > 60 GROUP BY 1"""
)
def payload_errors(t):
    v = F.col("value")
    body = (
        F.when(v > 200, "{broken").when(v > 100, '{"code":429,"message":"slow down"}').when(v > 60, '{"code":400}').otherwise('{"code":200}')
    )
    _, bad = payloads.split_errors(t.events.select("event_id", body.alias("payload")))
    return bad.groupBy("error_kind").agg(F.count(F.lit(1)).alias("n"))


# The records below carry one event each.


def one_each(t: Tables, body: Column) -> DataFrame:
    return t.events.select("event_id", F.col("event_type").alias("item"), F.to_json(body).alias("payload"))


@query(
    """SELECT event_id, event_type AS company_name, round(value, 6) AS market_cap, CAST(ts AS DATE) AS ipo_date, 'USD' AS currency FROM events"""
)
def payload_profiles(t):
    body = F.struct(F.col("event_type").alias("name"), F.col("value").alias("marketCapitalization"), F.date_format("ts", "yyyy-MM-dd").alias("ipo"))
    return payloads.profiles(one_each(t, body)).select("event_id", "company_name", "market_cap", "ipo_date", "currency")


@query(
    f"""SELECT {_EVENT}, event_id, round(value, 6)::VARCHAR AS actual FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND date_trunc('second', ts) <= TIMESTAMP '2024-01-20'"""
)
def payload_calendar(t):
    record = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("event"), text("value").alias("actual"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
    )
    raw = blocks(t, record, lambda r: F.to_json(F.struct(r.alias("economicCalendar"))))
    start, end = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20").cast("timestamp")
    rows = payloads.calendar(raw, start, end)
    return rows.select(F.col("item").alias("symbol"), F.col("date").alias("timestamp"), F.col("event_id").cast("bigint").alias("event_id"), "actual")


@query("SELECT p_partkey::VARCHAR AS series_id, p_name AS title, p_size AS popularity, p_type AS frequency FROM part")
def payload_series_list(t):
    """Part lists in blocks, as search results."""
    record = F.struct(text("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_size").alias("popularity"), F.col("p_type").alias("frequency"))
    grouped = t.part.groupBy(F.floor(F.col("p_partkey") / BLOCK).alias("block")).agg(F.collect_list(record).alias("seriess"))
    raw = grouped.select(F.to_json(F.struct("seriess")).alias("payload"))
    return payloads.series_list(raw).select("series_id", "title", "popularity", "frequency")


@query("SELECT min(p_partkey)::VARCHAR AS series_id FROM part GROUP BY p_partkey // 64")
def payload_series_info(t):
    """The first series of each block."""
    grouped = t.part.groupBy(F.floor(F.col("p_partkey") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("p_partkey"))).alias("r")
    )
    ids = F.transform("r", lambda x: F.struct(x.getField("p_partkey").cast("string").alias("id")))
    return payloads.series_info(grouped.select(F.to_json(F.struct(ids.alias("seriess"))).alias("payload"))).select("series_id")


@query("SELECT concat('P', p_partkey) AS symbol, p_name AS name, p_size > 25 AS active FROM part")
def payload_tickers(t):
    """Large parts as single details, the others as search results."""
    one = F.struct(F.concat(F.lit("P"), "p_partkey").alias("ticker"), F.col("p_name").alias("name"), (F.col("p_size") > 25).alias("active"))
    body = F.when(F.col("p_size") > 25, F.to_json(F.struct(one.alias("results")))).otherwise(F.to_json(F.struct(F.array(one).alias("results"))))
    return payloads.tickers(t.part.select(body.alias("payload"))).select("symbol", "name", "active")


@query(
    """SELECT event_id, n AS day, round(value + n, 6) AS temp_day, round(value, 6) AS uvi, CAST(ts AS DATE) AS date FROM events, unnest([1, 2, 3]) AS u(n)"""
)
def payload_daily_forecast(t):
    """Four days delivered, three asked for."""
    day = lambda n: F.struct(
        seconds().alias("dt"), F.struct((F.col("value") + n).alias("day"), F.lit(n).alias("min")).alias("temp"), F.col("value").alias("uvi")
    )
    rows = payloads.daily_forecast(one_each(t, F.struct(F.array(*[day(n) for n in (1, 2, 3, 4)]).alias("daily"))), days=3)
    return rows.select("event_id", F.col("temp_min").cast("bigint").alias("day"), "temp_day", "uvi", "date")


@query(
    """SELECT event_id, 'historical' AS data_type, round(value, 6) AS temperature, NULL::DOUBLE AS rain_1h FROM events
UNION ALL SELECT event_id, 'historical_hourly', round(value / 2, 6), round(CASE WHEN value > 50 THEN value / 10 END, 6) FROM events"""
)
def payload_historical(t):
    rain = F.when(F.col("value") > 50, F.struct((F.col("value") / 10).alias("1h")))
    hour = F.struct(seconds().alias("dt"), (F.col("value") / 2).alias("temp"), rain.alias("rain"))
    body = F.struct(F.struct(seconds().alias("dt"), F.col("value").alias("temp")).alias("current"), F.array(hour).alias("hourly"))
    return payloads.historical_weather(one_each(t, body)).select("event_id", "data_type", "temperature", "rain_1h")


@query("SELECT event_id, round(value, 6) AS latitude, round(value / 2, 6) AS longitude FROM events WHERE value > 5")
def payload_places(t):
    place = F.struct(F.col("event_type").alias("name"), F.col("value").alias("lat"), (F.col("value") / 2).alias("lon"))
    body = F.when(F.col("value") > 5, F.to_json(F.array(place))).otherwise("[]")
    return payloads.places(t.events.select("event_id", body.alias("payload"))).select("event_id", "latitude", "longitude")


@query("SELECT event_id, user_id AS spread, round(value, 6) AS bid, round(value * 2, 6) AS max_volume FROM events")
def payload_symbol_records(t):
    body = F.struct(F.col("user_id").alias("spread"), F.lit(0.1).alias("point"), F.col("value").alias("bid"), (F.col("value") * 2).alias("volume_max"))
    return payloads.symbol_records(one_each(t, body)).select("event_id", "spread", "bid", "max_volume")


@query("SELECT event_id, concat(event_type, '/USD') AS pair, round(value, 6) AS rate, date_trunc('second', ts)::TIMESTAMP AS timestamp FROM events")
def payload_spot_rates(t):
    inner = F.create_map(
        F.lit("1. From_Currency Code"), F.col("event_type"), F.lit("3. To_Currency Code"), F.lit("USD"),
        F.lit("5. Exchange Rate"), text("value"), F.lit("6. Last Refreshed"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    )
    raw = one_each(t, F.struct(inner.alias("Realtime Currency Exchange Rate")))
    return payloads.spot_rates(raw).select("event_id", "pair", "rate", "timestamp")


@query("SELECT event_id, event_type AS symbol, round(value, 6) AS last_price, user_id AS trades FROM events")
def payload_day_tickers(t):
    one = F.struct(F.col("event_type").alias("symbol"), text("value").alias("lastPrice"), F.col("user_id").alias("count"))
    body = F.when(F.col("value") > 50, F.to_json(one)).otherwise(F.to_json(F.array(one)))
    return payloads.day_tickers(t.events.select("event_id", body.alias("payload"))).select("event_id", "symbol", "last_price", "trades")


@query(f"SELECT {_EVENT}, round(value, 6) AS open, round(value + 2, 6) AS high, round(value - 2, 6) AS low, 3600 AS granularity_seconds FROM events")
def payload_exchange_candles(t):
    v = F.col("value")
    record = F.array(text(seconds()), text(v - 2), text(v + 2), text(v), text(v), text("user_id"))
    rows = payloads.exchange_candles(blocks(t, record, F.to_json), "1h").withColumnRenamed("item", "symbol")
    return rows.select("symbol", "timestamp", "open", "high", "low", "granularity_seconds")


@query("SELECT event_id, round(value, 6) AS price, CASE WHEN value > 20 THEN date_trunc('second', ts)::TIMESTAMP END AS time FROM events")
def payload_exchange_tickers(t):
    stamp = F.when(F.col("value") > 20, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    body = F.struct(text("value").alias("price"), stamp.alias("time"))
    return payloads.exchange_tickers(one_each(t, body)).select("event_id", "price", "time")


_REGION = "CASE WHEN user_id < 50 THEN 'N225' WHEN user_id < 100 THEN 'FTSE' ELSE 'OTHER' END"


@query(
    f"""WITH q AS (SELECT event_id, {_REGION} AS symbol, round(value - 40, 6) AS percent_change FROM events)
SELECT event_id, symbol, percent_change, CASE symbol WHEN 'N225' THEN 'Japan' WHEN 'FTSE' THEN 'UK' ELSE 'Unknown' END AS region,
  CASE WHEN (SELECT count_if(percent_change > 0) > count(*) / 2.0 FROM q) THEN 'Positive' ELSE 'Negative' END AS market_sentiment FROM q"""
)
def index_summary(t):
    """Index quotes with region and market mood."""
    user = F.col("user_id")
    symbol = F.when(user < 50, "N225").when(user < 100, "FTSE").otherwise("OTHER")
    body = F.struct(symbol.alias("symbol"), text(F.round(F.col("value") - 40, 6)).alias("percent_change"))
    rows = jobs.market_summary(one_each(t, body))
    return rows.select("event_id", "symbol", "percent_change", "region", "market_sentiment")


# --- sinks -------------------------------------------------------------------------------------------------


def order_prices(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("seq")
    )
    return sinks.by_period(rows, "date", "year")[0]


def line_prices(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("value"),
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("seq"), "l_partkey",
    )
    return sinks.by_period(rows, "date", "year")[0]


LINE_ORDER = ["seq", "l_partkey", "value"]
_OLD = """o AS (SELECT symbol, date, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq {0}) AS k FROM (
  SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, o_orderkey AS seq FROM orders)) WHERE k = 1)"""
_NEW = """n AS (SELECT symbol, date, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq {0}, p {0}, value {0}) AS k FROM (
  SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS value, l_orderkey * 1000 + l_linenumber AS seq, l_partkey AS p
  FROM lineitem)) WHERE k = 1)"""


@query(
    f"""WITH {_OLD.format("DESC")}, {_NEW.format("DESC")} SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.date, o.date) AS date,
  round(coalesce(n.value, o.value), 6) AS value, coalesce(n.seq, o.seq) AS seq FROM o FULL JOIN n ON n.symbol = o.symbol AND n.date = o.date"""
)
def upsert_result(t):
    path = scratch(t, "prices")
    sinks.merge_upsert(t.spark, path, order_prices(t), ["symbol", "date"], ["year"], ["seq"])
    sinks.merge_upsert(t.spark, path, line_prices(t), ["symbol", "date"], ["year"], LINE_ORDER)
    return t.spark.read.parquet(path).select("symbol", "date", "value", "seq")


@query(
    f"""WITH {_OLD.format("ASC")}, {_NEW.format("ASC")} SELECT coalesce(o.symbol, n.symbol) AS symbol, coalesce(o.date, n.date) AS date,
  round(coalesce(o.value, n.value), 6) AS value FROM o FULL JOIN n ON n.symbol = o.symbol AND n.date = o.date"""
)
def insert_ignore(t):
    path = scratch(t, "ignore")
    sinks.insert_ignore(t.spark, path, order_prices(t), ["symbol", "date"], ["year"], ["seq"])
    sinks.insert_ignore(t.spark, path, line_prices(t).drop("l_partkey"), ["symbol", "date"], ["year"], ["seq", F.col("value")])
    return t.spark.read.parquet(path).select("symbol", "date", "value")


@query(
    f"""WITH {_OLD.format("DESC")}, {_NEW.format("DESC")} SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.date, o.date) AS date,
  round(coalesce(n.value, o.value), 6) AS value, o.symbol IS NOT NULL AND n.symbol IS NOT NULL AS is_revised,
  CASE WHEN o.symbol IS NOT NULL AND n.symbol IS NOT NULL THEN 1 ELSE 0 END AS revision_number
FROM o FULL JOIN n ON n.symbol = o.symbol AND n.date = o.date"""
)
def revision_upsert(t):
    path = scratch(t, "revisions")
    fresh = {"is_revised": F.lit(False), "revision_number": F.lit(0)}
    sinks.merge_upsert(t.spark, path, order_prices(t).withColumns(fresh), ["symbol", "date"], ["year"], ["seq"], revisions="value")
    sinks.merge_upsert(t.spark, path, line_prices(t).withColumns(fresh), ["symbol", "date"], ["year"], LINE_ORDER, revisions="value")
    return t.spark.read.parquet(path).select("symbol", "date", "value", "is_revised", "revision_number")


@query(
    """WITH o AS (SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate END AS day, o_totalprice FROM orders)
SELECT year(day) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM o WHERE day >= TIMESTAMP '1998-06-15' OR day IS NULL GROUP BY 1"""
)
def retention(t):
    path = scratch(t, "retention")
    # Every seventh order has no date, and stays.
    dated = t.orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate")))
    stored, parts = sinks.by_period(dated, "o_orderdate", "year")
    sinks.store(stored, path, parts)
    sinks.retain(t.spark, path, parts, "o_orderdate", "1998-06-15")
    kept = t.spark.read.parquet(path)
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_type AS symbol, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS volume FROM events GROUP BY 1")
def csv_export(t):
    path = scratch(t, "csv")
    sinks.to_csv(t.events.select(F.col("event_type").alias("symbol"), "event_id", "user_id"), path, "2024-01-31")
    back = t.spark.read.csv(f"{path}/2024-01-31", header=True, schema="event_id bigint, user_id bigint, symbol string")
    return back.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("volume"))


@query(
    """SELECT o_custkey::VARCHAR AS symbol, CAST(o_orderdate AS DATE) AS date, round(o_totalprice, 4) AS close, o_orderkey AS volume FROM orders"""
)
def model_rows(t):
    rows = t.orders.select(
        F.col("o_custkey").cast("string").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("close"),
        F.col("o_orderkey").alias("volume"), F.lit("dropped").alias("unknown_column"),
    )
    good, _ = sinks.model_rows(rows, schemas.entity("stock_prices"), "driver")
    return good.select("symbol", "date", "close", "volume")


# --- streams -----------------------------------------------------------------------------------------------


BATCHES = 3


def event_stream(t: Tables) -> DataFrame:
    """The events file of the folder as a stream."""
    schema = t.events.schema
    reader = t.spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet")
    return reader.parquet(t.folder)


def event_batches(t: Tables, path: str) -> DataFrame:
    """The events in ``BATCHES`` files, one file to a batch; times of a batch lie before and after those of the next."""
    return in_files(t, t.events.withColumn("_part", F.pmod(F.xxhash64("event_id"), F.lit(BATCHES))), path)


def in_files(t: Tables, parts: DataFrame, path: str) -> DataFrame:
    """Rows delivered in ``BATCHES`` files by their ``_part``, as a stream that takes a file to a batch."""
    for k in range(BATCHES):
        parts.filter(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return streams.ingest(t.spark, path, t.events.schema, files_per_trigger=1)


def finish(q) -> None:
    q.awaitTermination()


@query(
    f"""WITH {HOURLY} SELECT symbol, ts AS bar, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume
FROM bars WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"""
)
def stream_bars(t):
    """Closed windows only: the watermark leaves the last ones open."""
    path = scratch(t, "stream-bars")
    ticks = event_stream(t).withColumnRenamed("event_type", "symbol")
    bars = streams.bars(ticks, ["symbol"], "ts", "value", "user_id", "1h", "10 minutes")
    finish(streams.to_table(bars, path, f"{path}-checkpoint"))
    return t.spark.read.parquet(path)


@query(f"WITH {HOURLY} SELECT symbol, ts AS bar, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume FROM bars")
def stream_folded_bars(t):
    """Bars folded over batches that each hold ticks of all times; the last batch comes with a checkpoint of its own."""
    path = scratch(t, "folded-bars")
    fold = lambda ticks, checkpoint: finish(
        streams.keep_bars(ticks.withColumnRenamed("event_type", "symbol"), path, checkpoint, ["symbol"], "ts", "value", "user_id", "1h", ties=["event_id"])
    )
    fold(event_batches(t, f"{path}-in").filter("event_id % 5 > 0"), f"{path}-checkpoint")
    fold(event_stream(t).filter("event_id % 5 = 0"), f"{path}-checkpoint-2")
    return t.spark.read.parquet(path).select("symbol", "bar", "open", "high", "low", "close", "volume")


# Files by time; every tenth event comes one file late.
_DELIVERED = """e AS (SELECT *, least(2, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END
  + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS part FROM events),
top AS (SELECT p.part, max(e.ts) AS highest FROM (SELECT DISTINCT part FROM e) p JOIN e ON e.part < p.part GROUP BY 1),
late AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS bar, count(*) AS late_ticks FROM e JOIN top USING (part)
  WHERE ts < highest - INTERVAL 1 HOUR GROUP BY 1, 2)"""


@query(
    f"""WITH {HOURLY}, {_DELIVERED} SELECT b.symbol, b.ts AS bar, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
  round(close, 6) AS close, volume, coalesce(late_ticks, 0) AS late_ticks FROM bars b LEFT JOIN late l ON l.symbol = b.symbol AND l.bar = b.ts"""
)
def stream_late(t):
    """Bars of a stream whose late ticks are set aside and folded in afterwards, and how many each bar got that way."""
    path = scratch(t, "late-bars")
    ts = F.col("ts")
    part = F.when(ts < "2024-01-11", 0).when(ts < "2024-01-21", 1).otherwise(2) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    placed = t.events.withColumn("_part", F.least(F.lit(BATCHES - 1), part))
    ticks = in_files(t, placed, f"{path}-in").withColumnRenamed("event_type", "symbol")
    how = (["symbol"], "ts", "value", "user_id", "1h")
    finish(streams.keep_bars(ticks, path, f"{path}-checkpoint", *how, ties=["event_id"], late=f"{path}-late", delay="1 hour"))
    streams.fold_late(t.spark, path, f"{path}-late", *how, ties=["event_id"])
    bars = t.spark.read.parquet(path).select("symbol", "bar", "open", "high", "low", "close", "volume")
    late = streams.late_rows(t.spark, f"{path}-late").groupBy("symbol", F.date_trunc("hour", "ts").alias("bar")).agg(F.count(F.lit(1)).alias("n"))
    return bars.join(late, ["symbol", "bar"], "left").withColumn("late_ticks", F.coalesce("n", F.lit(0))).drop("n")


@query("SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM events")
def stream_unique(t):
    """Every record delivered in two files, one of them far behind the times of the other; stored once."""
    path = scratch(t, "unique")
    first = F.pmod(F.xxhash64("event_id"), F.lit(BATCHES))
    twice = t.events.select("*", F.explode(F.array(first, F.pmod(first + 1, F.lit(BATCHES)))).alias("_part"))
    finish(streams.keep_new(in_files(t, twice, f"{path}-in"), path, f"{path}-checkpoint", ["event_id"], "ts"))
    return t.spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "value")


@query("SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1")
def stream_dedup(t):
    """Every record delivered twice, stored once."""
    path = scratch(t, "dedup")
    once = event_stream(t)
    twice = once.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    unique = streams.without_repeats(twice, ["event_id"], "ts", "1 hour").drop("delivery")
    finish(streams.to_table(unique, path, f"{path}-checkpoint"))
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@query(
    """SELECT user_id, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events)
WHERE k = 1"""
)
def stream_upsert(t):
    """The latest event of each user, kept by continuous upsert."""
    path = scratch(t, "latest")
    finish(streams.upsert(event_batches(t, f"{path}-in"), path, f"{path}-checkpoint", ["user_id"], order=["ts", "event_id"]))
    return t.spark.read.parquet(path).select("user_id", "event_id", "value")


@query(
    """SELECT 'valid' AS outcome, count(*) AS n FROM events WHERE value <= 60 AND event_type <> 'error'
UNION ALL SELECT 'invalid', count(*) FROM events WHERE NOT (value <= 60 AND event_type <> 'error')"""
)
def stream_quarantine(t):
    path = scratch(t, "guarded")
    checks = {"value_bound": "value <= 60", "no_errors": "event_type <> 'error'"}
    finish(streams.guarded(event_stream(t), "events", f"{path}/valid", f"{path}/invalid", f"{path}-checkpoint", checks))
    count = lambda name: t.spark.read.parquet(f"{path}/{name}").agg(F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("n"))
    return count("valid").unionByName(count("invalid"))


@query(
    """SELECT event_type AS pipeline_id, 'r' || event_id AS run_id, CASE WHEN value > 60 THEN 'failed' ELSE 'success' END AS status,
  round(value, 6) AS duration_seconds FROM events"""
)
def run_log(t):
    """Every event as a run: opened, then closed by an upsert that sets status and duration."""
    path = scratch(t, "runs")
    opened = t.events.select(
        F.col("event_type").alias("pipeline_id"), F.concat(F.lit("r"), "event_id").alias("run_id"), F.lit("running").alias("status"),
        F.col("ts").alias("start_time"), F.lit(None).cast("double").alias("duration_seconds"),
    )
    sinks.append(opened, path)
    closed = t.events.select(
        F.col("event_type").alias("pipeline_id"), F.concat(F.lit("r"), "event_id").alias("run_id"),
        F.when(F.col("value") > 60, "failed").otherwise("success").alias("status"), F.col("ts").alias("start_time"),
        F.col("value").alias("duration_seconds"),
    )
    sinks.merge_upsert(t.spark, path, closed, ["run_id"], order=["start_time"])
    return t.spark.read.parquet(path).select("pipeline_id", "run_id", "status", "duration_seconds")


# --- whole jobs --------------------------------------------------------------------------------------------


def job_bars(name: str, moment: str) -> str:
    """Daily bars of all events, first and last by time and by the place inside a payload."""
    order = f"{moment}, event_id % {BLOCK}, event_id"
    return f"""SELECT {name} AS symbol, CAST(ts AS DATE) AS date, first(value + 1 ORDER BY {order}) AS open, max(value + 1) AS high,
  min(value + 1) AS low, last(value + 1 ORDER BY {order}) AS close, CAST(sum(user_id) AS BIGINT) AS volume FROM events GROUP BY 1, 2"""


@query(
    f"""WITH b AS ({job_bars("upper(event_type)", "date_trunc('second', ts)")})
SELECT symbol, date, round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low, round(close, 4) AS close, volume FROM b"""
)
def stock_job(t):
    """Landed payloads through the whole stock job into its table: one bar per symbol and day."""
    path = scratch(t, "job")
    price = F.col("value") + 1  # the table accepts positive prices only
    jobs.run(t.spark, jobs.JOBS["stock"], bar_payloads(t, price, price), path, source="driver")
    return t.spark.read.parquet(f"{path}/stock_prices").select("symbol", "date", "open", "high", "low", "close", "volume")


PAIRS = {"click": "EURUSD", "view": "GBPUSD", "error": "USDJPY", "signup": "AUDUSD", "purchase": "USDCHF"}


@query(
    f"""WITH b AS ({job_bars("CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAIRS.items()) + " ELSE 'NZDUSD' END", "epoch_ms(ts)")})
SELECT symbol[1:3] AS from_currency, symbol[4:6] AS to_currency, date, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
  round(close, 6) AS close, volume FROM b"""
)
def fx_job(t):
    """Currency ticks through their job: one bar per pair and day, whatever the ticks' times."""
    path, price = scratch(t, "fx"), F.col("value") + 1
    record = F.struct(
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("t"), price.alias("o"), price.alias("h"), price.alias("l"),
        price.alias("c"), F.col("user_id").alias("v"),
    )
    pair = F.coalesce(F.create_map(*[F.lit(x) for kv in PAIRS.items() for x in kv])[F.col("item")], F.lit("NZDUSD"))
    raw = blocks(t, record, lambda r: F.to_json(F.struct(r.alias("results")))).withColumn("item", pair)
    jobs.run(t.spark, jobs.JOBS["forex"], raw, path, source="driver")
    stored = t.spark.read.parquet(f"{path}/forex_rates")
    return stored.select("from_currency", "to_currency", "date", "open", "high", "low", "close", "volume")


@query(
    """WITH d AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS date, floor(max(value) / 50) AS value FROM events GROUP BY 1, 2)
SELECT upper(series_id) AS series_id, date, value FROM d"""
)
def fred_job(t):
    """Observations of a value that stands still for days: every one of them is stored."""
    path = scratch(t, "fred")
    daily = t.events.groupBy(F.upper("event_type").alias("item"), F.to_date("ts").alias("date")).agg(F.floor(F.max("value") / 50).alias("value"))
    record = F.struct(text("date").alias("date"), text("value").alias("value"), text("date").alias("realtime_start"), text("date").alias("realtime_end"))
    months = daily.withColumn("record", record).groupBy("item", F.trunc("date", "month")).agg(
        F.sort_array(F.collect_list(F.struct("date", "record"))).alias("r")
    )
    raw = months.select("item", F.to_json(F.struct(F.transform("r", lambda x: x.getField("record")).alias("observations"))).alias("payload"))
    jobs.run(t.spark, jobs.JOBS["fred"], raw, path, source="driver")
    return t.spark.read.parquet(f"{path}/economic_indicators").select("series_id", "date", "value")


@query(f"WITH {HOURLY} SELECT symbol, count(*) AS n FROM bars GROUP BY 1")
def item_batches(t):
    """Per-item tables combined with the item as a column."""
    hourly = bars_of(t, "1h")
    from tidemark.operators.standardize import combine

    items = {name: hourly.filter(F.col("symbol") == name).drop("symbol") for name in ("click", "view", "error", "signup", "purchase")}
    return combine(items, "symbol").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH d AS (SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2)
SELECT 'bronze' AS layer, count(*) AS "rows" FROM (SELECT DISTINCT event_type, event_id // 64 FROM events)
UNION ALL SELECT 'gold', count(*) FROM d"""
)
def medallion_layers(t):
    """Payloads, clean rows and daily statistics as three table layers."""
    path = scratch(t, "layers")
    price = F.col("value") + 1
    jobs.medallion(t.spark, jobs.JOBS["stock"], bar_payloads(t, price, price), path)
    layer = lambda name, folder: t.spark.read.parquet(f"{path}/{folder}").agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"))
    gold = t.spark.read.parquet(f"{path}/gold/daily_stats_stock").select("symbol", "date").distinct()
    return layer("bronze", "bronze/stock").unionByName(gold.agg(F.lit("gold").alias("layer"), F.count(F.lit(1)).alias("rows")))
