"""Jobs, run records, catalogue and stored rows over the driver tables, compared by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.base import Tables, query
from tidemark.checks.flow_queries import LINE_ORDER, _NEW, _OLD, bar_payloads, job_bars, line_prices, order_prices, scratch, text
from tidemark.checks.quality_queries import LEXICON, SCORED_SQL
from tidemark.operators import standardize
from tidemark.plans import jobs
from tidemark.sinks import tables as sinks
from tidemark.sources import payloads, tables as sources

_K = "CAST(json_extract(props, '$.k') AS DOUBLE)"


def k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def in_blocks(rows: DataFrame, item: str, number: str, record, wrap) -> DataFrame:
    """Payloads of at most a thousand consecutive records of one item."""
    dealt = rows.select(F.col(item).alias("item"), F.floor(F.col(number) / 1000).alias("block"), F.col(number).alias("n"), record.alias("record"))
    grouped = dealt.groupBy("item", "block").agg(F.sort_array(F.collect_list(F.struct("n", "record"))).alias("r"))
    return grouped.select("item", wrap(F.transform("r", lambda x: x.getField("record"))).alias("payload"))


# --- weather ---------------------------------------------------------------------------------------------


def sky(t: Tables) -> DataFrame:
    """One observation per event; a third of them do not say how much rain fell."""
    body = F.struct(
        F.struct(F.lit(51.5).alias("lat"), F.lit(-0.1).alias("lon")).alias("coord"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        F.struct((k() / 2 - 5).alias("temp"), (k() * 0.6 + 20).alias("humidity"), F.lit(1000).alias("pressure")).alias("main"),
        F.struct((k() / 4).alias("speed")).alias("wind"),
        F.when(F.col("event_id") % 3 > 0, F.struct((k() / 50).alias("1h"))).alias("rain"),
        F.array(F.struct(F.when(k() < 30, "Clear").when(k() < 60, "Clouds").otherwise("Rain").alias("main"))).alias("weather"),
    )
    return t.events.select(F.col("event_type").alias("item"), F.to_json(body).alias("payload"))


_SKY = f"""h AS (SELECT event_type AS location, CAST(ts AS DATE) AS date, {_K} / 2 - 5 AS temp, {_K} * 0.6::DOUBLE + 20 AS hum, {_K} / 4 AS wind,
  CASE WHEN event_id % 3 > 0 THEN {_K} / 50 ELSE 0 END AS rain, CASE WHEN {_K} < 30 THEN 'Clear' WHEN {_K} < 60 THEN 'Clouds' ELSE 'Rain' END AS sky FROM events),
m AS (SELECT location, date, sky FROM (SELECT *, row_number() OVER (PARTITION BY location, date ORDER BY n DESC, sky) AS k
  FROM (SELECT location, date, sky, count(*) AS n FROM h GROUP BY ALL)) WHERE k = 1),
d AS (SELECT location, date, min(temp) AS tmin, max(temp) AS tmax, avg(temp) AS tavg, avg(hum) AS havg, max(wind) AS wmax, sum(rain) AS rain FROM h GROUP BY ALL)"""


@query(
    f"""WITH {_SKY} SELECT location, date, round(tmin, 9) AS temperature_daily_min, round(tmax, 9) AS temperature_daily_max,
  round(tavg, 9) AS temperature_daily_avg, round(havg, 9) AS humidity_daily_avg, round(wmax, 9) AS wind_speed_daily_max, round(rain, 9) AS rain_1h_daily_total,
  sky AS weather_main_mode, round(tmax - tmin, 9) AS temperature_daily_range,
  round(greatest(0, 100 - abs(tavg - 21) * 5) * 0.6::DOUBLE + greatest(0, 100 - abs(havg - 50) * 2) * 0.4::DOUBLE, 9) AS comfort_index,
  dayofweek(date) IN (0, 6) AS is_weekend FROM d JOIN m USING (location, date)""",
    digits=9,
)
def weather_days_job(t):
    """Payloads to stored days with features. Values are spread evenly, so none is capped as an outlier."""
    path = scratch(t, "weather-days")
    jobs.weather_days(t.spark, sky(t), path)
    names = """location date temperature_daily_min temperature_daily_max temperature_daily_avg humidity_daily_avg wind_speed_daily_max rain_1h_daily_total
      weather_main_mode temperature_daily_range comfort_index is_weekend""".split()
    return t.spark.read.parquet(f"{path}/weather_daily").select(*names)


def hourly_sky(t: Tables) -> DataFrame:
    """One observation per place and hour."""
    hours = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.max(k()).alias("high"), F.min(k()).alias("low"))
    body = F.struct(
        F.unix_seconds(F.col("hour").cast("timestamp")).alias("dt"),
        F.struct((F.col("high") / 2 - 5).alias("temp"), (F.col("low") / 2 + 20).alias("humidity"), F.lit(1000).alias("pressure")).alias("main"),
        F.struct((F.col("high") / 4).alias("speed")).alias("wind"),
        F.array(F.struct(F.when(F.col("high") < 50, "Clear").otherwise("Rain").alias("main"))).alias("weather"),
    )
    return hours.select(F.col("event_type").alias("item"), F.to_json(body).alias("payload"))


_HOURS = f"SELECT event_type AS location, date_trunc('hour', ts)::TIMESTAMP AS timestamp, max({_K}) AS hi, min({_K}) AS lo FROM events GROUP BY 1, 2"


@query(
    f"""WITH h AS ({_HOURS}) SELECT location, timestamp, round(hi / 2 - 5, 6) AS temperature, round(lo / 2 + 20, 6) AS humidity, 1000.0::DOUBLE AS pressure,
  round(hi / 4, 6) AS wind_speed, CASE WHEN hi < 50 THEN 'Clear' ELSE 'Rain' END AS weather_condition FROM h"""
)
def weather_job(t):
    """Hourly observations through the whole job into their table."""
    path = scratch(t, "weather")
    jobs.run(t.spark, jobs.JOBS["weather"], hourly_sky(t), path, source="driver")
    stored = t.spark.read.parquet(f"{path}/weather_data")
    return stored.select("location", "timestamp", "temperature", "humidity", "pressure", "wind_speed", "weather_condition")


# --- coins -----------------------------------------------------------------------------------------------

COINS = {"click": "BTC-USD", "view": "eth", "error": "XRPUSDT", "signup": "ada/usd", "purchase": "DOGEUSDT"}


def hourly_coins(t: Tables) -> DataFrame:
    hours = t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.max("value").alias("high"), F.min("value").alias("low"), F.sum("user_id").alias("volume")
    )
    seconds = F.unix_seconds(F.col("hour").cast("timestamp"))
    plus = lambda c: text(F.col(c) + 1)
    zero = F.lit("0")
    record = F.array(
        text(seconds * 1000), plus("low"), plus("high"), plus("low"), plus("high"), text("volume"), text(seconds * 1000), zero, zero, zero, zero, zero
    )
    coin = F.create_map(*[F.lit(x) for kv in COINS.items() for x in kv])[F.col("event_type")]
    numbered = hours.withColumns({"coin": coin, "place": F.floor(seconds / 3600)})
    return in_blocks(numbered, "coin", "place", record, F.to_json)


@query(
    """WITH h AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS timestamp, max(value) + 1 AS hi, min(value) + 1 AS lo, sum(user_id) AS v FROM events GROUP BY 1, 2)
SELECT CASE event_type WHEN 'click' THEN 'BTC' WHEN 'view' THEN 'ETH' WHEN 'error' THEN 'XRP' WHEN 'signup' THEN 'ADAUSD' ELSE 'DOGE' END || 'USDT' AS symbol,
  'binance' AS exchange, timestamp, round(lo, 6) AS open, round(hi, 6) AS high, round(lo, 6) AS low, round(hi, 6) AS close, CAST(v AS DOUBLE) AS volume FROM h"""
)
def crypto_job(t):
    """Hourly klines through their job, symbols brought to the form of the exchange."""
    path = scratch(t, "crypto")
    jobs.run(t.spark, jobs.JOBS["crypto"], hourly_coins(t), path, source="driver")
    return t.spark.read.parquet(f"{path}/crypto_prices").select("symbol", "exchange", "timestamp", "open", "high", "low", "close", "volume")


# --- news ------------------------------------------------------------------------------------------------


def news_payloads(t: Tables) -> DataFrame:
    """A news item per document, an hour apart; every tenth has no time, every seventh names nothing it is related to."""
    item = F.struct(
        F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 10 > 0, 1704067200 + F.col("doc_id") * 3600).alias("datetime"),
        F.col("text").alias("summary"), F.when(F.col("doc_id") % 7 > 0, F.col("source")).alias("related"),
        F.concat(F.lit("doc:"), "doc_id").alias("url"),
    )
    return t.documents.select(F.to_json(F.array(item)).alias("payload"))


_NEWS = f"""{SCORED_SQL}, n AS (SELECT doc_id, coalesce(CASE WHEN doc_id % 7 > 0 THEN nullif(trim(source), '') END, 'general') AS entity,
  TIMESTAMP '2024-01-01' + to_hours(doc_id::INTEGER) AS timestamp, round(round(p, 9), 4) AS score, round(round(1 - s, 9), 4) AS conf FROM sc WHERE doc_id % 10 > 0)"""


@query(
    f"""WITH {_NEWS} SELECT entity, timestamp, round(score, 6) AS sentiment_score, round(conf, 6) AS confidence, 'doc:' || doc_id AS url,
  (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS quarantined FROM n"""
)
def news_job(t):
    """News to stored scores; items without a time are quarantined."""
    path = scratch(t, "news")
    jobs.news_sentiment(t.spark, news_payloads(t), path, "driver", LEXICON)
    left = t.spark.read.parquet(f"{path}/quarantine").agg(F.count(F.lit(1)).alias("quarantined"))  # one row
    stored = t.spark.read.parquet(f"{path}/sentiment_data").select("entity", "timestamp", "sentiment_score", "confidence", "url")
    return stored.join(F.broadcast(left))


@query(
    f"""WITH {_NEWS} SELECT entity, CAST(timestamp AS DATE) AS date, round(avg(score), 6) AS sentiment_polarity_mean,
  round(stddev_samp(score), 6) AS sentiment_polarity_std, count(score) AS sentiment_polarity_count, round(avg(1 - conf), 6) AS sentiment_subjectivity_mean
FROM n GROUP BY 1, 2"""
)
def news_days(t):
    """Daily sentiment of each entity, from the stored scores."""
    path = scratch(t, "news-days")
    jobs.news_sentiment(t.spark, news_payloads(t), path, "driver", LEXICON)
    return jobs.sentiment_days(t.spark.read.parquet(f"{path}/sentiment_data"))


# --- runs ------------------------------------------------------------------------------------------------


@query(
    f"""WITH h AS ({_HOURS}), c AS (SELECT count(*) AS n FROM h), s AS (SELECT count(*) AS n FROM documents),
r(job, status, loaded, failed) AS (
  SELECT 'weather', 'success', n, 0 FROM c UNION ALL SELECT 'crypto', 'success', n, 0 FROM c UNION ALL SELECT 'stock', 'failed', 0, 0
  UNION ALL SELECT 'news', 'partial_success', (SELECT count(*) FROM documents WHERE doc_id % 10 > 0), (SELECT count(*) FROM documents WHERE doc_id % 10 = 0))
SELECT job, status, loaded::BIGINT AS loaded, failed::BIGINT AS failed, (loaded + failed)::BIGINT AS records_processed, failed::BIGINT AS records_failed,
  job = 'stock' AS has_error, true AS ended, true AS timed FROM r"""
)
def run_records(t):
    """Several sources as one run, one of them not readable: the success table beside the records of the runs."""
    path = scratch(t, "runs")
    raw = {"weather": hourly_sky(t), "crypto": hourly_coins(t), "stock": hourly_sky(t).drop("payload")}
    table = jobs.run_all(t.spark, raw, path, f"{path}/runs", "day1")
    counts = jobs.news_sentiment(t.spark, news_payloads(t), path, "driver", LEXICON, f"{path}/runs", "day1_news")
    news = t.spark.createDataFrame(
        [("news", sinks.run_status(counts["total"] + counts["failed"], counts["failed"]), counts["total"], counts["failed"], None)], table.schema
    )
    records = t.spark.read.parquet(f"{path}/runs").select(
        F.col("pipeline_id").alias("job"), "status", "records_processed", "records_failed", F.col("error_message").isNotNull().alias("has_error"),
        F.coalesce(F.col("ended_at") >= F.col("start_time"), F.lit(False)).alias("ended"),
        F.coalesce(F.col("duration_seconds") >= 0, F.lit(False)).alias("timed"),
    )
    return table.unionByName(news).drop("error").join(records, ["job", "status"])


@query(
    f"""WITH b AS ({job_bars("upper(event_type)", "date_trunc('second', ts)")})
SELECT symbol, date, round(close, 4) AS close, round(lag(close) OVER w, 4) AS close_lag_1, round(lag(close, 7) OVER w, 4) AS close_lag_7,
  round(avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS 6 PRECEDING), 4) AS close_ma_7 FROM b WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    digits=4,
)
def job_features(t):
    """Time features of the daily bars that a job would load."""
    price = F.col("value") + 1
    rows = jobs.run(t.spark, jobs.JOBS["stock"], bar_payloads(t, price, price), with_features=True).rows
    return rows.select("symbol", F.to_date("timestamp").alias("date"), "close", "close_lag_1", "close_lag_7", "close_ma_7")


@query(
    f"""WITH b AS ({job_bars("upper(event_type)", "date_trunc('second', ts)")}), n AS (SELECT count(*) AS n FROM (SELECT DISTINCT event_type, event_id // 64 FROM events))
SELECT symbol, date, round(open, 4) AS open, round(close, 4) AS close, round(close, 4) AS avg_close, round(high, 4) AS max_high, round(low, 4) AS min_low,
  volume AS total_volume, n.n AS payloads FROM b, n""",
    digits=4,
)
def layer_values(t):
    """Silver bars beside the gold statistics of their day, and the payloads they were made of."""
    path = scratch(t, "layer-values")
    price = F.col("value") + 1
    jobs.medallion(t.spark, jobs.JOBS["stock"], bar_payloads(t, price, price), path)
    read = lambda name: t.spark.read.parquet(f"{path}/{name}")
    bronze = read("bronze/stock").agg(F.count(F.lit(1)).alias("payloads"))  # one row
    silver = read("silver/stock_prices").select("symbol", "date", "open", "close")
    gold = read("gold/daily_stats_stock").select("symbol", "date", "avg_close", "max_high", "min_low", F.col("total_volume").cast("bigint").alias("total_volume"))
    return silver.join(gold, ["symbol", "date"]).join(F.broadcast(bronze))


# --- stored rows -----------------------------------------------------------------------------------------


@query(
    f"""WITH {_OLD.format("DESC")}, {_NEW.format("DESC")} SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.date, o.date) AS date,
  o.symbol IS NOT NULL AS first_created, n.symbol IS NOT NULL AS changed_since FROM o FULL JOIN n ON n.symbol = o.symbol AND n.date = o.date"""
)
def upsert_stamps(t):
    """``created_at`` stays with the first delivery, ``updated_at`` moves with a row that changes."""
    path = scratch(t, "stamps")
    then = F.lit("2020-01-01").cast("timestamp")
    stamped = order_prices(t).withColumns({"created_at": then, "updated_at": then})
    sinks.merge_upsert(t.spark, path, stamped, ["symbol", "date"], ["year"], ["seq"])
    sinks.merge_upsert(t.spark, path, line_prices(t), ["symbol", "date"], ["year"], LINE_ORDER)
    stored = t.spark.read.parquet(path)
    return stored.select("symbol", "date", (F.col("created_at") == then).alias("first_created"), (F.col("updated_at") > then).alias("changed_since"))


@query(
    """SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'volume,symbol missing' ELSE 'volume' END AS rejected, o_orderkey AS orderkey FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 10 = 3
UNION ALL SELECT 'symbol missing', o_orderkey FROM orders WHERE o_orderkey % 10 = 5"""
)
def model_rejects(t):
    """Rows that the model cannot hold, with every reason."""
    key = F.col("o_orderkey")
    rows = t.orders.select(
        key.alias("orderkey"), F.when(key % 5 > 0, F.col("o_custkey").cast("string")).alias("symbol"), F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("close"), F.when(key % 10 == 3, "many").when(key % 10 == 0, "n/a").otherwise("7").alias("volume"),
    )
    _, bad = sinks.model_rows(rows, schemas.entity("stock_prices"), "driver")
    return bad.select(F.array_join("rejected", ",").alias("rejected"), "orderkey")


# --- catalogue -------------------------------------------------------------------------------------------

ITEMS = sorted({i for items in (*schemas.DEFAULT_ITEMS.values(), *schemas.FUND_CATEGORIES.values(), schemas.INDEX_METADATA) for i in items})
_LISTED = "(" + "list_value(" + ", ".join(f"'{i}'" for i in ITEMS) + f"))[(event_id % {len(ITEMS) + 3})::INTEGER + 1]"


def requested(t: Tables) -> DataFrame:
    """Events with an item of the catalogue, or none."""
    item = F.get(F.array(*[F.lit(i) for i in ITEMS]), (F.col("event_id") % (len(ITEMS) + 3)).cast("int"))
    return t.events.select("event_id", "event_type", item.alias("symbol"))


def _universe_sql() -> str:
    rows = [(kind, i, None) for kind, items in schemas.DEFAULT_ITEMS.items() for i in items]
    rows += [("fund", i, name) for name, items in schemas.FUND_CATEGORIES.items() for i in items]
    rows += [("index_region", i, meta[1]) for i, meta in schemas.INDEX_METADATA.items()]
    return ", ".join(f"('{a}', '{i}', {'NULL' if c is None else repr(c)})" for a, i, c in rows)


@query(
    f"""WITH u(asset_type, item, category) AS (VALUES {_universe_sql()}), e AS (SELECT {_LISTED} AS item, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT asset_type, item, category, coalesce(n, 0) AS n FROM u LEFT JOIN e USING (item)"""
)
def item_coverage(t):
    """Rows delivered for every item of the catalogue."""
    return sources.coverage(requested(t).filter("event_type <> 'view'"), "symbol")


MEMBERS = (("etf", "tech"), ("etf", "innovative"), ("etf", "none such"), ("index", "japan"), ("index", "UK"), ("index", "nowhere"))
_MEMBERS = {
    "tech": ("QQQ", "XLK"), "innovative": ("ARKF", "ARKG", "ARKK"), "none such": schemas.DEFAULT_ITEMS["etf"],
    "japan": ("N225",), "UK": ("FTSE",), "nowhere": schemas.DEFAULT_ITEMS["index"],
}


@query(
    f"WITH e AS (SELECT event_id, {_LISTED} AS symbol FROM events) "
    + " UNION ALL ".join(f"SELECT '{name}' AS category, symbol, count(*) AS n FROM e WHERE symbol IN {str(items).replace(',)', ')')} GROUP BY 2" for name, items in _MEMBERS.items())
)
def category_members(t):
    """Rows of the members of fund categories and index regions; an unknown name means the default list."""
    rows = [
        sources.only_items(requested(t), "symbol", sources.members(kind, name)).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).withColumn("category", F.lit(name))
        for kind, name in MEMBERS
    ]
    found = rows[0]
    for one in rows[1:]:
        found = found.unionByName(one)
    return found


OFFERED = ("1min", "2min", "1h", "H1", "1day", "1w", "1month", "")


@query(f"""SELECT event_id, iv AS "interval" FROM (SELECT event_id, (list_value{OFFERED})[(event_id % 8)::INTEGER + 1] AS iv FROM events) WHERE iv IN ('1min', '1h', '1day', '1month')""")
def interval_filter(t):
    """Rows of the intervals that a request may name."""
    offered = F.get(F.array(*[F.lit(i) for i in OFFERED]), (F.col("event_id") % 8).cast("int"))
    return sources.valid_intervals(t.events.select("event_id", offered.alias("interval")))


@query(
    """SELECT event_id, upper(event_type) AS symbol, round(value, 6) AS close, NULL::DOUBLE AS open, NULL::DOUBLE AS volume, NULL::VARCHAR AS exchange,
  ts AS timestamp FROM events"""
)
def required_columns(t):
    """Columns that a kind requires and a source does not have, as nulls of their types."""
    rows = t.events.select("event_id", F.upper("event_type").alias("symbol"), F.col("value").alias("close"))
    full = standardize.add_required(rows, "crypto").drop("timestamp").join(t.events.select("event_id", F.col("ts").alias("timestamp")), "event_id")
    return full.select("event_id", "symbol", "close", "open", "volume", "exchange", "timestamp")


@query(
    """SELECT event_id, 'crypto' AS kind, 'BTC' AS base_currency, 'USD' AS quote_currency, NULL::VARCHAR AS name, NULL::VARCHAR AS currency, round(value, 6) AS close FROM events WHERE user_id % 2 = 0
UNION ALL SELECT event_id, 'crypto', 'BTC', NULL, NULL, NULL, round(value, 6) FROM events WHERE user_id % 2 = 1
UNION ALL SELECT event_id, 'forex', 'EUR', CASE WHEN user_id % 2 = 0 THEN 'USD' END, NULL, NULL, round(value, 6) FROM events
UNION ALL SELECT event_id, 'etf', NULL, NULL, CASE WHEN user_id % 2 = 0 THEN event_type ELSE 'plain' END, 'USD', round(value, 6) FROM events"""
)
def quote_kinds(t):
    """Quotes of coins, pairs and funds, with the columns of their class."""
    even = F.col("user_id") % 2 == 0
    symbol = lambda base: F.when(even, F.lit(f"{base}/USD")).otherwise(base)
    body = lambda s: F.to_json(
        F.struct(
            s.alias("symbol"), text("value").alias("close"), F.lit("plain").alias("name"), F.lit("USD").alias("currency"),
            F.when(even, F.struct(F.col("event_type").alias("name"))).alias("meta"),
        )
    )
    parts = []
    for kind, s in (("crypto", symbol("BTC")), ("forex", symbol("EUR")), ("etf", F.lit("SPY"))):
        rows = payloads.quotes(t.events.select("event_id", body(s).alias("payload")), kind).withColumn("kind", F.lit(kind))
        absent = [c for c in ("base_currency", "quote_currency", "name", "currency") if c not in rows.columns]
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else rows
        parts.append(rows.select("event_id", "kind", "base_currency", "quote_currency", "name", "currency", "close"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
