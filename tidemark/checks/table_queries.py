"""The query catalogue, cleaning, standardising and dimensions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.base import query
from tidemark.checks.series_queries import DAILY, HOURLY, OHLCV, bars_of, ticks
from tidemark.functions import scalar
from tidemark.operators import catalogue, clean, standardize, stats
from tidemark.operators.series import series
from tidemark.plans import jobs, star
from tidemark.sources import tables as sources

# --- statistics and filters -----------------------------------------------------------------------


@query(
    f"""WITH {DAILY} SELECT symbol, ts, round(min(low), 6) AS min_rate, round(max(high), 6) AS max_rate, round(avg(close), 6) AS avg_rate
FROM bars WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY 1, 2"""
)
def range_stats(t):
    daily = bars_of(t, "1d")
    return catalogue.range_stats(daily, ["symbol"], "2024-01-05", "2024-01-20", "ts")


@query(
    f"""WITH {HOURLY} SELECT symbol, count(*) AS num_days, round(avg(close), 6) AS avg_close, round(min(low), 6) AS min_low,
  round(max(high), 6) AS max_high, round(stddev_samp(close), 6) AS std_dev,
  round((max(high) - min(low)) / avg(close) * 100, 6) AS range_pct FROM bars GROUP BY 1"""
)
def pair_volatility(t):
    return catalogue.volatility_stats(bars_of(t, "1h"), ["symbol"])


@query(
    """SELECT concat(o_orderstatus, '/', o_orderpriority) AS pair, count(*) AS num_records, min(o_orderdate) AS earliest_date,
  max(o_orderdate) AS latest_date FROM orders GROUP BY 1"""
)
def pair_inventory(t):
    pairs = t.orders.withColumn("pair", scalar.pair_label("o_orderstatus", "o_orderpriority"))
    return catalogue.inventory(pairs, ["pair"], "o_orderdate")


@query(
    """SELECT o_custkey, o_orderdate, count(*) AS cnt FROM orders GROUP BY 1, 2 HAVING count(*) > 1"""
)
def duplicate_keys(t):
    return catalogue.duplicate_keys(t.orders, ["o_custkey", "o_orderdate"])


@query(
    """SELECT event_type AS symbol, CAST(ts AS DATE) AS date, round(avg(value), 6) AS avg_close, round(max(value), 6) AS max_high,
  round(min(value), 6) AS min_low, CAST(sum(user_id) AS BIGINT) AS total_volume FROM events GROUP BY 1, 2"""
)
def daily_stats(t):
    quoted = ticks(t).select(
        "symbol", "ts", F.col("value").alias("close"), F.col("value").alias("high"), F.col("value").alias("low"),
        F.col("user_id").alias("volume"),
    )
    return catalogue.daily_stats(quoted, ["symbol"], "ts")


@query(
    f"""WITH {HOURLY} SELECT symbol, CAST(ts AS DATE) AS trading_date, round(max(high), 6) AS daily_high, round(min(low), 6) AS daily_low,
  CAST(sum(volume) AS BIGINT) AS total_volume, round(max(high) - min(low), 6) AS daily_range FROM bars GROUP BY 1, 2"""
)
def intraday_range(t):
    return catalogue.intraday_range(bars_of(t, "1h"), ["symbol"], "ts")


@query(
    """WITH f AS (SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'M1' WHEN o_orderpriority LIKE '2%' THEN 'M5'
  WHEN o_orderpriority LIKE '3%' THEN 'H1' ELSE 'D1' END AS timeframe, o_totalprice AS volume FROM orders)
SELECT timeframe, round(avg(volume), 4) AS avg_volume, round(min(volume), 4) AS min_volume, round(max(volume), 4) AS max_volume,
  round(stddev_samp(volume), 4) AS volume_stddev FROM f GROUP BY 1"""
)
def volume_stats(t):
    p = F.col("o_orderpriority")
    frame = F.when(p.startswith("1"), "M1").when(p.startswith("2"), "M5").when(p.startswith("3"), "H1").otherwise("D1")
    out = catalogue.volume_stats(t.orders.select(frame.alias("timeframe"), F.col("o_totalprice").alias("volume")))
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c != "timeframe"})


@query("SELECT o_custkey, count(DISTINCT CAST(o_orderdate AS DATE)) AS trading_days FROM orders GROUP BY 1")
def trading_days(t):
    return catalogue.trading_days(t.orders, ["o_custkey"], "o_orderdate")


@query("SELECT DISTINCT concat(o_orderstatus, '/', o_orderpriority) AS pair FROM orders")
def distinct_pairs(t):
    return t.orders.select(scalar.pair_label("o_orderstatus", "o_orderpriority").alias("pair")).distinct()


@query("SELECT user_id, count(*) AS count FROM events GROUP BY 1")
def symbol_counts(t):
    return catalogue.counts(t.events, ["user_id"])


@query('SELECT min(o_orderdate) AS "first", max(o_orderdate) AS "last", round(avg(o_totalprice), 4) AS avg_volume, count(*) AS "rows" FROM orders')
def span_summary(t):
    out = catalogue.span_summary(t.orders.withColumnRenamed("o_totalprice", "volume"), "o_orderdate")
    return out.withColumn("avg_volume", F.round("avg_volume", 4))


def _frequency_sql(unit: str, aggregate: str) -> str:
    return f"""SELECT l_returnflag, CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS period, round({aggregate}, 3) AS value
FROM lineitem GROUP BY 1, 2"""


@query(_frequency_sql("month", "avg(l_quantity)"))
def monthly_average(t):
    out = catalogue.by_frequency(t.lineitem, ["l_returnflag"], "l_shipdate", "l_quantity", "month", "avg")
    return out.withColumn("value", F.round("value", 3))


@query(_frequency_sql("quarter", "sum(l_quantity)"))
def quarterly_sum(t):
    return catalogue.by_frequency(t.lineitem, ["l_returnflag"], "l_shipdate", "l_quantity", "quarter", "sum")


@query(
    """SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS period, round(arg_max(value, ts), 6) AS value FROM events GROUP BY 1, 2"""
)
def weekly_last(t):
    return catalogue.by_frequency(t.events, ["event_type"], "ts", "value", "week", "eop")


@query(
    f"""WITH {HOURLY} SELECT {OHLCV}, round((high - low) / nullif(low, 0) * 100, 6) AS volatility_pct,
  CASE WHEN (high - low) / nullif(low, 0) > 0.05 THEN 'Very High' WHEN (high - low) / nullif(low, 0) > 0.03 THEN 'High'
       WHEN (high - low) / nullif(low, 0) > 0.02 THEN 'Medium' ELSE 'Low' END AS volatility_level FROM bars"""
)
def volatility_levels(t):
    return catalogue.with_volatility_level(bars_of(t, "1h"))


@query(
    f"""WITH {HOURLY} SELECT {OHLCV}, round((high - low) / low * 100, 6) AS volatility_pct,
  CASE WHEN (high - low) / low > 0.05 THEN 'Very High' WHEN (high - low) / low > 0.03 THEN 'High' ELSE 'Medium' END AS volatility_level
FROM bars WHERE (high - low) / nullif(low, 0) > 0.02"""
)
def volatile_days(t):
    return catalogue.volatile_days(bars_of(t, "1h"))


@query(
    f"""WITH {HOURLY}, m AS (SELECT symbol, ts, open, low AS high, high AS low, close, volume FROM bars)
SELECT symbol, ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume
FROM m WHERE high < low OR high < open OR high < close"""
)
def ohlc_violations(t):
    swapped = bars_of(t, "1h").withColumns({"high": F.col("low"), "low": F.col("high")})
    return catalogue.ohlc_violations(swapped)


@query(
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 30 DAY FROM orders)"""
)
def last_30_days(t):
    return catalogue.since(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", 30)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def incremental_filter(t):
    return sources.newer_than(t.events, "ts", "2024-01-20 12:00:00").select("event_id", "ts")


@query(
    """SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-25' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-25'"""
)
def range_selection(t):
    asof = F.lit("2024-01-25").cast("timestamp_ntz")
    return sources.in_range(t.events, "ts", asof, kind="pollution").select("event_id", "ts")


@query(
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""
)
def filtered_scan(t):
    return sources.scan(
        t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice"], o_orderstatus="F", o_orderpriority="1-URGENT"
    )


@query("SELECT max(o_orderdate) AS latest FROM orders WHERE o_orderstatus = 'F'")
def high_water_mark(t):
    return catalogue.high_water_mark(t.orders, "o_orderdate", o_orderstatus="F")


@query(
    """SELECT p_partkey AS series_id, p_name AS title, p_size AS popularity FROM parts_ranked WHERE k <= 50""".replace(
        "parts_ranked",
        "(SELECT *, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS k FROM part WHERE lower(p_name) LIKE '%ring%')",
    )
)
def title_search(t):
    named = t.part.select(F.col("p_partkey").alias("series_id"), F.col("p_name").alias("title"), F.col("p_size").alias("popularity"))
    return catalogue.search(named, "RING", limit=50)


@query(
    """SELECT c_custkey, c_mktsegment FROM customer WHERE regexp_full_match(c_mktsegment, '[A-Z]{1,10}')"""
)
def symbol_format(t):
    return t.customer.filter(F.col("c_mktsegment").rlike("^[A-Z]{1,10}$")).select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND length(trim(o_orderstatus)) > 0")
def member_filter(t):
    listed = sources.only_items(t.orders, "o_orderpriority", ("1-URGENT", "2-HIGH"))
    return listed.filter(scalar.valid_symbol("o_orderstatus")).select("o_orderkey")


# --- latest rows and gaps ---------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, round(o_totalprice, 6) AS o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1"""
)
def latest_per_key(t):
    out = catalogue.latest(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    """SELECT event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k
FROM events) WHERE k <= 100"""
)
def last_100_rows(t):
    return catalogue.last_rows(t.events, ["event_type"], "ts", 100, ["event_id"]).select("event_type", "event_id", "ts")


@query(
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE (l_suppkey, l_shipdate) IN (SELECT l_suppkey, max(l_shipdate) FROM lineitem GROUP BY 1)"""
)
def latest_cross_broker(t):
    out = catalogue.at_latest_time(t.lineitem, ["l_suppkey"], "l_shipdate")
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query(
    """WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_custkey, CAST(d + INTERVAL 1 DAY AS DATE) AS missing_date FROM d
WHERE NOT EXISTS (SELECT 1 FROM d AS n WHERE n.o_custkey = d.o_custkey AND n.d = CAST(d.d + INTERVAL 1 DAY AS DATE))"""
)
def next_day_gaps(t):
    return catalogue.next_day_gaps(t.orders, ["o_custkey"], "o_orderdate")


@query(
    """WITH cal AS (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders),
k AS (SELECT DISTINCT o_custkey FROM orders), p AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT k.o_custkey, count(*) AS missing_days FROM cal CROSS JOIN k
LEFT JOIN p ON p.o_custkey = k.o_custkey AND p.d = CAST(cal.d AS DATE)
WHERE isodow(cal.d) < 6 AND p.d IS NULL GROUP BY 1 HAVING count(*) > 2"""
)
def missing_days(t):
    return catalogue.missing_days(t.orders, ["o_custkey"], "o_orderdate")


# --- comparisons --------------------------------------------------------------------------------------


@query(
    """WITH d AS (SELECT CAST(ts AS DATE) AS date, event_type, max(value) AS value FROM events GROUP BY 1, 2)
SELECT date, round(max(CASE WHEN event_type = 'click' THEN value END), 6) AS click,
  round(max(CASE WHEN event_type = 'view' THEN value END), 6) AS view,
  round(max(CASE WHEN event_type = 'purchase' THEN value END), 6) AS purchase FROM d GROUP BY 1"""
)
def indicator_pivot(t):
    dated = t.events.withColumn("date", F.to_date("ts"))
    return catalogue.side_by_side(dated, "date", "event_type", "value", ["click", "view", "purchase"])


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) AS frequency FROM events GROUP BY 1, 2)
SELECT user_id, event_type, frequency, round(100.0 * frequency / sum(frequency) OVER (PARTITION BY user_id), 1)::DOUBLE AS pct FROM c"""
)
def condition_frequency(t):
    return catalogue.condition_frequency(t.events, "user_id", "event_type")


@query(
    """SELECT user_id, CAST(ts AS DATE) AS date, round(sum(value), 6) AS total_daily_rain, count(*) AS hourly_observations
FROM events GROUP BY 1, 2 HAVING sum(value) > 10"""
)
def precip_summary(t):
    return catalogue.precipitation(t.events.withColumn("date", F.to_date("ts")), ["user_id", "date"], "value")


def runs(t):
    """Events as pipeline runs: slow ones failed, very slow ones found anomalies."""
    return t.events.select(
        F.col("event_type").alias("pipeline_id"),
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("value") > 60, "failed").otherwise("success").alias("status"),
        F.col("value").alias("duration_seconds"),
        F.col("user_id").alias("records_processed"),
        F.when(F.col("value") > 100, '["slow","late"]').when(F.col("value") > 60, '["slow"]').alias("anomaly_details"),
    )


@query(
    """SELECT CAST(ts AS DATE) AS run_date, event_type AS pipeline_id, count(*) AS runs, count_if(value <= 60)::BIGINT AS successful_runs,
  round(avg(value), 6) AS avg_duration_sec, round(max(value), 6) AS max_duration_sec, CAST(sum(user_id) AS BIGINT) AS total_records_loaded
FROM events GROUP BY 1, 2"""
)
def run_trends(t):
    return catalogue.run_trends(runs(t))


@query(
    """SELECT CAST(ts AS DATE) AS run_date, event_type AS pipeline_id, count_if(value > 60)::BIGINT AS runs_with_anomalies,
  CAST(sum(CASE WHEN value > 100 THEN 2 WHEN value > 60 THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count FROM events GROUP BY 1, 2"""
)
def anomaly_trends(t):
    return catalogue.anomaly_trends(runs(t))


@query(
    """SELECT event_type AS pipeline_id, count(*) AS failed_runs FROM events
WHERE value > 60 AND ts >= TIMESTAMP '2024-01-30' - INTERVAL 24 HOUR GROUP BY 1"""
)
def failed_runs(t):
    return catalogue.failed_counts(runs(t), F.lit("2024-01-30").cast("timestamp_ntz"))


@query(
    """WITH l AS (SELECT l_returnflag, count(*) AS total, count_if(l_discount > 0.08)::BIGINT AS failed FROM lineitem GROUP BY 1),
s AS (SELECT CAST(sum(total) AS BIGINT) AS total, CAST(sum(failed) AS BIGINT) AS failed FROM l)
SELECT total, failed, round(failed / total, 6) AS failure_rate, failed / total <= 0.05 AS ok FROM s"""
)
def load_failure(t):
    loads = t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("loaded"), F.count_if(F.col("l_discount") > 0.08).alias("failed")
    )
    return jobs.load_check(loads)


@query(
    """WITH q AS (SELECT event_type AS symbol, round(arg_max(value, ts) - avg(value), 6) AS percent_change FROM events GROUP BY 1)
SELECT symbol, percent_change, CASE WHEN (SELECT count_if(percent_change > 0) > count(*) / 2.0 FROM q) THEN 'Positive' ELSE 'Negative' END
  AS market_sentiment FROM q"""
)
def market_summary(t):
    quotes = ticks(t).groupBy("symbol").agg(F.round(F.max_by("value", "ts") - F.avg("value"), 6).alias("percent_change"))
    return catalogue.market_summary(quotes)


@query(
    """SELECT source, count(*) AS records FROM (SELECT 'orders' AS source FROM orders UNION ALL SELECT 'lineitem' FROM lineitem
UNION ALL SELECT 'events' FROM events) GROUP BY 1"""
)
def record_counts(t):
    return jobs.record_counts({"orders": t.orders, "lineitem": t.lineitem, "events": t.events})


@query(
    """SELECT 'order' AS source, o_custkey AS symbol, o_orderdate AS ts, round(o_totalprice, 6) AS value, NULL::DOUBLE AS tax FROM orders
UNION ALL SELECT 'line', l_suppkey, l_shipdate, round(l_extendedprice, 6), round(l_tax, 6) FROM lineitem"""
)
def union_sources(t):
    a = t.orders.select(F.col("o_custkey").alias("symbol"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    b = t.lineitem.select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("value"),
        F.col("l_tax").alias("tax"),
    )
    return catalogue.union_sources({"order": a, "line": b})


@query(
    """WITH o AS (SELECT l_suppkey, l_shipdate AS realtime_start, coalesce(lead(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate)
    - INTERVAL 1 DAY, TIMESTAMP '9999-12-31') AS realtime_end, value FROM (
  SELECT l_suppkey, l_shipdate, max(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2)),
m AS (SELECT o_orderkey, s_suppkey AS l_suppkey, o_orderdate AS at FROM orders JOIN supplier ON s_suppkey = o_custkey)
SELECT m.o_orderkey, m.l_suppkey, m.at, o.realtime_start, round(o.value, 6) AS value FROM m JOIN o
ON o.l_suppkey = m.l_suppkey AND o.realtime_start <= m.at AND m.at <= o.realtime_end"""
)
def known_at(t):
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy("realtime_start")
    # At most one row per supplier and day, so the window is bounded by the calendar.
    values = t.lineitem.groupBy("l_suppkey", F.col("l_shipdate").alias("realtime_start")).agg(F.max("l_extendedprice").alias("value"))
    until = F.lead("realtime_start").over(w) - F.expr("INTERVAL 1 DAY")
    observed = values.withColumn("realtime_end", F.coalesce(until, F.lit("9999-12-31").cast("timestamp_ntz")))
    moments = t.orders.join(t.supplier, F.col("s_suppkey") == F.col("o_custkey")).select(
        "o_orderkey", F.col("s_suppkey").alias("l_suppkey"), F.col("o_orderdate").alias("at")
    )
    out = catalogue.known_at(moments, observed, ["l_suppkey"], "at")
    return out.select("o_orderkey", "l_suppkey", "at", "realtime_start", "value")


# --- cleaning --------------------------------------------------------------------------------------------

_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate"


def _dedup_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("l_linenumber", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice"))
    return f"""SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {order}) AS k FROM lineitem)
WHERE k = 1"""


_DEDUP_ORDER = ["l_linenumber", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(_dedup_sql("ASC"))
def dedup_keep_first(t):
    return clean.keep_one(t.lineitem, ["l_orderkey", "l_partkey"], _DEDUP_ORDER).select(*_LINE.split(", "))


@query(_dedup_sql("DESC"))
def dedup_keep_last(t):
    return clean.keep_one(t.lineitem, ["l_orderkey", "l_partkey"], _DEDUP_ORDER, "last").select(*_LINE.split(", "))


@query(
    """SELECT user_id, event_type, props, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, props
  ORDER BY ts, event_id) AS k FROM events) WHERE k = 1"""
)
def dedup_ignoring_time(t):
    rows = t.events.select("user_id", "event_type", "props", "ts", "event_id")
    return clean.drop_duplicates(rows, ["ts", "event_id"])


@query(
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS price,
  CAST(o_orderdate AS VARCHAR) AS date, CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN '.5' ELSE '' END AS volume FROM orders)
SELECT o_orderkey, round(TRY_CAST(price AS DOUBLE), 6) AS price, TRY_CAST(date AS TIMESTAMP) AS date,
  CASE WHEN volume NOT LIKE '%.5' THEN TRY_CAST(volume AS BIGINT) END AS volume FROM r"""
)
def coercion(t):
    text = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 250000, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderdate").cast("string").alias("date"),
        F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderstatus") == "P", ".5").otherwise("")).alias("volume"),
    )
    return clean.coerce(text, {"price": "float", "date": "datetime", "volume": "int"})


@query(
    """SELECT o_orderstatus, 'price' AS "column", count_if(o_totalprice > 250000)::BIGINT AS lost FROM orders GROUP BY 1"""
)
def coercion_losses(t):
    text = t.orders.select(
        "o_orderstatus",
        F.when(F.col("o_totalprice") > 250000, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )
    return clean.coercion_losses(text, {"price": "float"}, ["o_orderstatus"])


def _holes(t):
    return t.events.select(
        "user_id",
        "event_id",
        "ts",
        F.when(F.col("value") >= 5, F.col("value")).alias("v"),
        F.when(F.col("value") <= 120, F.col("event_type")).alias("label"),
    )


@query(
    """WITH h AS (SELECT user_id, event_id, CASE WHEN value >= 5 THEN value END AS v, CASE WHEN value <= 120 THEN event_type END AS label FROM events),
s AS (SELECT user_id, median(v) AS med, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS mv,
        avg(CASE WHEN label IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS ml FROM h GROUP BY 1),
c AS (SELECT user_id, label, count(*) AS n FROM h WHERE label IS NOT NULL GROUP BY 1, 2),
m AS (SELECT user_id, label AS mode FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, label) AS k FROM c) WHERE k = 1)
SELECT h.user_id, h.event_id, round(CASE WHEN mv <= 0.1 THEN coalesce(v, med) ELSE v END, 6) AS v,
  CASE WHEN ml <= 0.1 THEN coalesce(label, mode) ELSE label END AS label
FROM h JOIN s ON s.user_id = h.user_id LEFT JOIN m ON m.user_id = h.user_id"""
)
def impute_median_mode(t):
    out = clean.impute(_holes(t), series("user_id", "ts", "event_id"), ["v", "label"])
    return out.select("user_id", "event_id", "v", "label")


@query(
    """SELECT user_id, round(avg(CASE WHEN value < 5 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS v_missing,
  round(avg(CASE WHEN value > 120 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS label_missing FROM events GROUP BY 1"""
)
def missing_ratios(t):
    return clean.missing_ratios(_holes(t), ["user_id"], ["v", "label"])


@query(
    """WITH q AS (SELECT user_id, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events GROUP BY 1)
SELECT e.user_id, e.event_id, round(least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a)), 6) AS value
FROM events e JOIN q ON q.user_id = e.user_id"""
)
def iqr_clip(t):
    return clean.cap_outliers(t.events.select("user_id", "event_id", "value"), ["user_id"], ["value"])


@query(
    """WITH q AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1)
SELECT e.event_id, round((value - m) / s, 6) AS value_zscore, abs((value - m) / s) > 3 AS value_anomaly
FROM events e JOIN q ON q.event_type = e.event_type"""
)
def zscore_flags(t):
    flagged = clean.zscore_flags(t.events, ["event_type"], ["value"])
    return flagged.select("event_id", "value_zscore", "value_anomaly")


@query(
    """SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.25), 4) AS l_extendedprice_p25, round(median(l_extendedprice), 4)
  AS l_extendedprice_p50, round(quantile_cont(l_quantity, 0.75), 4) AS l_quantity_p75 FROM lineitem GROUP BY 1"""
)
def exact_quantiles(t):
    out = stats.quantiles(t.lineitem, ["l_suppkey"], {"l_extendedprice": [0.25, 0.5], "l_quantity": [0.75]})
    return out.select("l_suppkey", *[F.round(c, 4).alias(c) for c in out.columns if c != "l_suppkey"])


@query(
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS l_extendedprice_p25, round(median(l_extendedprice), 4)
  AS l_extendedprice_p50 FROM lineitem GROUP BY 1"""
)
def sketched_quantiles(t):
    """The path for keys too large for one buffer, with too many distinct values to count."""
    out = stats.quantiles(t.lineitem, ["l_returnflag"], {"l_extendedprice": [0.25, 0.5]}, buffered_rows=1000, counted_values=0)
    return out.select("l_returnflag", *[F.round(c, 4).alias(c) for c in out.columns if c != "l_returnflag"])


@query(
    """SELECT l_returnflag, round(quantile_cont(l_discount, 0.25), 6) AS l_discount_p25, round(median(l_quantity), 6) AS l_quantity_p50,
  round(quantile_cont(l_quantity, 0.9), 6) AS l_quantity_p90 FROM lineitem GROUP BY 1"""
)
def counted_quantiles(t):
    """The path for large keys with few distinct values."""
    wanted = {"l_discount": [0.25], "l_quantity": [0.5, 0.9]}
    return stats.quantiles(t.lineitem, ["l_returnflag"], wanted, buffered_rows=1000)


@query(
    """WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_quantity AS l_quantity_mode FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) AS k FROM c)
WHERE k = 1"""
)
def exact_modes(t):
    return stats.modes(t.lineitem, ["l_suppkey"], ["l_quantity"])


# --- standardising ---------------------------------------------------------------------------------------------


@query(
    f"""WITH {DAILY} SELECT symbol, ts AS timestamp, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
  round(close, 6) AS close, volume, 'x' AS net_change FROM bars"""
)
def column_alias(t):
    renamed = bars_of(t, "1d").toDF("Ticker", "DateTime", "Open-Price", "HIGH", "low_price", "Closing Price", "Vol")
    return standardize.rename(renamed.withColumn("Net Change (%)", F.lit("x")).withColumnRenamed("Net Change (%)", "Net Change%"))


_SYMBOL = "concat(upper(p_type), CASE WHEN p_size < 12 THEN '.US' WHEN p_size < 24 THEN '-USD' WHEN p_size < 36 THEN '/USD' ELSE ' ' END)"
_BARE = f"regexp_replace(upper(trim({_SYMBOL})), '(\\.US|\\.O|\\.N|\\.TO|\\.V|\\.AX|\\.L|\\.DE)$', '')"


@query(
    f"""WITH b AS (SELECT p_partkey, {_BARE} AS stock FROM part), c AS (SELECT *, replace(replace(stock, '-', ''), '/', '') AS bare FROM b)
SELECT p_partkey, stock, CASE WHEN bare NOT LIKE '%USDT' AND length(bare) <= 6 THEN bare || 'USDT' ELSE bare END AS crypto,
  replace(stock, '/', '') AS forex FROM c"""
)
def symbol_normalise(t):
    size = F.col("p_size")
    suffix = F.when(size < 12, ".US").when(size < 24, "-USD").when(size < 36, "/USD").otherwise(" ")
    raw = t.part.select("p_partkey", F.concat(F.upper("p_type"), suffix).alias("symbol"))
    return raw.select(
        "p_partkey",
        scalar.clean_symbol("symbol").alias("stock"),
        scalar.clean_symbol("symbol", "crypto").alias("crypto"),
        scalar.clean_symbol("symbol", "forex").alias("forex"),
    )


_UNIT = "CASE WHEN p_size < 10 THEN ' Percent ' WHEN p_size < 20 THEN '%' WHEN p_size < 30 THEN 'US Dollars' WHEN p_size < 40 THEN '$' ELSE 'Index' END"


@query(
    f"""SELECT p_partkey, CASE lower(trim({_UNIT})) WHEN 'percent' THEN 'percentage' WHEN '%' THEN 'percentage' WHEN 'us dollars' THEN 'usd'
  WHEN '$' THEN 'usd' ELSE 'index' END AS unit FROM part"""
)
def unit_normalise(t):
    size = F.col("p_size")
    raw = F.when(size < 10, " Percent ").when(size < 20, "%").when(size < 30, "US Dollars").when(size < 40, "$").otherwise("Index")
    return t.part.select("p_partkey", scalar.clean_unit(raw).alias("unit"))


_FUND = "concat(CASE WHEN p_size < 10 THEN 'SPDR S&P ' WHEN p_size < 20 THEN 'Technology ' WHEN p_size < 30 THEN 'Energy ' WHEN p_size < 40 THEN 'iShares ' ELSE '' END, p_name)"


def _fund_sql() -> str:
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains(n, '{w}')" for w in words) + f" THEN '{category}'"
        for category, words in schemas.FUND_RULES
    )
    return f"WITH f AS (SELECT p_partkey, lower({_FUND}) AS n FROM part) SELECT p_partkey, CASE {branches} ELSE 'other' END AS category FROM f"


@query(_fund_sql())
def fund_classify(t):
    size = F.col("p_size")
    prefix = F.when(size < 10, "SPDR S&P ").when(size < 20, "Technology ").when(size < 30, "Energy ").when(size < 40, "iShares ").otherwise("")
    return t.part.select("p_partkey", scalar.fund_category(F.concat(prefix, F.col("p_name"))).alias("category"))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price, concat(format('{:.1f}', round(o_custkey / 100.0, 1)), '%') AS label FROM orders")
def number_text(t):
    return t.orders.select(
        "o_orderkey",
        scalar.parse_number(F.format_number("o_totalprice", 2)).alias("price"),
        F.concat(F.format_string("%.1f", F.round(F.col("o_custkey") / 100.0, 1)), F.lit("%")).alias("label"),
    )


_CURRENCY = "CASE n_nationkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'XXX' END"


@query(
    f"""WITH c AS (SELECT o_orderkey, o_totalprice, {_CURRENCY} AS currency FROM orders JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey)
SELECT o_orderkey, currency, round(o_totalprice / CASE currency WHEN 'EUR' THEN 0.85 WHEN 'GBP' THEN 0.73 WHEN 'JPY' THEN 110.0 ELSE 1.0 END, 6)
  AS usd FROM c"""
)
def currency_to_usd(t):
    place = F.element_at(F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY", "XXX")]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return joined.select("o_orderkey", place.alias("currency"), scalar.to_usd("o_totalprice", place).alias("usd"))


@query(
    """SELECT event_id, round(CASE WHEN event_type = 'click' THEN (value - 32) * 5 / 9 ELSE value END, 6) AS temperature,
  round(CASE WHEN event_type = 'click' THEN user_id * 0.44704::DOUBLE ELSE user_id::DOUBLE END, 6) AS wind_speed, 'metric' AS units FROM events"""
)
def imperial_to_metric(t):
    w = t.events.select(
        "event_id", F.col("value").alias("temperature"), F.col("user_id").cast("double").alias("wind_speed"),
        F.when(F.col("event_type") == "click", "imperial").otherwise("metric").alias("units"),
    )
    return standardize.set_units(w, "weather")


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
  hour(o_orderdate) AS hour, minute(o_orderdate) AS minute, isodow(o_orderdate) - 1 AS day_of_week, dayofyear(o_orderdate) AS day_of_year,
  week(o_orderdate) AS week_of_year FROM orders"""
)
def time_parts(t):
    return t.orders.select("o_orderkey", *[e.alias(n) for n, e in scalar.time_parts("o_orderdate").items()])


@query(
    """SELECT o_orderkey, isodow(o_orderdate) - 1 AS day_of_week, day(o_orderdate) AS day_of_month, month(o_orderdate) AS month,
  quarter(o_orderdate) AS quarter, year(o_orderdate) AS year, CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS is_month_end,
  CAST(o_orderdate AS DATE) = last_day(o_orderdate) AND month(o_orderdate) IN (3, 6, 9, 12) AS is_quarter_end,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, isodow(o_orderdate) >= 6 AS is_weekend FROM orders"""
)
def calendar_features(t):
    return t.orders.select(
        "o_orderkey",
        *[e.alias(n) for n, e in scalar.calendar_features("o_orderdate").items()],
        scalar.season("o_orderdate").alias("season"),
        scalar.is_weekend("o_orderdate").alias("is_weekend"),
    )


@query(
    """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week,
  CAST(date_trunc('month', ts) AS TIMESTAMP) AS month FROM events"""
)
def start_floor(t):
    return t.events.select(
        "event_id", scalar.floor_start("ts", "D1").alias("day"), scalar.floor_start("ts", "W1").alias("week"),
        scalar.floor_start("ts", "MN1").alias("month"),
    )


@query(
    """SELECT event_id, ts AS parsed, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS from_millis,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS from_seconds FROM events"""
)
def time_parsing(t):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        scalar.parse_time(F.col("ts").cast("string")).alias("parsed"),
        scalar.parse_time(F.floor(micros / 1000).cast("string")).alias("from_millis"),
        scalar.epoch_seconds(F.floor(micros / 1000000).cast("string")).alias("from_seconds"),
    )


@query(
    """SELECT event_id, CAST(ts + INTERVAL 5 HOUR AS TIMESTAMP) AS event_time FROM events"""
)
def zone_to_utc(t):
    """January has no daylight saving, so New York is five hours behind."""
    return clean.to_utc(t.events.select("event_id", F.col("ts").alias("event_time")), "America/New_York")


@query(
    """SELECT o_orderkey, substr(p, 1, 3) AS base, substr(p, 4) AS quote, concat('C:', p) AS ticker FROM (
  SELECT o_orderkey, concat(substr(o_orderpriority, 3, 3), 'USD') AS p FROM orders)"""
)
def pair_symbols(t):
    pair = scalar.pair_symbol(F.substring("o_orderpriority", 3, 3), F.lit("USD"))
    named = t.orders.select("o_orderkey", pair.alias("pair"))
    return named.select(
        "o_orderkey", scalar.base_currency("pair").alias("base"), scalar.quote_currency("pair").alias("quote"),
        scalar.pair_ticker("pair").alias("ticker"),
    )


@query(
    f"""WITH {HOURLY}, g AS (SELECT symbol, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY symbol ORDER BY ts)) / 1e6 AS gap FROM bars),
m AS (SELECT symbol, median(gap) AS m FROM g WHERE gap IS NOT NULL GROUP BY 1),
b AS (SELECT bars.*, m <= 3600 AS fine, CASE WHEN m <= 3600 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) ELSE ts END AS bin
  FROM bars JOIN m ON m.symbol = bars.symbol)
SELECT upper(symbol) AS symbol, bin AS timestamp, CAST(bin AS DATE) AS date, round(arg_min(open, ts) / 0.85, 6) AS open, round(max(high) / 0.85, 6) AS high,
  round(min(low) / 0.85, 6) AS low, round(arg_max(close, ts) / 0.85, 6) AS close, CAST(sum(volume) AS DOUBLE) AS volume, 'USD' AS currency, '1d' AS granularity,
  'stock' AS data_type FROM b GROUP BY ALL"""
)
def standardize_stock(t):
    """Hourly euro bars with foreign names to dollar bars; symbols with hourly rows become daily."""
    raw = bars_of(t, "1h").toDF("Ticker", "DateTime", "Open", "High", "Low", "Close", "Vol")
    raw = raw.withColumns({"Ticker": F.concat("Ticker", F.lit(".US")), "Currency": F.lit("EUR"), "Vol": F.col("Vol").cast("double")})
    out = standardize.standardize(raw, "stock")
    return out.select(
        "symbol", "timestamp", "date", "open", "high", "low", "close", "volume", "currency", "granularity", "data_type"
    )


# --- dimensions and facts -------------------------------------------------------------------------------------


@query(
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS date, isodow(d) - 1 AS day_of_week, day(d) AS day_of_month,
  month(d) AS month, quarter(d) AS quarter, year(d) AS year, CAST(d AS DATE) = last_day(d) AS is_month_end,
  CAST(d AS DATE) = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end, count(o_orderkey) AS orders
FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d) c
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY ALL"""
)
def date_dim(t):
    days = star.date_dim(t.spark, "1995-01-01", "2001-12-31")
    counted = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(counted, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("SELECT p_brand, p_type, round(max(p_retailprice), 6) AS p_retailprice FROM part GROUP BY 1, 2")
def asset_dim(t):
    return star.dim(t.part, ["p_brand", "p_type"], ["p_retailprice"], "asset_key").drop("asset_key")


VERSIONS = """d AS (SELECT o_custkey, o_orderdate, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1, 2),
c AS (SELECT *, lag(o_orderstatus) OVER w AS b, row_number() OVER w AS k FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
v AS (SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER w AS valid_to, row_number() OVER w AS version
  FROM c WHERE k = 1 OR o_orderstatus <> b WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))"""


def _versions(t, **more):
    return star.dim_versions(t.orders, ["o_custkey"], ["o_orderstatus"], "o_orderdate", "version_key", ["o_orderkey"], **more)


@query(f"WITH {VERSIONS} SELECT * FROM v")
def dim_versions(t):
    return _versions(t).drop("version_key")


@query(f"WITH {VERSIONS} SELECT * FROM v")
def cut_dim_versions(t):
    return _versions(t, rows_per_chunk=20).drop("version_key")


@query(
    f"""WITH {VERSIONS}, f AS (SELECT o_orderkey, o_custkey, o_orderdate - INTERVAL 20 DAY AS moment, o_totalprice FROM orders)
SELECT o_orderkey, f.o_custkey, moment, round(o_totalprice, 6) AS o_totalprice, version, o_orderstatus, version IS NOT NULL AS known,
  CASE WHEN version IS NOT NULL THEN 1 END AS members
FROM f LEFT JOIN v ON v.o_custkey = f.o_custkey AND valid_from <= moment AND (valid_to IS NULL OR moment < valid_to)"""
)
def version_facts(t):
    """Each fact with the version that was valid 20 days before, and how many members have its key."""
    versions = _versions(t)
    facts = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderdate") - F.expr("INTERVAL 20 DAYS")).alias("moment"), "o_totalprice")
    keyed = star.with_version(facts, versions, ["o_custkey"], "moment", "version_key", ["version", "o_orderstatus"])
    members = versions.groupBy("version_key").agg(F.count(F.lit(1)).alias("members"))
    out = keyed.withColumn("known", F.col("version_key") != star.UNKNOWN).join(members, "version_key", "left")
    return out.drop("version_key")


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, p_brand, p_partkey IS NOT NULL AS known,
  CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_key
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON p_partkey = l_partkey"""
)
def fact_lookup(t):
    parts = star.dim(t.part.filter("p_size > 10"), ["p_partkey"], ["p_brand"], "asset_key")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", F.col("l_partkey").alias("p_partkey"))
    keyed = star.with_key(facts, parts, ["p_partkey"], "asset_key")
    named = keyed.join(parts.select("asset_key", "p_brand"), "asset_key", "left")
    return named.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "p_brand", (F.col("asset_key") != star.UNKNOWN).alias("known"),
        star.date_key("l_shipdate").alias("date_key"),
    )


@query(
    """SELECT split, count(*) AS n, round(avg(value), 6) AS mean FROM (SELECT value, CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-20' THEN 'train'
  WHEN CAST(ts AS DATE) <= DATE '2024-01-27' THEN 'test' END AS split FROM events) WHERE split IS NOT NULL GROUP BY 1"""
)
def time_split(t):
    marked = star.split_by_time(t.events, "ts", "2024-01-20", "2024-01-27")
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


@query(
    """SELECT 'momentum' AS model_name, min(d) FILTER (d <= DATE '2024-01-20') AS train_start_date, max(d) FILTER (d <= DATE '2024-01-20') AS train_end_date,
  min(d) FILTER (d > DATE '2024-01-20') AS test_start_date, max(d) FILTER (d > DATE '2024-01-20' AND d <= DATE '2024-01-27') AS test_end_date
FROM (SELECT CAST(ts AS DATE) AS d FROM events)"""
)
def training_sets(t):
    return star.training_sets(t.events, "momentum", "ts", "2024-01-20", "2024-01-27")


@query(
    """SELECT c_custkey, d AS date FROM customer, unnest(generate_series(DATE '2024-01-01', DATE '2024-01-07', INTERVAL 1 DAY)) AS u(d)""".replace(
        "d AS date", "CAST(d AS DATE) AS date"
    )
)
def backfill_plan(t):
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-07").cast("date")
    return jobs.backfill_plan(t.customer.select("c_custkey"), first, last)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t):
    return t.events.select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query(
    """SELECT event_id, to_json({event_id: event_id, event_type: event_type, value: value,
  ts: strftime(ts, '%Y-%m-%dT%H:%M:%SZ')}) AS record FROM events"""
)
def serialised_rows(t):
    from tidemark.sinks.tables import as_json

    rows = t.events.select("event_id", "event_type", "value", "ts")
    out = as_json(rows)
    return out.select(F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"), "record")


@query(
    """SELECT o_orderkey, concat(p, '/EUR') AS quoted, p AS symbol FROM (SELECT o_orderkey, substr(o_orderpriority, 3, 3) AS p FROM orders)"""
)
def quote_substitution(t):
    bare = F.substring("o_orderpriority", 3, 3)
    return t.orders.select("o_orderkey", scalar.with_quote(F.concat(bare, F.lit("/USD")), "EUR").alias("quoted"), bare.alias("symbol"))


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1998-07-01'"""
)
def released_on(t):
    dated = t.orders.withColumn("data_release_date", F.to_date(F.date_trunc("month", "o_orderdate")))
    return catalogue.released_on(dated, F.lit("1998-07-01").cast("date")).select("o_orderkey", "o_custkey")


@query(
    """SELECT user_id, event_id, CASE WHEN user_id < 50 THEN 'Japan' WHEN user_id < 100 THEN 'UK' ELSE 'Unknown' END AS region,
  CASE WHEN user_id < 50 THEN 'price_weighted' WHEN user_id < 100 THEN 'market_cap_weighted' ELSE 'Unknown' END AS index_type FROM events"""
)
def index_metadata(t):
    from tidemark.sources.payloads import with_index_metadata

    user = F.col("user_id")
    named = t.events.select("user_id", "event_id", F.when(user < 50, "N225").when(user < 100, "FTSE").otherwise("X").alias("symbol"))
    return with_index_metadata(named).drop("symbol")


@query(
    """SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')"""
)
def universe_filter(t):
    """Semi-join with the listed items."""
    listed = t.events.select("event_type").distinct().filter(F.col("event_type").isin("click", "view"))
    return t.events.join(listed, "event_type", "left_semi").select("event_id", "event_type")


def _cleaned_sql(same: str) -> str:
    return f"""WITH r AS (SELECT event_type, user_id, ts, event_id, CASE WHEN value >= 2 THEN value END AS price FROM events),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {same} ORDER BY event_id, ts) AS k FROM r) WHERE k = 1),
m AS (SELECT event_type, median(price) AS med, avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS miss FROM u GROUP BY 1)
SELECT u.event_type, u.user_id, ts, round(CASE WHEN miss <= 0.1 THEN coalesce(price, med) ELSE price END, 6) AS price FROM u JOIN m ON m.event_type = u.event_type"""


PRICE_KINDS = {"price": "float", "ts": "datetime"}


def _text_prices(t):
    return t.events.select(
        "event_type", "user_id", "ts", F.col("event_id").alias("_seq"),
        F.when(F.col("value") >= 2, F.col("value").cast("string")).otherwise("n/a").alias("price"),
    )


@query(_cleaned_sql("event_type, user_id, price, ts"))
def clean_pipeline(t):
    """Text prices through the whole cleaner: repeats, types, nulls, UTC."""
    out = clean.clean(_text_prices(t), PRICE_KINDS, series("event_type", "ts", "_seq"))
    return out.select("event_type", "user_id", "ts", "price")


@query(_cleaned_sql("event_type, user_id, price"))
def clean_without_times(t):
    """The same where rows that differ in their time alone are one row."""
    one = clean.drop_duplicates(_text_prices(t), ["_seq", "ts"])
    out = clean.to_utc(clean.impute(clean.coerce(one, PRICE_KINDS), series("event_type", "ts", "_seq")))
    return out.select("event_type", "user_id", "ts", "price")
