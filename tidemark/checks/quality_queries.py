"""Validation, weather and sentiment over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.base import query
from tidemark.checks.table_queries import runs
from tidemark.operators import bars, clean, sentiment, validate, weather
from tidemark.operators.series import series
from tidemark.session import small, stage

# Line items as bars: quantity, price, discount and tax stand for open, high, low and close.
LINE_RULES = {
    "numeric": ("open", "high", "low", "close"),
    "positive": ("open", "close"),
    "ranges": {"open": {"min": 2, "max": 49}, "high": {"min": 1000, "max": 90000}},
    "consistency": (("low", ">=", "close"), ("open", "<=", "high")),
    "unique": ("timestamp", "symbol"),
}
LINE = series("symbol", "timestamp", ("l_orderkey", "l_linenumber"))
NOW = "2000-01-01"


def lines(t):
    return t.lineitem.select(
        F.col("l_suppkey").alias("symbol"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_quantity") > 2, F.col("l_quantity")).alias("open"),
        F.col("l_extendedprice").alias("high"),
        F.col("l_discount").alias("low"),
        F.col("l_tax").alias("close"),
        "l_orderkey",
        "l_linenumber",
    )


_LINES = """l AS (SELECT l_suppkey AS symbol, l_shipdate AS timestamp, CASE WHEN l_quantity > 2 THEN l_quantity END AS open,
  l_extendedprice AS high, l_discount AS low, l_tax AS close, l_orderkey, l_linenumber FROM lineitem)"""


def _emit(name: str, level: str, passed: str, count: str) -> str:
    return f"SELECT symbol, '{name}' AS check_name, '{level}' AS level, {passed} AS passed, CAST({count} AS BIGINT) AS violations FROM w WHERE {count} > 0"


def _z(c: str) -> str:
    return f"""SELECT l.symbol, 'anomalies_{c}' AS check_name, 'WARNING' AS level, true AS passed, count(*) AS violations
FROM l JOIN (SELECT symbol, avg({c}) AS m, stddev_samp({c}) AS s FROM l GROUP BY 1) z ON z.symbol = l.symbol
WHERE s > 0 AND abs((l.{c} - m) / s) > 3 GROUP BY 1"""


RESULTS_SQL = f"""{_LINES},
w AS (SELECT symbol, count(*) AS n, count_if(open IS NULL) AS miss, count_if(open < 2) AS o_lo, count_if(open > 49) AS o_hi,
  count_if(high < 1000) AS h_lo, count_if(high > 90000) AS h_hi, count_if(low < close) AS lc, count_if(open > high) AS oh,
  count_if(timestamp > TIMESTAMP '{NOW}' + INTERVAL 1 DAY) AS fut FROM l GROUP BY 1),
d AS (SELECT symbol, timestamp, count(*) AS n FROM l GROUP BY 1, 2 HAVING count(*) > 1),
g AS (SELECT symbol, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY symbol ORDER BY timestamp, l_orderkey, l_linenumber)) / 1e6 AS gap FROM l),
gm AS (SELECT symbol, median(gap) AS m FROM g WHERE gap IS NOT NULL GROUP BY 1),
r AS (
  SELECT symbol, 'required_columns' AS check_name, 'INFO' AS level, true AS passed, CAST(0 AS BIGINT) AS violations FROM w
  UNION ALL SELECT symbol, 'missing_values_open', CASE WHEN miss / n <= 0.1 THEN 'WARNING' ELSE 'ERROR' END, miss / n <= 0.1, CAST(miss AS BIGINT) FROM w WHERE miss > 0
  UNION ALL {_emit('range_min_open', 'ERROR', 'false', 'o_lo')} UNION ALL {_emit('range_max_open', 'ERROR', 'false', 'o_hi')}
  UNION ALL {_emit('range_min_high', 'ERROR', 'false', 'h_lo')} UNION ALL {_emit('range_max_high', 'ERROR', 'false', 'h_hi')}
  UNION ALL {_emit('consistency_low_gte_close', 'ERROR', 'false', 'lc')} UNION ALL {_emit('consistency_open_lte_high', 'ERROR', 'false', 'oh')}
  UNION ALL {_emit('future_timestamps', 'WARNING', 'true', 'fut')}
  UNION ALL {_z('open')} UNION ALL {_z('high')} UNION ALL {_z('low')} UNION ALL {_z('close')}
  UNION ALL SELECT symbol, 'duplicate_records', 'ERROR', false, CAST(sum(n) AS BIGINT) FROM d GROUP BY 1
  UNION ALL SELECT g.symbol, 'time_gaps', 'WARNING', true, count(*) FROM g JOIN gm ON gm.symbol = g.symbol WHERE gap > 2 * m GROUP BY 1)"""


def line_results(t):
    now = F.lit(NOW).cast("timestamp")
    return validate.results(lines(t), "stock", LINE, rules=LINE_RULES, required=("symbol", "timestamp"), now=now)


@query(f"WITH {RESULTS_SQL} SELECT * FROM r")
def dq_results(t):
    return line_results(t).drop("detail")


SUMMARY_SQL = """s AS (SELECT symbol, count(*) AS total_checks, count_if(passed)::BIGINT AS passed_checks,
  count_if(level = 'WARNING' AND NOT passed)::BIGINT AS failed_warning, count_if(level = 'ERROR' AND NOT passed)::BIGINT AS failed_error,
  count_if(level = 'CRITICAL' AND NOT passed)::BIGINT AS failed_critical FROM r GROUP BY 1)"""


@query(
    f"""WITH {RESULTS_SQL}, {SUMMARY_SQL} SELECT *, round(passed_checks / total_checks, 6) AS pass_rate,
  passed_checks / total_checks >= 0.5 AND failed_critical = 0 AS is_valid FROM s"""
)
def dq_summary(t):
    return validate.summary(line_results(t), ["symbol"], pass_rate=0.5)


@query(
    f"""WITH {RESULTS_SQL}, {SUMMARY_SQL}, f AS (SELECT symbol, passed_checks / total_checks >= 0.5 AS valid FROM s),
h AS (SELECT symbol, bool_or(check_name = 'range_min_open') AS a, bool_or(check_name = 'range_max_open') AS b,
  bool_or(check_name = 'range_min_high') AS c, bool_or(check_name = 'range_max_high') AS d FROM r GROUP BY 1)
SELECT l.symbol, l.l_orderkey, l.l_linenumber FROM l JOIN f USING (symbol) JOIN h USING (symbol)
WHERE valid OR ((NOT a OR coalesce(open >= 2, false)) AND (NOT b OR coalesce(open <= 49, false))
  AND (NOT c OR high >= 1000) AND (NOT d OR high <= 90000))"""
)
def dq_filtered(t):
    checks = validate.pin(line_results(t))
    kept = validate.filter_invalid(lines(t), checks, "stock", LINE, LINE_RULES, pass_rate=0.5)
    return kept.select("symbol", "l_orderkey", "l_linenumber")


@query(
    f"""WITH {RESULTS_SQL} SELECT symbol, concat('[', level, '] ', check_name, ': ', CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END,
  ' (', violations, ')') AS report FROM r"""
)
def dq_report(t):
    return validate.report(line_results(t), ["symbol"], as_json=False)


@query(
    f"""WITH {RESULTS_SQL} SELECT 'lineitem' AS table_name, check_name AS metric_name, count(*) AS n, round(sum(violations), 6)::DOUBLE AS total FROM r GROUP BY ALL"""
)
def dq_metrics(t):
    rows = validate.metrics(line_results(t), "lineitem", F.lit("2024-01-01").cast("date"))
    return rows.groupBy("table_name", "metric_name").agg(F.count(F.lit(1)).alias("n"), F.sum("metric_value").alias("total"))


LINE_CHECKS = {
    "quantity_positive": "l_quantity > 1",
    "discount_range": "l_discount BETWEEN 0 AND 0.09",
    "tax_below_discount": "l_tax <= l_discount + 0.05",
    "flag_known": "l_returnflag IN ('A', 'N')",
}


@query(
    """WITH f AS (SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN NOT l_quantity > 1 THEN 'quantity_positive' END,
  CASE WHEN NOT l_discount BETWEEN 0 AND 0.09 THEN 'discount_range' END, CASE WHEN NOT l_tax <= l_discount + 0.05::DOUBLE THEN 'tax_below_discount' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag_known' END], lambda x: x IS NOT NULL) AS c, l_partkey FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(c, ',') AS failed_checks FROM f WHERE len(c) > 0"""
)
def quarantine_split(t):
    _, invalid = validate.quarantine(t.lineitem, "lineitem", LINE_CHECKS)
    return invalid.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("failed_checks", ",").alias("failed_checks"))


@query(
    """SELECT count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem WHERE l_quantity > 1 AND l_discount BETWEEN 0 AND 0.09
  AND l_tax <= l_discount + 0.05::DOUBLE AND l_returnflag IN ('A', 'N')"""
)
def valid_rows(t):
    valid, _ = validate.quarantine(t.lineitem, "lineitem", LINE_CHECKS)
    return valid.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(
    """WITH r AS (SELECT event_type AS pipeline_id, ts AS start_time, event_id AS run_id, value > 60 AS bad FROM events),
l AS (SELECT pipeline_id, max(CASE WHEN NOT bad THEN start_time END) AS last_success, count(*) AS runs, avg(CAST(bad AS INT)) AS error_rate FROM r GROUP BY 1)
SELECT l.pipeline_id, runs, round(error_rate, 6) AS error_rate, last_success,
  (SELECT count(*) FROM r WHERE r.pipeline_id = l.pipeline_id AND r.start_time > coalesce(l.last_success, TIMESTAMP '1900-01-01')) AS consecutive_failures,
  error_rate > 0.05 AS high_error_rate,
  (SELECT count(*) FROM r WHERE r.pipeline_id = l.pipeline_id AND r.start_time > coalesce(l.last_success, TIMESTAMP '1900-01-01')) >= 3 AS failing FROM l"""
)
def source_alerts(t):
    failed = runs(t).withColumn("failed", F.col("status") == "failed")
    return validate.source_status(failed, "pipeline_id", "start_time", "failed")


@query(
    """WITH g AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap FROM events),
m AS (SELECT user_id, median(gap) AS m FROM g WHERE gap IS NOT NULL GROUP BY 1)
SELECT CASE WHEN m <= 60 THEN '1m' WHEN m <= 300 THEN '5m' WHEN m <= 900 THEN '15m'
  WHEN m <= 1800 THEN '30m' WHEN m <= 3600 THEN '1h' WHEN m <= 86400 THEN '1d' WHEN m <= 604800 THEN '1w'
  WHEN m <= 2592000 THEN '1M' ELSE 'custom' END AS granularity, count(*) AS n FROM m GROUP BY 1"""
)
def frequency_check(t):
    found = bars.granularity(t.events, series("user_id", "ts", "event_id"))
    return found.groupBy("granularity").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH f AS (SELECT event_type, CASE WHEN value >= 5 THEN value END AS price, CASE WHEN value > 200 THEN -1 ELSE user_id END AS volume FROM events),
z AS (SELECT event_type, avg(price) AS mp, stddev_samp(price) AS sp, avg(volume) AS mv, stddev_samp(volume) AS sv FROM f GROUP BY 1)
SELECT event_type, 'null price' AS problem, count(*) AS "rows" FROM f WHERE price IS NULL GROUP BY 1
UNION ALL SELECT event_type, 'negative volume', count(*) FROM f WHERE volume < 0 GROUP BY 1
UNION ALL SELECT event_type, 'missing column close', 1 FROM z
UNION ALL SELECT f.event_type, 'anomaly price', count(*) FROM f JOIN z USING (event_type) WHERE abs((price - mp) / sp) > 3 GROUP BY 1
UNION ALL SELECT f.event_type, 'anomaly volume', count(*) FROM f JOIN z USING (event_type) WHERE abs((volume - mv) / sv) > 3 GROUP BY 1"""
)
def cleaner_problems(t):
    rows = t.events.select(
        "event_type",
        F.when(F.col("value") >= 5, F.col("value")).alias("price"),
        F.when(F.col("value") > 200, -1).otherwise(F.col("user_id")).alias("volume"),
    )
    return clean.problems(rows, {"price": "float", "close": "float"}, ["event_type"])


# --- weather ---------------------------------------------------------------------------------------------


def hourly_weather(t):
    """Events as hourly observations: value as temperature, user as humidity, parity of props as rain."""
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.select(
        F.col("event_type").alias("location"),
        F.col("ts").alias("timestamp"),
        "event_id",
        (F.col("value") / 5 - 5).alias("temperature"),
        (F.col("user_id") * 0.6).alias("humidity"),
        (k / 4).alias("wind_speed"),
        (k / 50).alias("rain_1h"),
        F.when(k < 30, "Clear").when(k < 60, "Clouds").otherwise("Rain").alias("weather_main"),
        F.lit("metric").alias("units"),
    )


_WEATHER = """h AS (SELECT event_type AS location, ts AS timestamp, event_id, value / 5 - 5 AS temperature, user_id * 0.6::DOUBLE AS humidity,
  CAST(json_extract(props, '$.k') AS DOUBLE) / 4 AS wind_speed, CAST(json_extract(props, '$.k') AS DOUBLE) / 50 AS rain_1h,
  CASE WHEN CAST(json_extract(props, '$.k') AS DOUBLE) < 30 THEN 'Clear' WHEN CAST(json_extract(props, '$.k') AS DOUBLE) < 60 THEN 'Clouds' ELSE 'Rain' END
  AS weather_main FROM events),
c AS (SELECT CAST(timestamp AS DATE) AS date, location, weather_main, count(*) AS n FROM h GROUP BY ALL),
m AS (SELECT date, location, weather_main FROM (SELECT *, row_number() OVER (PARTITION BY date, location ORDER BY n DESC, weather_main) AS k FROM c) WHERE k = 1),
d AS (SELECT CAST(timestamp AS DATE) AS date, location, 'metric' AS units, min(temperature) AS tmin, max(temperature) AS tmax, avg(temperature) AS tavg,
  avg(humidity) AS havg, max(wind_speed) AS wmax, avg(wind_speed) AS wavg, sum(rain_1h) AS rain FROM h GROUP BY ALL)"""
_DAILY_WEATHER = """d.date, d.location, units, round(tmin, 6) AS temperature_daily_min, round(tmax, 6) AS temperature_daily_max,
  round(tavg, 6) AS temperature_daily_avg, round(havg, 6) AS humidity_daily_avg, round(wmax, 6) AS wind_speed_daily_max,
  round(wavg, 6) AS wind_speed_daily_avg, round(rain, 6) AS rain_1h_daily_total, weather_main AS weather_main_mode"""


@query(f"WITH {_WEATHER} SELECT {_DAILY_WEATHER} FROM d JOIN m ON m.date = d.date AND m.location = d.location")
def weather_daily(t):
    return weather.daily(hourly_weather(t))


_HEAT = """CASE WHEN tavg < 26.7 THEN tavg ELSE -42.379::DOUBLE + 2.04901523::DOUBLE * tavg + 10.14333127::DOUBLE * havg - 0.22475541::DOUBLE * tavg * havg - 6.83783e-3 * tavg * tavg
  - 5.481717e-2 * havg * havg + 1.22874e-3 * tavg * tavg * havg + 8.5282e-4 * tavg * havg * havg - 1.99e-6 * tavg * tavg * havg * havg END"""
_CHILL = """CASE WHEN tavg > 10 THEN tavg ELSE 13.12::DOUBLE + 0.6215::DOUBLE * tavg - 11.37::DOUBLE * pow(wavg, 0.16) + 0.3965::DOUBLE * tavg * pow(wavg, 0.16) END"""


@query(
    f"""WITH {_WEATHER} SELECT {_DAILY_WEATHER}, round(tmax - tmin, 6) AS temperature_daily_range, round({_HEAT}, 6) AS heat_index,
  round({_CHILL}, 6) AS wind_chill, round(greatest(0, 100 - abs(tavg - 21) * 5) * 0.6::DOUBLE + greatest(0, 100 - abs(havg - 50) * 2) * 0.4::DOUBLE, 6) AS comfort_index,
  round((wmax / 20 + (tmax - tmin) / 15) / 2, 6) AS weather_severity_score,
  CASE WHEN month(d.date) IN (12, 1, 2) THEN 'Winter' WHEN month(d.date) IN (3, 4, 5) THEN 'Spring' WHEN month(d.date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  isodow(d.date) >= 6 AS is_weekend FROM d JOIN m ON m.date = d.date AND m.location = d.location"""
)
def weather_features(t):
    return weather.features(weather.daily(hourly_weather(t)))


@query(
    f"""WITH {_WEATHER} SELECT date, location, round(tmax, 6) AS temperature_daily_max, round(tmin, 6) AS temperature_daily_min FROM d
WHERE tmax > 35 OR tmin < -10"""
)
def extreme_weather(t):
    from tidemark.operators.catalogue import extreme_weather as extreme

    daily = extreme(weather.daily(hourly_weather(t)))
    return daily.select("date", "location", "temperature_daily_max", "temperature_daily_min")


@query(
    """WITH h AS (SELECT event_type AS location, ts, event_id, CASE WHEN value >= 5 THEN value / 5 - 5 END AS temperature,
  CASE WHEN value <= 120 THEN user_id * 0.6::DOUBLE END AS humidity, CASE WHEN value < 60 THEN value / 50 END AS rain_1h FROM events),
f AS (SELECT location, ts, event_id, coalesce(last_value(temperature IGNORE NULLS) OVER (PARTITION BY location ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(temperature IGNORE NULLS) OVER (PARTITION BY location ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS temperature,
  coalesce(humidity, median(humidity) OVER (PARTITION BY location)) AS humidity, coalesce(rain_1h, 0) AS rain_1h FROM h),
q AS (SELECT location, quantile_cont(temperature, 0.25) AS t1, quantile_cont(temperature, 0.75) AS t3, quantile_cont(humidity, 0.25) AS h1,
  quantile_cont(humidity, 0.75) AS h3, quantile_cont(rain_1h, 0.25) AS r1, quantile_cont(rain_1h, 0.75) AS r3 FROM f GROUP BY 1)
SELECT location, event_id, round(least(greatest(least(greatest(temperature, t1 - 1.5 * (t3 - t1)), t3 + 1.5 * (t3 - t1)), -50), 60), 6) AS temperature,
  round(least(greatest(least(greatest(humidity, h1 - 1.5 * (h3 - h1)), h3 + 1.5 * (h3 - h1)), 0), 100), 6) AS humidity,
  round(least(greatest(rain_1h, r1 - 1.5 * (r3 - r1)), r3 + 1.5 * (r3 - r1)), 6) AS rain_1h FROM f JOIN q USING (location)"""
)
def weather_clean(t):
    raw = t.events.select(
        F.col("event_type").alias("location"),
        "ts",
        "event_id",
        F.when(F.col("value") >= 5, F.col("value") / 5 - 5).alias("temperature"),
        F.when(F.col("value") <= 120, F.col("user_id") * 0.6).alias("humidity"),
        F.when(F.col("value") < 60, F.col("value") / 50).alias("rain_1h"),
    )
    out = clean.clean_weather(raw, series("location", "ts", "event_id"))
    return out.select("location", "event_id", "temperature", "humidity", "rain_1h")


# --- sentiment -------------------------------------------------------------------------------------------

# The texts are invented, so words that occur in them stand in for opinion words.
LEXICON = {
    **schemas.LEXICON, "with": (0.5, 0.4), "from": (-0.6, 0.8), "this": (0.3, 0.2), "that": (-0.2, 0.1),
    "for": (0.9, 1.0), "was": (-1.0, 0.5), "are": (0.05, 0.0),
}


def _lexicon_sql() -> str:
    return ", ".join(f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, (p, s) in LEXICON.items())


SCORED_SQL = f"""lex(w, p, s) AS (VALUES {_lexicon_sql()}),
w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents),
a AS (SELECT doc_id, avg(p) AS p, avg(s) AS s FROM w JOIN lex USING (w) GROUP BY 1),
sc AS (SELECT d.doc_id, d.source, coalesce(p, 0) AS p, coalesce(s, 0) AS s FROM documents d LEFT JOIN a USING (doc_id))"""
_P = "round(p, 9)"
_LABEL = f"CASE WHEN {_P} > -1 AND {_P} <= -0.1 THEN 'negative' WHEN {_P} > -0.1 AND {_P} <= 0.1 THEN 'neutral' WHEN {_P} > 0.1 AND {_P} <= 1 THEN 'positive' END"


@query(
    f"""WITH {SCORED_SQL} SELECT doc_id, round(p, 9) AS sentiment_polarity, round(s, 9) AS sentiment_subjectivity, {_LABEL} AS sentiment_label FROM sc""",
    digits=9,
)
def sentiment_scores(t):
    scored = sentiment.score(t.documents, "text", LEXICON)
    return scored.select("doc_id", "sentiment_polarity", "sentiment_subjectivity", "sentiment_label")


@query(
    f"""WITH {SCORED_SQL}, g AS (SELECT source, avg(p) AS mean, stddev_samp(p) AS std, count(p) AS n, avg(s) AS sub FROM sc GROUP BY 1)
SELECT sc.doc_id, sc.source, round(p, 9) AS sentiment_polarity, round(g.mean, 9) AS sentiment_polarity_mean, round(g.std, 9) AS sentiment_polarity_std,
  g.n AS sentiment_polarity_count, round(g.sub, 9) AS sentiment_subjectivity_mean FROM sc JOIN g USING (source)""",
    digits=9,
)
def sentiment_daily(t):
    out = sentiment.features(t.documents.select("doc_id", "source", "text"), "text", "source", LEXICON)
    return out.drop("text", "sentiment_subjectivity", "sentiment_label")


# Every fourth document is held out. The label is the quality of a document, the nearest thing to an opinion here.
NEGATING, STRENGTHENING = ("not", "no", "that"), {"very": 1.5, "this": 2.0}
LEARNED_SQL = f"""d AS (SELECT doc_id, doc_id % 4 = 2 AS held_out, quality, regexp_split_to_array(lower(text), '[^a-z]+') AS ws
  FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL),
tot AS (SELECT count_if(quality = 1) AS p, count_if(quality = 0) AS n FROM d WHERE NOT held_out),
dw AS (SELECT DISTINCT doc_id, quality, unnest(ws) AS word FROM d WHERE NOT held_out),
cw AS (SELECT word, count(*) AS texts, count_if(quality = 1) AS wp, count_if(quality = 0) AS wn FROM dw WHERE word <> '' GROUP BY 1 HAVING count(*) >= 5),
lw AS (SELECT word, texts, ln((wp + 1.0::DOUBLE) / (p + 2)) - ln((wn + 1.0::DOUBLE) / (n + 2)) AS weight FROM cw, tot),
e AS (SELECT doc_id, ws, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
f AS (SELECT doc_id, word, CASE WHEN i > 1 AND list_has_any(ws[greatest(i - 3, 1):i - 1], {list(NEGATING)}) THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END
  * CASE WHEN i = 1 THEN 1.0::DOUBLE {" ".join(f"WHEN ws[i - 1] = '{w}' THEN {x}::DOUBLE" for w, x in STRENGTHENING.items())} ELSE 1.0::DOUBLE END AS factor FROM e),
s AS (SELECT doc_id, count(*) AS k, tanh(avg(factor * weight)) AS score FROM f JOIN lw USING (word) GROUP BY 1),
sl AS (SELECT doc_id, held_out, quality, coalesce(k, 0) AS known_words, round(coalesce(score, 0), 6) AS sentiment_score FROM d LEFT JOIN s USING (doc_id))"""


def labelled(t):
    """The documents that have a label. Labels are broadcast if they are counted and found few, else the texts move once."""
    rows = t.documents.join(small(t.labels.select("doc_id", "quality").dropna()), "doc_id").select("doc_id", "text", "quality")
    return rows.dropna().withColumn("held_out", F.col("doc_id") % 4 == 2)


def learned(rows):
    """Word weights from the labelled documents that are not held out."""
    return sentiment.learn(rows.filter(~F.col("held_out")), "text", "quality")


@query(f"WITH {LEARNED_SQL} SELECT word, texts, round(weight, 6) AS weight FROM lw")
def sentiment_weights(t):
    return learned(labelled(t))


@query(f"WITH {LEARNED_SQL} SELECT doc_id, held_out, known_words, sentiment_score FROM sl")
def sentiment_learned(t):
    rows = stage(labelled(t))
    return sentiment.score_learned(rows, ["doc_id", "held_out"], "text", learned(rows), NEGATING, STRENGTHENING).drop("sentiment_label")


@query(
    f"""WITH {LEARNED_SQL} SELECT held_out, count(*) AS n, count_if(quality = 1)::BIGINT AS positive,
  count_if((sentiment_score > 0) = (quality = 1))::BIGINT AS hits FROM sl GROUP BY 1"""
)
def sentiment_accuracy(t):
    """How often the sign of the learned score is that of the label, on documents learned from and on others."""
    rows = stage(labelled(t))
    scored = sentiment.score_learned(rows, ["doc_id", "held_out", "quality"], "text", learned(rows), NEGATING, STRENGTHENING)
    hit = (F.round("sentiment_score", 6) > 0) == (F.col("quality") == 1)
    return scored.groupBy("held_out").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("positive"), F.count_if(hit).alias("hits")
    )
