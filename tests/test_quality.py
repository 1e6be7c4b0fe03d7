from __future__ import annotations

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalogue, sentiment, validate, weather
from tidemark.operators.series import series

T = [dt.datetime(2024, 1, d) for d in range(1, 29)]
S = series("symbol", "timestamp")
DDL = "timestamp timestamp, symbol string, open double, high double, low double, close double, volume double, _seq int"


def good(n, symbol="A"):
    return (T[n], symbol, 10.0, 12.0, 9.0, 11.0, 100.0, n)


def checks_of(df, kind="stock", **options):
    return {r["check_name"]: r for r in validate.results(df, kind, S, **options).collect()}


def test_clean_data_emits_only_the_required_check(frame):
    found = checks_of(frame(DDL, *[good(n) for n in range(5)]))
    assert set(found) == {"required_columns"} and found["required_columns"]["passed"]


def test_each_check_counts(frame):
    rows = [good(n) for n in range(12)]
    rows += [
        (T[12], "A", 10.0, 8.0, 9.0, 11.0, 100.0, 12),  # high below everything
        (T[13], "A", -1.0, 12.0, 9.0, 11.0, -5.0, 13),
        (None, "A", 10.0, 12.0, 9.0, 11.0, None, 14),
        (T[13], "A", 10.0, 12.0, 9.0, 11.0, 100.0, 15),  # repeated time
        (T[27], "A", 10.0, 12.0, 9.0, 11.0, 100.0, 16),  # gap of two weeks
        (dt.datetime(2024, 1, 5, 12), "A", 10.0, 12.0, 9.0, 11.0, 100.0, 17),  # delivered late
    ]
    found = checks_of(frame(DDL, *rows), now=F.lit("2024-01-20").cast("timestamp"))
    n = {name: r["violations"] for name, r in found.items()}
    assert n["consistency_high_gte_low"] == 1 and n["consistency_high_gte_open"] == 1 and n["consistency_high_gte_close"] == 1
    assert n["range_min_open"] == 1 and n["positive_values_open"] == 1 and n["positive_values_volume"] == 1
    assert n["consistency_low_lte_open"] == 1
    assert n["null_timestamps"] == 1 and n["future_timestamps"] == 1 and n["duplicate_records"] == 2
    assert n["missing_values_volume"] == 1 and found["missing_values_volume"]["level"] == "WARNING"
    # the repeated time follows a row without a time, so only the late row is out of order
    assert n["time_gaps"] == 1 and n["chronological_order"] == 1
    assert not found["duplicate_records"]["passed"] and found["time_gaps"]["passed"]


def test_missing_columns_and_text_numbers(frame):
    df = frame("symbol string, close string, timestamp timestamp", ("A", "x", T[0]), ("A", "1", T[1]))
    found = checks_of(df)
    assert not found["required_columns"]["passed"] and "open" in found["required_columns"]["detail"]
    assert found["data_type_close"]["violations"] == 1


def test_many_missing_values_are_an_error(frame):
    rows = [good(n) if n else (T[0], "A", None, 12.0, 9.0, 11.0, 100.0, 0) for n in range(4)]
    assert checks_of(frame(DDL, *rows))["missing_values_open"]["level"] == "ERROR"


def test_anomalies_need_three_values(frame):
    rows = [good(n) for n in range(20)] + [(T[20], "A", 10.0, 12.0, 9.0, 11.0, 1e6, 20)]
    rows += [(T[0], "B", 1.0, 2.0, 1.0, 1.5, 1.0, 0), (T[1], "B", 1.0, 2.0, 1.0, 1.5, 1e9, 1)]
    found = validate.results(frame(DDL, *rows), "stock", S).filter("check_name LIKE 'anomalies%'").collect()
    assert [(r["symbol"], r["check_name"], r["violations"]) for r in found] == [("A", "anomalies_volume", 1)]


@pytest.mark.parametrize(
    "rows, rate, limit, valid",
    [
        ([("a", "INFO", True)] * 4 + [("b", "WARNING", False)], 0.8, 0.95, False),
        ([("a", "INFO", True)] * 4 + [("b", "WARNING", False)], 0.8, 0.75, True),
        ([("a", "INFO", True), ("b", "CRITICAL", False)], 0.5, 0.0, False),
        ([("a", "INFO", True), ("b", "ERROR", False)], 0.5, 0.5, True),
    ],
)
def test_summary(frame, rows, rate, limit, valid):
    df = frame("k string, check_name string, level string, passed boolean", *[("x", *r) for r in rows])
    row = validate.summary(df, ["k"], limit).first()
    assert row["pass_rate"] == rate and row["is_valid"] == valid


def test_invalid_rows_are_filtered_only_for_invalid_series(frame):
    rows = [good(n) for n in range(3)] + [(T[3], "A", -1.0, 12.0, -2.0, 11.0, 100.0, 3), (None, "A", 1.0, 2.0, 1.0, 1.0, 1.0, 4)]
    rows += [good(n, "B") for n in range(3)]
    kept, checks = validate.validate(frame(DDL, *rows), "stock", S)
    assert kept.filter("symbol = 'A'").count() == 3 and kept.filter("symbol = 'B'").count() == 3
    text = [r["report"] for r in validate.report(checks, ["symbol"], as_json=False).collect()]
    assert "[ERROR] range_min_open: FAIL (1)" in text
    assert '"check_name"' in validate.report(checks, ["symbol"]).first()["report"]


def test_row_constraints(frame):
    ddl = "from_currency string, to_currency string, open double, high double, low double, close double, volume bigint"
    df = frame(
        ddl, ("EUR", "USD", 1.0, 2.0, 1.0, 1.5, 1), ("EUR", "EUR", 1.0, 0.5, 1.0, 1.5, -1), ("eur", "USD", None, 2.0, 1.0, 1.5, None),
    )
    valid, invalid = validate.quarantine(df, "forex_rates")
    assert valid.count() == 1
    failed = sorted(tuple(r["failed_checks"]) for r in invalid.collect())
    assert failed == [
        ("currency_codes",),
        ("high_gte_low", "high_gte_open", "high_gte_close", "volume_non_negative", "currency_codes"),
    ]


def test_every_declared_constraint_is_valid_sql(spark):
    from tidemark.schemas import TABLE_CHECKS

    for checks in TABLE_CHECKS.values():
        names = set().union(*[validate._mentions(p) for p in checks.values()])
        text = {
            "from_currency", "to_currency", "symbol", "series_id", "status", "timeframe", "start_time", "ended_at", "period_start", "period_end"
        }
        columns = [F.lit(None).cast("string" if n in text else "double").alias(n) for n in names]
        spark.range(1).select(*columns).select(validate.failed_checks("", list(names), checks)).collect()


def test_failure_streaks_and_alerts(frame):
    rows = [("a", T[n], n >= 4) for n in range(9)] + [("b", T[n], False) for n in range(3)] + [("c", T[n], True) for n in range(2)]
    status = {r["s"]: r for r in validate.source_status(frame("s string, t timestamp, bad boolean", *rows), "s", "t", "bad").collect()}
    assert status["a"]["consecutive_failures"] == 5 and status["a"]["failing"] and status["a"]["last_success"] == T[3]
    assert not status["b"]["failing"] and not status["b"]["high_error_rate"]
    assert status["c"]["consecutive_failures"] == 2 and status["c"]["last_success"] is None


# --- weather and sentiment ---------------------------------------------------------------------------


def test_daily_weather(frame):
    rows = [
        (dt.datetime(2024, 1, 6, h), "London", t, 50.0, w, 1.0, m)
        for h, t, w, m in ((0, 10.0, 5.0, "Rain"), (1, 14.0, 9.0, "Clear"), (2, 12.0, 1.0, None))
    ] + [(dt.datetime(2024, 1, 6, 3), None, 99.0, 0.0, 0.0, 0.0, "Rain")]
    ddl = "timestamp timestamp, location string, temperature double, humidity double, wind_speed double, rain_1h double, weather_main string"
    rows = weather.features(weather.daily(frame(ddl, *rows))).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["temperature_daily_min"], row["temperature_daily_max"], row["temperature_daily_avg"]) == (10, 14, 12)
    assert (row["wind_speed_daily_max"], row["rain_1h_daily_total"], row["weather_main_mode"]) == (9, 3, "Clear")
    assert row["heat_index"] == 12 and row["wind_chill"] == 12 and row["season"] == "Winter" and row["is_weekend"]
    assert row["comfort_index"] == pytest.approx(0.6 * 55 + 0.4 * 100)
    assert row["weather_severity_score"] == pytest.approx((9 / 20 + 4 / 15) / 2)


def test_sentiment_scores_and_buckets(frame):
    df = frame("t int, text string", (1, "Good news"), (2, "bad NEWS!"), (3, "neutral"), (4, "great, great"), (5, None))
    rows = sentiment.score(df, "text").orderBy("t").collect()
    assert [round(r["sentiment_polarity"], 6) for r in rows] == [0.7, -0.7, 0, 0.8, 0]
    assert [r["sentiment_label"] for r in rows] == ["positive", "negative", "neutral", "positive", "neutral"]


def test_sentiment_edges(frame):
    df = frame("n int, p double", *enumerate([-1.0, -0.5, -0.1, 0.0, 0.1, 0.10001, 1.0]))
    got = [r[0] for r in df.orderBy("n").select(sentiment.label("p")).collect()]
    assert got == [None, "negative", "negative", "neutral", "neutral", "positive", "positive"]


def test_sentiment_by_date(frame):
    df = frame("timestamp timestamp, text string", (T[0], "good"), (T[0], "bad"), (T[1], "great"))
    out = {r["text"]: r for r in sentiment.features(df, "text", "timestamp").collect()}
    assert out["good"]["sentiment_polarity_mean"] == pytest.approx(0) and out["good"]["sentiment_polarity_count"] == 2
    assert out["great"]["sentiment_polarity_std"] is None


# --- catalogue ----------------------------------------------------------------------------------------


def rates(frame):
    rows = [
        ("NOK", "SEK", dt.date(2023, 5, 9), 4.0, 4.5, 3.5, 4.25), ("NOK", "SEK", dt.date(2023, 5, 10), 4.27, 4.3, 4.27, 4.3),
        ("CHF", "PLN", dt.date(2023, 5, 9), 7.0, 7.5, 6.75, 7.25), ("CHF", "PLN", dt.date(2023, 5, 12), 7.25, 8.0, 7.0, 7.75),
    ]
    return frame("from_currency string, to_currency string, date date, open double, high double, low double, close double", *rows)


PAIR = ["from_currency", "to_currency"]


def test_rates(frame):
    df = rates(frame)
    assert catalogue.duplicate_keys(df, [*PAIR, "date"]).count() == 0
    gaps = {(r["from_currency"], str(r["missing_date"])) for r in catalogue.next_day_gaps(df, PAIR, "date").collect()}
    assert gaps == {("NOK", "2023-05-11"), ("CHF", "2023-05-10"), ("CHF", "2023-05-13")}
    level = catalogue.with_volatility_level(df).filter("from_currency = 'NOK' AND date = '2023-05-10'").first()
    assert round(level["volatility_pct"], 2) == 0.7 and level["volatility_level"] == "Low"
    change = catalogue.latest_change(df, PAIR, "date", "close").filter("from_currency = 'NOK'").first()
    assert change["latest_rate"] == 4.3 and change["change_pct"] == pytest.approx((4.3 / 4.25 - 1) * 100)
    mark = catalogue.high_water_mark(df, "date", from_currency="NOK").first()["latest"]
    assert mark == dt.date(2023, 5, 10)


def test_missing_weekdays(frame):
    rows = [("A", dt.date(2024, 1, d)) for d in range(1, 13)] + [("B", dt.date(2024, 1, d)) for d in (1, 2, 6, 7, 12)]
    out = catalogue.missing_days(frame("symbol string, date date", *rows), ["symbol"], "date").collect()
    assert [(r["symbol"], r["missing_days"]) for r in out] == [("B", 7)]


def test_true_range_uses_the_previous_close(frame):
    df = frame("k string, t int, high double, low double, close double", ("a", 1, 10.0, 9.0, 9.5), ("a", 2, 12.0, 11.0, 11.5), ("a", 3, 11.0, 7.0, 8.0))
    out = catalogue.average_true_range(df, series("k", "t")).orderBy("t").collect()
    assert [r["true_range"] for r in out] == [1.0, 2.5, 4.5] and out[2]["atr_14"] == pytest.approx(8 / 3)


def test_high_volume_and_anomalies(frame):
    rows = [("a", n, 1.0, 1.0, 100.0 if n < 9 else 2000.0) for n in range(10)]
    df = frame("k string, t int, open double, close double, volume double", *rows)
    assert [r["t"] for r in catalogue.high_volume(df, series("k", "t")).collect()] == [9]
    kinds = {r["t"]: r["anomaly_type"] for r in catalogue.anomalous_values(df, series("k", "t")).collect()}
    assert kinds[9] == "high_volume" and kinds[0] is None


def test_known_at(frame):
    d = lambda m, x: dt.datetime(2024, m, x)
    obs = frame("k string, realtime_start timestamp, realtime_end timestamp, v double", ("a", d(1, 1), d(3, 9), 1.0), ("a", d(3, 10), dt.datetime(9999, 12, 31), 2.0))
    moments = frame("k string, at timestamp", ("a", d(2, 5)), ("a", d(3, 10)), ("a", d(6, 1)), ("b", d(2, 1)))
    rows = catalogue.known_at(moments, obs, ["k"], "at").orderBy("at").collect()
    assert [r["v"] for r in rows] == [1.0, 2.0, 2.0]


@pytest.mark.parametrize("size", [1_000_000, 3])
def test_known_at_keeps_moments_and_takes_the_latest_start(frame, size):
    d = lambda m, x: dt.datetime(2024, m, x)
    obs = frame(
        "k string, realtime_start timestamp, realtime_end timestamp, v double", ("a", d(1, 1), d(12, 31), 1.0), ("a", d(3, 1), d(3, 31), 2.0),
        ("a", d(3, 1), d(3, 9), 9.0), ("a", None, d(9, 9), 5.0), (None, d(1, 1), d(2, 1), 7.0),
    )
    moments = frame("k string, at timestamp", ("a", d(1, 1)), ("a", d(3, 1)), ("a", d(3, 31)), ("a", d(4, 1)), (None, d(1, 9)), ("b", d(1, 9)), ("a", None))
    rows = catalogue.known_at(moments, obs, ["k"], "at", keep_unknown=True, rows_per_chunk=size).collect()
    assert {(r["k"], r["at"]): r["v"] for r in rows} == {
        ("a", d(1, 1)): 1.0, ("a", d(3, 1)): 2.0, ("a", d(3, 31)): 2.0, ("a", d(4, 1)): None, (None, d(1, 9)): 7.0, ("b", d(1, 9)): None,
        ("a", None): None,
    }
    assert catalogue.known_at(moments, obs, ["k"], "at", rows_per_chunk=size).count() == 4


def test_market_mood(frame):
    df = frame("s string, percent_change double", ("a", 1.0), ("b", 2.0), ("c", -1.0))
    assert {r["market_sentiment"] for r in catalogue.market_summary(df).collect()} == {"Positive"}
    even = df.filter("s <> 'b'")
    assert {r["market_sentiment"] for r in catalogue.market_summary(even).collect()} == {"Negative"}


def test_ordered_checks_are_the_same_for_cut_series_and_beyond_the_buffer(frame, monkeypatch):
    rows = [good(n) for n in (*range(20), 3, 3, 7)]
    rows += [(T[20], "A", 10.0, 12.0, 9.0, 11.0, 1e6, 20), (None, "A", 10.0, 12.0, 9.0, 11.0, 1.0, 21), (None, "A", 10.0, 12.0, 9.0, 11.0, 1.0, 22)]
    rows += [(t + dt.timedelta(days=90), "A", 10.0, 12.0, 9.0, 11.0, 1.0, 30 + n) for n, t in enumerate(T[:2])]
    df = frame(DDL, *rows)
    shown = lambda **options: sorted((r["check_name"], r["violations"], r["detail"]) for r in validate.results(df, "stock", S, **options).collect())
    plain = shown()
    found = {name: n for name, n, _ in plain}
    assert found["duplicate_records"] == 7 and found["time_gaps"] >= 1
    assert shown(rows_per_chunk=4) == plain
    monkeypatch.setattr(validate, "BUFFERED_ROWS", 3)
    assert shown() == plain


# --- learned sentiment ---------------------------------------------------------------------------------


def test_learned_weights_and_words_that_turn_them(spark, frame):
    texts = [("fine day", True)] * 6 + [("grim day", False)] * 6 + [(None, True), ("grim", None), ("", False)]
    weights = sentiment.learn(frame("t string, y boolean", *texts), "t", "y")
    got = {r["word"]: r["weight"] for r in weights.collect()}
    # Seven texts are negative, the empty one among them.
    assert got == pytest.approx({"fine": math.log(7 / 8) - math.log(1 / 9), "grim": math.log(1 / 8) - math.log(7 / 9), "day": math.log(7 / 8) - math.log(7 / 9)})
    known = frame("word string, weight double", ("fine", 0.4), ("grim", -0.4))
    cases = {
        "plain": ("Fine!", 0.4), "not": ("not so fine", -0.4), "far": ("not a b c fine", 0.4), "very": ("very fine", 0.6),
        "both": ("not very fine", -0.6), "mixed": ("fine grim", 0.0), "none": ("other words", 0.0), "empty": ("", 0.0), "null": (None, 0.0),
    }
    rows = frame("k string, t string", *[(k, t) for k, (t, _) in cases.items()])
    scored = {r["k"]: r for r in sentiment.score_learned(rows, ["k"], "t", known).collect()}
    assert {k: r["sentiment_score"] for k, r in scored.items()} == pytest.approx({k: math.tanh(v) for k, (_, v) in cases.items()})
    assert scored["not"]["sentiment_label"] == "negative" and scored["null"]["sentiment_label"] == "neutral"
    assert scored["mixed"]["known_words"] == 2 and scored["null"]["known_words"] == 0
    # Without texts of both labels nothing is learned.
    assert sentiment.learn(frame("t string, y boolean", ("a", True)), "t", "y", 1).count() == 0


def test_learned_scores_split_a_text_once(frame):
    """Not again for each word: no function over a word holds the text."""
    known = frame("word string, weight double", ("fine", 0.4), ("grim", -0.4))
    rows = frame("k int, t string", (1, "no, a b fine"), (2, "no a b c fine"), (3, "very no fine"), (4, " -- fine"), (5, "fine no"))
    scored = sentiment.score_learned(rows, ["k"], "t", known)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "split(lower(" in plan and not re.search(r"lambdafunction\(.*split\(", plan)
    got = {r["k"]: r["sentiment_score"] for r in scored.collect()}
    assert got == pytest.approx({k: math.tanh(v) for k, v in {1: -0.4, 2: 0.4, 3: -0.4, 4: 0.4, 5: 0.4}.items()})


def test_learned_scores_name_the_split_once(frame):
    """A generator evaluates an expression as often as it is named, and the words are named for each place in the context."""
    known = frame("word string, weight double", ("fine", 0.4))
    scored = sentiment.score_learned(frame("k int, t string", (1, "no fine")), ["k"], "t", known)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1


@pytest.mark.parametrize("name", ["sentiment_learned", "sentiment_accuracy"])
def test_labelled_texts_move_once(spark, frame, tmp_path, name):
    """Learning and scoring read the texts with their labels; neither joins the documents again."""
    from tidemark.checks import queries

    frame("doc_id long, text string", *[(i, "good day" if i % 3 else "bad day") for i in range(24)], (None, "bad"), (30, None)).write.parquet(f"{tmp_path}/documents.parquet")
    frame("doc_id long, quality int", *[(i, int(i % 3 > 0)) for i in range(24)], (None, 1), (30, 1), (3, None)).write.parquet(f"{tmp_path}/labels.parquet")
    out = queries()[name](spark, str(tmp_path))
    assert not [f for f in out.inputFiles() if "/documents.parquet/" in f or "/labels.parquet/" in f]
    if name == "sentiment_accuracy":
        assert {tuple(r) for r in out.collect()} == {(True, 6, 4, 6), (False, 18, 12, 18)}
    else:
        assert {(r["doc_id"], r["known_words"], r["sentiment_score"] > 0) for r in out.collect()} == {(i, 2, i % 3 > 0) for i in range(24)}


def test_sentiment_accuracy_takes_long_texts(spark, frame, tmp_path):
    """Long texts take time in proportion to their words; in its square these would take several minutes."""
    import time

    from tidemark.checks import queries

    texts = {0: "good day " * 12000, 1: "bad day " * 12000}
    docs = [(i, texts[i % 4 // 3]) for i in range(48)]  # every fourth is bad, and numbers 2, 6, 10, ... are held out
    frame("doc_id long, text string", *docs).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 != 3)) for i in range(48)]
    frame("doc_id long, quality long", *labels).write.parquet(f"{tmp_path}/labels.parquet")
    begin = time.monotonic()
    got = {r["held_out"]: (r["n"], r["positive"], r["hits"]) for r in queries()["sentiment_accuracy"](spark, str(tmp_path)).collect()}
    assert got == {False: (36, 24, 36), True: (12, 12, 12)}
    assert time.monotonic() - begin < 60
