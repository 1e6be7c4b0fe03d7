from __future__ import annotations

import datetime as dt

import pytest
from conftest import column
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import clean, standardize
from tidemark.operators.series import series

T = [dt.datetime(2024, 1, d) for d in range(1, 8)]


def test_duplicates_ignore_time_and_keep_the_first(frame):
    df = frame(
        "symbol string, price double, volume bigint, timestamp timestamp",
        ("QQX", 7.25, 12, T[0]), ("QQX", 7.25, 12, T[1]), ("ZRH", 61.5, 3, T[2]), ("ZRH", 61.5, 3, T[3]),
    )
    rows = clean.drop_duplicates(df, ["timestamp"]).orderBy("symbol").collect()
    assert [(r["symbol"], r["timestamp"]) for r in rows] == [("QQX", T[0]), ("ZRH", T[2])]
    assert clean.drop_repeats(df, ["timestamp"]).count() == 4 and clean.drop_repeats(df.union(df), ["timestamp"]).count() == 4


def test_keep_last(frame):
    df = frame("k string, n int, v int", ("a", 1, 1), ("a", 2, 2), ("b", 1, 3))
    assert sorted(r["v"] for r in clean.keep_one(df, ["k"], ["n"], "last").collect()) == [2, 3]


def test_coercion(frame):
    df = frame("price string, volume string, date string", ("150.5", "1000000", "2024-01-01"), ("x", "1.5", "never"))
    out = clean.coerce(df, {"price": "float", "volume": "int", "date": "datetime"}).collect()
    assert (out[0]["price"], out[0]["volume"], out[0]["date"]) == (150.5, 1000000, T[0])
    assert (out[1]["price"], out[1]["volume"], out[1]["date"]) == (None, None, None)
    lost = {r["column"]: r["lost"] for r in clean.coercion_losses(df, {"price": "float", "volume": "int"}).collect()}
    assert lost == {"price": 1, "volume": 1}


def numbers(frame):
    rows = zip([150.0, None, 152.0, 153.0, None], [1000.0, 1100.0, None, 1300.0, 1400.0])
    return frame("k string, t int, price double, volume double", *[("a", n, p, v) for n, (p, v) in enumerate(rows)])


@pytest.mark.parametrize("threshold, price", [(0.4, 152.0), (0.3, None)])
def test_median_imputation_obeys_the_threshold(frame, threshold, price):
    out = clean.impute(numbers(frame), series("k", "t"), threshold=threshold)
    assert column(out, "price", "t")[1] == price
    assert column(out, "volume", "t")[2] == 1200.0


def test_mode_imputation(frame):
    rows = zip(["AAPL", "AAPL", None, "GOOGL", "AAPL"], ["NYSE", None, "NYSE", "NASDAQ", "NYSE"])
    df = frame("k string, t int, symbol string, exchange string", *[("a", n, s, e) for n, (s, e) in enumerate(rows)])
    out = clean.impute(df, series("k", "t"), threshold=0.3)
    assert column(out, "symbol", "t")[2] == "AAPL" and column(out, "exchange", "t")[1] == "NYSE"


def test_times_are_filled_forward(frame):
    df = frame("k string, t int, seen timestamp", ("a", 1, T[0]), ("a", 2, None), ("b", 1, None))
    out = clean.impute(df, series("k", "t"))
    assert column(out, "seen", ["k", "t"]) == [T[0], T[0], None]


def test_local_times_become_utc(frame):
    df = frame("timestamp timestamp_ntz, value int", (T[0], 1))
    assert clean.to_utc(df, "US/Eastern").first()["timestamp"] == dt.datetime(2024, 1, 1, 5)


def test_outliers_are_capped_unless_nulls_are_present(frame):
    df = frame("k string, v double", *[("a", float(v)) for v in (1, 2, 3, 100)], ("b", 1.0), ("b", None), ("b", 100.0))
    out = clean.cap_outliers(df, ["k"], ["v"])
    # quartiles 1.75 and 27.25, so the upper bound is 65.5
    assert sorted(r["v"] for r in out.filter("k = 'a'").collect()) == [1, 2, 3, 65.5]
    assert sorted(r["v"] for r in out.filter("k = 'b' AND v IS NOT NULL").collect()) == [1, 100]


def test_weather_cleaning(frame):
    df = frame(
        "location string, t int, temperature double, rain_1h double, humidity double",
        ("x", 1, None, 1.0, 50.0), ("x", 2, 10.0, None, None), ("x", 3, None, 1.0, 60.0), ("x", 4, 12.0, 1.0, 55.0),
    )
    out = clean.clean_weather(df, series("location", "t"))
    # quartiles 10 and 10.5, so the last value is capped at 11.25
    assert column(out, "temperature", "t") == [10, 10, 10, 11.25]
    assert column(out, "humidity", "t")[1] == 55
    assert column(out, "rain_1h", "t")[1] == pytest.approx(0.375)  # filled with 0, then capped at Q1 - 1.5 IQR


def test_clip_keeps_nulls(frame):
    df = frame("v double", (None,), (-5.0,), (5.0,))
    assert [r[0] for r in df.select(scalar.clip("v", 0, 3)).collect()] == [None, 0, 3]


def test_cleaning_never_adds_rows_and_can_fail(frame):
    df = frame(
        "symbol string, date string, open string, high string, low string, close string, volume string",
        *[("A", f"2024-01-0{n}", "1", "2", "1", "1.5" if n > 1 else "bad", "10") for n in range(1, 6)],
    )
    s = series("symbol", "date")
    out = clean.clean(df, schemas.CLEAN_SCHEMAS["stock"], s, threshold=0.5)
    assert out.count() <= df.count()
    with pytest.raises(ValueError, match="negative"):
        clean.clean(df.withColumn("close", F.lit("-1")), schemas.CLEAN_SCHEMAS["stock"], s, on_error="fail")


# --- standardising --------------------------------------------------------------------------------


def test_names_are_mapped_after_lowering(frame):
    df = frame("`Open Price` double, HIGH double, `Low-Price` double, price double, Vol bigint, Ticker string", (1.0, 2.0, 1.0, 1.5, 5, "A"))
    assert standardize.rename(df).columns == ["open", "high", "low", "close", "volume", "symbol"]


def test_canonical_names_are_not_overwritten(frame):
    df = frame("close double, price double", (1.0, 2.0))
    assert standardize.rename(df).columns == ["close", "price"]


def test_stock(frame):
    df = frame(
        "Open bigint, High bigint, Low bigint, Close double, Volume bigint, Ticker string, Date date, Currency string",
        *[(7, 9, 6, 8.5, 40, "QQX.US", dt.date(2023, 5, d), "USD") for d in (1, 2, 3)],
    )
    out = standardize.standardize(df, "stock")
    row = out.first()
    assert row["symbol"] == "QQX" and row["timestamp"] is not None and row["data_type"] == "stock" and row["granularity"] == "1d"
    assert out.columns[-3:] == ["standardized_at", "data_type", "granularity"]


def test_crypto_and_forex_symbols(frame):
    df = frame("timestamp timestamp, symbol string, close double", *[(dt.datetime(2023, 5, 1, h), "BTC-USD", 1.0) for h in range(3)])
    row = standardize.standardize(df, "crypto").first()
    assert (row["symbol"], row["granularity"]) == ("BTCUSDT", "1h")
    fx = frame("Pair string, Time timestamp, Close double", *[("EUR/USD", dt.datetime(2023, 5, 1, h), 1.5) for h in range(3)])
    assert standardize.standardize(fx, "forex").first()["symbol"] == "EURUSD"


def test_economic(frame):
    df = frame(
        "series_code string, value bigint, observation_date date, units string",
        *[("GDP", 100, dt.date(2026, 1, d), "US Dollars") for d in (1, 2, 3)],
    )
    out = standardize.standardize(df, "economic")
    row = out.first()
    assert (row["series_id"], row["units"]) == ("GDP", "usd") and dict(out.dtypes)["value"] == "double"


def test_hourly_stock_becomes_daily(frame):
    rows = [(dt.datetime(2024, 1, 1 + h // 24, h % 24), "A", float(h), float(h), float(h), float(h), 1) for h in range(48)]
    df = frame("timestamp timestamp, symbol string, open double, high double, low double, close double, volume bigint", *rows)
    out = standardize.standardize(df, "stock").orderBy("timestamp").collect()
    assert [(r["open"], r["close"], r["volume"], r["day"]) for r in out] == [(0, 23, 24, 1), (24, 47, 24, 2)]


def test_currency_and_imperial_units(frame):
    df = frame("close double, currency string", (85.0, "EUR"), (10.0, "XXX"), (10.0, None))
    assert [r["close"] for r in standardize.set_units(df, "stock").collect()] == [pytest.approx(100), 10, 10]
    w = frame("temperature double, wind_speed double, units string", (212.0, 10.0, "imperial"))
    row = standardize.set_units(w, "weather").first()
    assert (row["temperature"], row["wind_speed"], row["units"]) == (pytest.approx(100), pytest.approx(4.4704), "metric")


def test_last_duplicate_is_kept(frame):
    df = frame("timestamp timestamp, symbol string, close double, _seq int", (T[0], "A", 1.0, 1), (T[0], "A", 2.0, 2))
    assert [r["close"] for r in standardize.finalize(df, "stock").collect()] == [2.0]


@pytest.mark.parametrize(
    "symbol, kind, anchored, expected",
    [
        ("aapl.us ", "stock", True, "AAPL"), ("X.OLD", "stock", True, "X.OLD"), ("X.OLD", "stock", False, "XLD"),
        ("eth/usd", "crypto", True, "ETHUSDT"), ("SOL", "crypto", True, "SOLUSDT"), ("LONGNAME", "crypto", True, "LONGNAME"),
    ],
)
def test_symbols(frame, symbol, kind, anchored, expected):
    df = frame("s string", (symbol,))
    assert df.select(scalar.clean_symbol("s", kind, anchored)).first()[0] == expected


def test_small_functions(frame):
    df = frame("a string, b string", ("1,234.5", "1704067200000"))
    row = df.select(
        scalar.parse_number("a").alias("n"), scalar.parse_time("b").alias("t"), scalar.base_currency(F.lit("XAUUSD")).alias("base"),
        scalar.quote_currency(F.lit("XAUUSDX")).alias("quote"), scalar.with_quote(F.lit("BTC/USD"), "EUR").alias("q"),
        scalar.fund_category(F.lit("ARK Innovation")).alias("f"), scalar.pair_ticker(F.lit("EUR/USD")).alias("p"),
        scalar.heat_index(F.lit(20.0), F.lit(50.0)).alias("cool"), scalar.wind_chill(F.lit(0.0), F.lit(1.0)).alias("chill"),
        scalar.comfort_index(F.lit(21.0), F.lit(50.0)).alias("best"), scalar.as_text(F.lit(0.1234)).alias("pct"),
    ).first()
    assert (row["n"], row["t"], row["base"], row["quote"], row["q"]) == (1234.5, T[0], "XAU", "USDX", "BTC/EUR")
    assert (row["f"], row["p"], row["cool"], row["best"], row["pct"]) == ("innovative", "C:EURUSD", 20.0, 100.0, "12.3%")
    assert row["chill"] == pytest.approx(13.12 - 11.37)


def test_combined_items(frame):
    a, b = frame("v int", (1,)), frame("v int, w int", (2, 3))
    rows = standardize.combine({"x": a, "y": b}).orderBy("item").collect()
    assert [(r["item"], r["v"], r["w"]) for r in rows] == [("x", 1, None), ("y", 2, 3)]
