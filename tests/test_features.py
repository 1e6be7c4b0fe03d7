from __future__ import annotations

import datetime as dt

import pytest
from conftest import column
from pyspark.sql import functions as F

from tidemark.operators import bars
from tidemark.operators.features import asset_metrics, rolling_corr, time_features
from tidemark.operators.series import series

DAY = dt.date(2024, 1, 1)


def daily(frame, values, key="a"):
    rows = [(key, DAY + dt.timedelta(days=n), float(v) if v is not None else None) for n, v in enumerate(values)]
    return frame("symbol string, date date, value double", *rows)


S = series("symbol", "date")


def test_lags(frame):
    out = time_features(daily(frame, range(1, 11)), S, "value", lags=[1, 2, 3])
    assert column(out, "value_lag_1", "date") == [None, *range(1, 10)]
    assert column(out, "value_lag_3", "date") == [None, None, None, *range(1, 8)]


def test_rolling_statistics(frame):
    out = time_features(daily(frame, range(10, 101, 10)), S, "value")
    assert column(out, "value_ma_3", "date") == [10, 15, 20, 30, 40, 50, 60, 70, 80, 90]
    std = column(out, "value_std_3", "date")
    assert std[0] is None and std[1] == pytest.approx(50**0.5) and std[2] == pytest.approx(10)


def test_percent_changes(frame):
    values = [40, 50, 50, 60, 60, 75, 75, 60, 90, 45]
    out = time_features(daily(frame, values), S, "value")
    one = column(out, "value_pct_change_1", "date")
    assert one[0] is None and one[1:4] == pytest.approx([0.25, 0, 0.2]) and one[5] == pytest.approx(0.25)
    seven = column(out, "value_pct_change_7", "date")
    assert seven[:7] == [None] * 7 and seven[7:] == pytest.approx([0.5, 0.8, -0.1])


def test_percent_change_fills_nulls_and_survives_zero(frame):
    out = time_features(daily(frame, [2, None, 3, 0, 5]), S, "value")
    assert column(out, "value_pct_change_1", "date") == pytest.approx([None, 0, 0.5, -1, None])


def test_series_do_not_mix(frame):
    both = daily(frame, [1, 2, 3]).unionByName(daily(frame, [7, 8, 9], "b"))
    out = time_features(both, S, "value", lags=[1])
    assert column(out, "value_lag_1", ["symbol", "date"]) == [None, 1, 2, None, 7, 8]


def test_calendar_columns(frame):
    row = time_features(daily(frame, [1] * 91), S, "value").filter("date = '2024-03-31'").first()
    assert (row["day_of_week"], row["quarter"], row["is_month_end"], row["is_quarter_end"]) == (6, 1, True, True)


def bars_of(frame, closes):
    rows = [("a", DAY + dt.timedelta(days=n), float(c), 100.0 + n) for n, c in enumerate(closes)]
    return frame("symbol string, date date, close double, volume double", *rows)


def test_averages_need_a_full_window(frame):
    out = asset_metrics(bars_of(frame, range(1, 26)), S, "stock")
    sma = column(out, "sma_20", "date")
    assert sma[:19] == [None] * 19 and sma[19] == pytest.approx(10.5)
    assert column(out, "dollar_volume", "date")[1] == 2 * 101


def test_drawdown_is_never_positive(frame):
    out = asset_metrics(bars_of(frame, [10, 12, 9, 15, 12]), S, "index")
    assert column(out, "drawdown", "date") == pytest.approx([0, 0, -25, 0, -20])
    assert column(out, "cumulative_max", "date") == [10, 12, 12, 15, 15]


def test_correlation_over_a_constant_is_null(frame):
    df = bars_of(frame, [5] * 12)
    out = df.withColumn("c", rolling_corr("close", "volume", S.window(), 10))
    assert column(out, "c", "date") == [None] * 12
    rising = bars_of(frame, range(12)).withColumn("c", rolling_corr("close", "volume", S.window(), 10))
    assert column(rising, "c", "date")[9:] == pytest.approx([1, 1, 1])


def test_forex_spread(frame):
    df = frame("symbol string, date date, close double, bid double, ask double", ("a", DAY, 1.0, 1.1, 1.1002))
    assert asset_metrics(df, S, "forex").first()["spread_pips"] == pytest.approx(2)


def ticks(frame):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    ddl = "symbol string, ts timestamp, open double, high double, low double, close double, volume bigint"
    return frame(
        ddl, ("a", t(0, 10), None, 3.0, 1.0, 2.0, 5), ("a", t(0, 50), 2.0, 4.0, 2.0, None, 6), ("a", t(3, 0), 3.0, 3.0, 3.0, 3.0, 1)
    )


def test_resample_skips_nulls_and_conserves_volume(frame):
    out = bars.resample(ticks(frame), ["symbol"], "ts", "1h", bars.RULES["stock"]).orderBy("ts").collect()
    assert [r["ts"].hour for r in out] == [0, 3]
    first = out[0]
    assert (first["open"], first["high"], first["low"], first["close"], first["volume"]) == (2.0, 4.0, 1.0, 2.0, 11)
    assert sum(r["volume"] for r in out) == 12


def test_resample_with_gaps(frame):
    out = bars.resample(ticks(frame), ["symbol"], "ts", "1h", bars.RULES["stock"], fill_gaps=True).orderBy("ts").collect()
    assert [r["ts"].hour for r in out] == [0, 1, 2, 3]
    assert (out[1]["open"], out[1]["volume"]) == (None, 0)


@pytest.mark.parametrize("granularity, labels", [("1M", ["2023-11-30", "2023-12-31", "2024-01-31", "2024-02-29"]), ("1y", ["2023-12-31", "2024-12-31"])])
def test_calendar_gaps(frame, granularity, labels):
    df = frame("k string, ts timestamp, n int", (None, dt.datetime(2023, 11, 5), 2), (None, dt.datetime(2024, 2, 1), 3), ("x", dt.datetime(2024, 2, 1), 4))
    out = bars.resample(df, ["k"], "ts", granularity, {"n": "sum"}, fill_gaps=True).orderBy("k", "ts").collect()
    assert [str(r["ts"].date()) for r in out if r["k"] is None] == labels
    assert [r["n"] for r in out] == [2] + [0] * (len(labels) - 2) + [3, 4]


def test_calendar_blocks_join_without_a_gap(frame, monkeypatch):
    monkeypatch.setattr(bars, "CALENDAR_BLOCK", 7)
    df = frame("k string, ts timestamp, n int", ("x", dt.datetime(2024, 1, 1), 1), ("x", dt.datetime(2024, 1, 3, 5), 1))
    out = column(bars.resample(df, ["k"], "ts", "1h", {"n": "sum"}, fill_gaps=True), "ts", "ts")
    assert out == [dt.datetime(2024, 1, 1) + dt.timedelta(hours=k) for k in range(54)]


@pytest.mark.parametrize(
    "granularity, label", [("1w", "2024-02-18"), ("1M", "2024-02-29"), ("1q", "2024-03-31"), ("1y", "2024-12-31"), ("1d", "2024-02-14")]
)
def test_bin_labels(frame, granularity, label):
    df = frame("ts timestamp", (dt.datetime(2024, 2, 14, 13, 30),))
    assert str(df.select(bars.bin_of("ts", granularity).alias("b")).first()["b"].date()) == label


@pytest.mark.parametrize("seconds, label", [(60, "1m"), (61, "5m"), (3600, "1h"), (86400, "1d"), (604800, "1w"), (9e6, "custom")])
def test_granularity(frame, seconds, label):
    start = dt.datetime(2024, 1, 1)
    df = frame("k string, ts timestamp", *[("a", start + dt.timedelta(seconds=seconds * n)) for n in range(4)])
    assert bars.granularity(df, series("k", "ts")).first()["granularity"] == label


def test_single_row_series_has_no_granularity(frame):
    df = frame("k string, ts timestamp", ("a", dt.datetime(2024, 1, 1)))
    assert bars.granularity(df, series("k", "ts")).count() == 0


def test_bars_keep_their_order(spark, frame):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = bars.ohlcv(df, ["event_type"], "ts", "value", "user_id", "1d")
    bad = out.filter(~(F.col("low").between(0, F.least("open", "close")) & (F.col("high") >= F.greatest("open", "close"))))
    assert bad.count() == 0
    assert out.agg(F.sum("volume")).first()[0] == df.agg(F.sum("user_id")).first()[0]
