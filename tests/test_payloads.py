from __future__ import annotations

import datetime as dt
import json

import pytest

from tidemark.sources import payloads, tables


@pytest.fixture
def raw(spark):
    def make(*bodies, item="X"):
        rows = [(b if isinstance(b, str) or b is None else json.dumps(b), item) for b in bodies]
        return spark.createDataFrame(rows, "payload string, item string")

    return make


def utc(*parts):
    return dt.datetime(*parts)


def test_bars(raw):
    body = {
        "meta": {"symbol": "QQX", "interval": "1day", "currency": "CHF", "exchange": "SIX", "type": "Share"},
        "values": [
            {"datetime": "2024-01-01", "open": "7.25", "high": "7.5", "low": "7", "close": "7.40", "volume": "312"},
            {"datetime": "2024-01-02", "open": "7.40", "high": "7.9", "low": "x", "close": "7.75", "volume": "298"},
        ],
        "status": "ok",
    }
    rows = payloads.bars(raw(body, item="ZRH"), "stock").orderBy("timestamp").collect()
    assert len(rows) == 2 and rows[0]["open"] == 7.25 and rows[1]["low"] is None and rows[0]["timestamp"] == utc(2024, 1, 1)
    assert (rows[0]["symbol"], rows[0]["interval"], rows[0]["currency"], rows[0]["asset_type"]) == ("ZRH", "1day", "CHF", "stock")


def test_errors_are_split(raw):
    good, bad = payloads.split_errors(raw({"code": 429, "message": "m"}, {"code": 400}, {"values": []}, "{oops", None, {"code": 200}))
    assert sorted(r["error_kind"] for r in bad.collect()) == ["api_error", "rate_limit", "unparsable", "unparsable"]
    assert good.count() == 2 and payloads.bars(good).count() == 0


def test_symbol_lists(raw):
    body = {"data": [{"symbol": "SPY", "name": "SPDR S&P 500", "type": "ETF"}, {"symbol": "XLE", "name": "Energy Select"}]}
    rows = payloads.symbols(raw(body), "etf").orderBy("symbol").collect()
    assert [(r["symbol"], r["asset_type"], r["category"]) for r in rows] == [("SPY", "etf", "broad_market"), ("XLE", "etf", "energy")]
    index = payloads.symbols(raw({"data": [{"symbol": "N225"}, {"symbol": "ZZZ"}]}), "index").orderBy("symbol").collect()
    assert [(r["region"], r["index_type"]) for r in index] == [("Japan", "price_weighted"), ("Unknown", "Unknown")]
    assert payloads.symbols(raw({"data": [{"symbol": "A", "type": "Stock"}]})).first()["asset_type"] == "Stock"


def test_quotes(raw):
    body = {
        "symbol": "BTC/USD", "close": "9.50", "change": "-0.5", "percent_change": "-5", "volume": "4",
        "fifty_two_week": {"low": "8", "high": "21.5", "range": "8 - 21.5"},
    }
    row = payloads.quotes(raw(body), "crypto").first()
    assert (row["close"], row["percent_change"], row["week_high"], row["week_range"]) == (9.5, -5.0, 21.5, "8 - 21.5")
    assert (row["base_currency"], row["quote_currency"]) == ("BTC", "USD")
    assert payloads.quotes(raw({"symbol": "DJI", "name": "Dow", "close": "1"}), "index").first()["region"] == "US"
    assert payloads.quotes(raw({"symbol": "SPY", "meta": {"name": "SPDR"}, "close": "1"}), "etf").first()["name"] == "SPDR"


def test_short_quotes(raw):
    rows = payloads.short_quotes(raw({"c": 12.5, "d": -0.5, "dp": -3.8, "h": 13, "l": 12.25, "o": 13, "pc": 13.0}, {})).collect()
    assert len(rows) == 1 and (rows[0]["current_price"], rows[0]["previous_close"], rows[0]["volume"]) == (12.5, 13.0, 0)


def test_profile(raw):
    rows = payloads.profiles(raw({"name": "Pear Works", "finnhubIndustry": "Orchards", "marketCapitalization": 4711, "ipo": "2011-03-09"}, {})).collect()
    assert len(rows) == 1
    assert (rows[0]["company_name"], rows[0]["market_cap"], rows[0]["ipo_date"], rows[0]["currency"]) == ("Pear Works", 4711, dt.date(2011, 3, 9), "USD")


def test_calendar(raw):
    body = {"economicCalendar": [{"id": "a", "event": "Rye harvest", "actual": "38", "date": "2023-08-21 06:15:00"}]}
    row = payloads.calendar(raw(body)).first()
    assert (row["event"], row["actual"], row["date"]) == ("Rye harvest", "38", utc(2023, 8, 21, 6, 15))


def test_candles_from_parallel_arrays(raw):
    body = {"s": "ok", "t": [1704067200, 1704153600, 1704240000], "o": [1, 2, 3], "h": [2, 3, 4], "l": [0.5, 1, 2], "c": [1.5, 2.5, 3.5]}
    rows = payloads.candles(raw(body, {"s": "no_data"})).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["close"], r["volume"]) for r in rows] == [(utc(2024, 1, n), n + 0.5, 0) for n in (1, 2, 3)]


def test_news(raw):
    body = [{"id": 1, "datetime": 1704067200, "headline": "h", "hasPaywall": True}, {"id": 2, "datetime": 0, "lang": "de"}]
    rows = payloads.news(raw(body)).orderBy("news_id").collect()
    assert [(r["news_id"], r["has_paywall"], r["lang"]) for r in rows] == [(1, True, "en"), (2, False, "de")]


def test_observations(raw):
    day = lambda d, v: {"date": d, "value": v, "realtime_start": d, "realtime_end": "9999-12-31"}
    body = {"observations": [day("2019-05-01", "3.25"), day("2019-06-01", "."), day("2019-07-01", "-1"), day("2019-08-01", "?")]}
    assert [r["value"] for r in payloads.observations(raw(body)).orderBy("date").collect()] == [3.25, -1]
    assert [r["value"] for r in payloads.observation_rejects(raw(body)).collect()] == ["?"]


def test_series_metadata(raw):
    body = {"seriess": [{"id": "RYE", "title": "Tons of rye", "popularity": 11, "observation_start": "1962-09-01"}, {"id": "B"}]}
    assert payloads.series_list(raw(body)).count() == 2
    row = payloads.series_info(raw(body)).first()
    assert (row["series_id"], row["popularity"], row["observation_start"]) == ("RYE", 11, dt.date(1962, 9, 1))
    assert payloads.series_info(raw({"seriess": []}, {})).count() == 0


def test_aggregates(raw):
    body = {"results": [{"t": 1672531200000, "o": 1, "h": 2, "l": 1, "c": 1.5, "v": 10, "vw": 1.2, "n": 3}, {"t": 1672617600000, "c": 2}]}
    rows = payloads.aggregates(raw(body), forex=True).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["vwap"], r["volume"]) for r in rows] == [(utc(2023, 1, 1), 1.2, 10), (utc(2023, 1, 2), None, 0)]
    assert payloads.aggregates(raw({"results": []}, {})).count() == 0


def test_tickers(raw):
    rows = payloads.tickers(raw({"results": {"ticker": "AAPL", "name": "Apple"}}, {"results": [{"ticker": "A"}, {"ticker": "B"}]})).collect()
    assert sorted(r["symbol"] for r in rows) == ["A", "AAPL", "B"]


def test_current_weather(raw):
    body = {
        "cod": 200, "coord": {"lat": 47.4, "lon": 8.5}, "dt": 1704067200, "main": {"temp": 3.25, "humidity": 64, "pressure": 998},
        "wind": {"speed": 2.5, "deg": 10}, "clouds": {"all": 31}, "rain": {"1h": 0.25}, "weather": [{"main": "Mist", "description": "d"}],
        "sys": {"country": "CH", "sunrise": 1704096000}, "name": "Zug", "id": 7,
    }
    rows = payloads.current_weather(raw(body, {"cod": "404", "message": "not found"}, item="Zug")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["temperature"], row["humidity"], row["wind_speed"], row["weather_main"]) == (3.25, 64, 2.5, "Mist")
    assert (row["rain_1h"], row["snow_1h"], row["cloudiness"], row["country"], row["city_id"]) == (0.25, None, 31, "CH", 7)
    assert row["timestamp"] == utc(2024, 1, 1) and row["latitude"] == 47.4


def test_forecasts(raw):
    entry = lambda t, v: {"dt": t, "main": {"temp": v}, "wind": {"speed": 1}, "rain": {"3h": 2}, "weather": [{"main": "Rain"}]}
    body = {"cod": "200", "city": {"coord": {"lat": 1, "lon": 2}, "country": "GB"}, "list": [entry(1704067200, 10.5), entry(1704078000, 9.5)]}
    rows = payloads.forecast(raw(body, {"cod": "401"})).orderBy("timestamp").collect()
    assert [(r["temperature"], r["rain_3h"], r["latitude"]) for r in rows] == [(10.5, 2, 1), (9.5, 2, 1)]
    day = {"dt": 1704067200, "temp": {"day": 10.5, "min": 8.0}, "feels_like": {"day": 9}, "uvi": 2.5, "wind_deg": 90, "weather": [{"main": "Clear"}]}
    daily = payloads.daily_forecast(raw({"daily": [day, day, day]}), days=2).collect()
    assert len(daily) == 2 and (daily[0]["temp_day"], daily[0]["temp_min"], daily[0]["uvi"], daily[0]["date"]) == (10.5, 8.0, 2.5, dt.date(2024, 1, 1))


def test_historical_weather(raw):
    hour = {"dt": 1704070800, "temp": 9, "rain": {"1h": 1.5}, "pop": 0.3}
    body = {"lat": 1, "lon": 2, "current": {"dt": 1704067200, "temp": 10, "weather": [{"main": "Fog"}]}, "hourly": [hour, hour]}
    rows = payloads.historical_weather(raw(body, {"lat": 1})).orderBy("data_type").collect()
    assert [(r["data_type"], r["temperature"], r["rain_1h"]) for r in rows] == [
        ("historical", 10, None), ("historical_hourly", 9, 1.5), ("historical_hourly", 9, 1.5)
    ]
    assert payloads.historical_weather(raw({"current": {"dt": 1704067200}})).count() == 1


def test_pollution_and_places(raw):
    body = {"coord": {"lat": 1, "lon": 2}, "list": [{"dt": 1704067200, "main": {"aqi": 2}, "components": {"pm2_5": 12.3, "co": 1}}]}
    row = payloads.air_pollution(raw(body)).first()
    assert (row["aqi"], row["pm2_5"], row["o3"]) == (2, 12.3, None)
    place = payloads.places(raw([{"lat": 47.16, "lon": 8.51, "name": "Zug"}], [])).collect()
    assert [(r["latitude"], r["longitude"]) for r in place] == [(47.16, 8.51)]


def test_positional_candles(raw):
    mt = payloads.terminal_candles(raw([[1704067200, 1, 2, 0.5, 1.5, 100, 3, 0], [1704153600, 1, 2, 0.5, 1.5, 100, 3, 7]], item="EURUSD"))
    rows = mt.orderBy("timestamp").collect()
    assert [(r["from_currency"], r["to_currency"], r["real_volume"]) for r in rows] == [("EUR", "USD", None), ("EUR", "USD", 7)]
    kline = [1700000000000, "41.5", "44", "40.25", "43", "17.5", 1700086399999, "740.1", 61, "9", "2", "0"]
    rows = payloads.klines(raw([kline], {"code": -1121, "msg": "bad"}, item="BTCUSDT")).collect()
    assert len(rows) == 1 and (rows[0]["open"], rows[0]["close"], rows[0]["volume"], rows[0]["trades"]) == (41.5, 43, 17.5, 61)
    candle = payloads.exchange_candles(raw([[1700000000, 40.25, 44.0, 41.5, 43.0, 17.5]]), "1d").first()
    assert (candle["open"], candle["high"], candle["low"], candle["close"], candle["granularity_seconds"]) == (41.5, 44, 40.25, 43, 86400)


def test_exchange_tickers(raw):
    one = {"symbol": "BTCUSDT", "lastPrice": "43.5", "priceChangePercent": "-0.7", "openTime": 1700000000000}
    rows = payloads.day_tickers(raw(one, [one, {**one, "symbol": "ETHUSDT"}], {"code": -1})).collect()
    assert sorted(r["symbol"] for r in rows) == ["BTCUSDT", "BTCUSDT", "ETHUSDT"] and rows[0]["last_price"] == 43.5
    rows = payloads.exchange_tickers(raw({"trade_id": 8, "price": "61.75"}, {"message": "Invalid"})).collect()
    assert [(r["price"], r["time"]) for r in rows] == [(61.75, None)]


def test_dated_series_and_spot_rates(raw):
    bar = lambda v: {"1. open": v, "2. high": v, "3. low": v, "4. close": v, "5. volume": "10"}
    body = {"Meta Data": {"x": "y"}, "Time Series (Daily)": {"2024-01-01": bar("1.5"), "2024-01-03": bar("3.5"), "2024-01-02": bar("2.5")}}
    assert [r["close"] for r in payloads.dated_series(raw(body)).orderBy("date").collect()] == [1.5, 2.5, 3.5]
    assert [r["close"] for r in payloads.dated_series(raw(body), newest=2).orderBy("date").collect()] == [2.5, 3.5]
    rate = {"Realtime Currency Exchange Rate": {"1. From_Currency Code": "EUR", "3. To_Currency Code": "USD", "5. Exchange Rate": "1.09"}}
    row = payloads.spot_rates(raw(rate, {"Note": "limit"})).collect()
    assert [(r["pair"], r["rate"]) for r in row] == [("EUR/USD", 1.09)]


def test_symbol_record(raw):
    row = payloads.symbol_records(raw({"spread": 2, "point": 0.00001, "digits": 5, "bid": 1.1, "trade_tick_size": 0.1})).first()
    assert (row["digits"], row["tick_size"]) == (5, 0.1)


def test_every_reader_survives_garbage(raw):
    bad = raw(None, "", "{", "[]", "{}", "[[]]", '{"data":5}', '"text"', "7")
    for name in payloads.READERS:
        options = {"symbol_records": {}}.get(name, {})
        payloads.read(name, bad, **options).collect()


def test_universe(spark):
    assert tables.universe(spark).filter("asset_type = 'forex'").count() == 7
    assert tables.members("index", "uk") == ("FTSE",) and "SPY" in tables.members("etf", "none")
