from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import jobs, star
from tidemark.sinks import tables
from tidemark.sources import tables as sources
from tidemark.streaming import streams

D = dt.date(2024, 1, 1)
DDL = "symbol string, date date, open double, high double, low double, close double, volume bigint"
ROWS = [("AAPL", D, 150.0, 160.0, 140.0, 155.0, 1000000), ("GOOGL", D, 140.0, 145.0, 135.0, 142.0, 900000)]


def upsert(spark, path, df, **options):
    stored, parts = tables.by_period(df, "date", "year")
    return tables.merge_upsert(spark, path, stored, ["symbol", "date"], parts, **options)


def test_upsert_twice(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    df = frame(DDL, *ROWS)
    assert upsert(spark, path, df) == {"total": 2, "inserted": 2, "updated": 0}
    assert upsert(spark, path, df) == {"total": 2, "inserted": 0, "updated": 2}
    more = frame(DDL, *ROWS, ("MSFT", D, 380.0, 390.0, 370.0, 385.0, 800000))
    assert upsert(spark, path, more)["inserted"] == 1
    assert spark.read.parquet(path).count() == 3


def test_upsert_leaves_other_partitions_alone(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    upsert(spark, path, frame(DDL, *ROWS, ("AAPL", dt.date(2020, 5, 5), 1.0, 1.0, 1.0, 1.0, 1)))
    upsert(spark, path, frame(DDL, ("AAPL", D, 1.0, 2.0, 1.0, 2.0, 5)))
    rows = {(r["symbol"], r["date"].year): r["close"] for r in spark.read.parquet(path).collect()}
    assert rows == {("AAPL", 2024): 2.0, ("GOOGL", 2024): 142.0, ("AAPL", 2020): 1.0}


def test_last_of_repeated_keys_wins_and_null_keys_match(spark, frame, tmp_path):
    ddl = "k string, broker string, v int, n int"
    path = f"{tmp_path}/t"
    first = frame(ddl, ("a", None, 1, 1), ("a", None, 2, 2), (None, "x", 3, 1))
    tables.merge_upsert(spark, path, first, ["k", "broker"], order=["n"], null_keys={"broker": "default"})
    second = frame(ddl, ("a", "default", 9, 1), (None, "x", 4, 1))
    done = tables.merge_upsert(spark, path, second, ["k", "broker"], order=["n"], null_keys={"broker": "default"})
    assert done == {"total": 2, "inserted": 0, "updated": 2}
    assert sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(path).collect()) == [("", 4), ("a", 9)]


def test_created_at_is_kept(spark, frame):
    ddl = "k string, v int, created_at timestamp, updated_at timestamp"
    old = frame(ddl, ("a", 1, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)), ("b", 2, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)))
    new = frame("k string, v int", ("a", 5))
    rows = {r["k"]: r for r in tables.merged_rows(old, new, ["k"], now=F.lit("2024-01-01").cast("timestamp")).collect()}
    assert (rows["a"]["v"], rows["a"]["created_at"].year, rows["a"]["updated_at"].year, rows["a"]["_state"]) == (5, 2020, 2024, "updated")
    assert (rows["b"]["updated_at"].year, rows["b"]["_state"]) == (2020, "kept")


def test_revisions(spark, frame):
    ddl = "k string, v int, is_revised boolean, revision_number int"
    old = frame(ddl, ("a", 1, False, 0), ("b", 1, True, 2))
    new = frame("k string, v int", ("a", 5), ("c", 7))
    rows = {r["k"]: (r["v"], r["is_revised"], r["revision_number"]) for r in tables.merged_rows(old, new, ["k"], revisions="v").collect()}
    assert rows == {"a": (5, True, 1), "b": (1, True, 2), "c": (7, False, 0)}


def test_insert_ignore(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    tables.insert_ignore(spark, path, frame("k string, v int", ("a", 1)), ["k"])
    tables.insert_ignore(spark, path, frame("k string, v int", ("a", 9), ("b", 2), ("b", 3)), ["k"], order=["v"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]


def test_model_rows(spark, frame):
    df = frame(
        "symbol string, date date, open double, volume string, note string",
        ("AAPL", D, 1.0, "10", "x"), ("GOOGL", D, float("nan"), "20", "x"), ("MSFT", D, 1.0, "many", "x"), (None, D, 1.0, "1", "x"),
    )
    good, bad = tables.model_rows(df, schemas.entity("stock_prices"), "feed")
    rows = {r["symbol"]: r for r in good.collect()}
    assert set(rows) == {"AAPL", "GOOGL"} and rows["GOOGL"]["open"] is None and rows["AAPL"]["source"] == "feed"
    assert "note" not in good.columns and rows["AAPL"]["created_at"] is not None
    assert sorted(tuple(r["rejected"]) for r in bad.collect()) == [("symbol missing",), ("volume",)]


def test_rows_as_json(frame):
    df = frame("t timestamp, v double, a array<double>", (dt.datetime(2024, 1, 1, 5), float("nan"), [1.0]))
    assert json.loads(tables.as_json(df).first()[0]) == {"t": "2024-01-01T05:00:00Z", "v": None, "a": [1.0]}


def test_run_records(spark, tmp_path):
    path = f"{tmp_path}/runs"
    tables.start_run(spark, path, "stock", "r1")
    tables.start_run(spark, path, "stock", "r2")
    assert tables.complete_run(spark, path, "r1", 100, 5, 2) == "run r1 completed"
    assert tables.complete_run(spark, path, "zz", 1, 0) == "run zz not found"
    rows = {r["run_id"]: r for r in spark.read.parquet(path).collect()}
    assert rows["r1"]["status"] == "partial_success" and rows["r1"]["records_failed"] == 5 and rows["r1"]["duration_seconds"] >= 0
    assert rows["r2"]["status"] == "running"
    assert [tables.run_status(1, 0), tables.run_status(2, 2), tables.run_status(0, 0, "x")] == ["success", "failed", "failed"]


def test_retention(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    df = frame("k string, date date, v int", *[("a", dt.date(y, m, 15), y) for y in (2020, 2021, 2022) for m in (3, 9)])
    stored, parts = tables.by_period(df, "date", "year")
    tables.store(stored, path, parts)
    summary = (f"{tmp_path}/s", ["k"], {"n": F.count(F.lit(1))})
    assert tables.retain(spark, path, parts, "date", "2021-06-01", archive=f"{tmp_path}/a", summary=summary) == 1
    assert sorted(str(r["date"]) for r in spark.read.parquet(path).collect()) == ["2021-09-15", "2022-03-15", "2022-09-15"]
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3 and spark.read.parquet(f"{tmp_path}/s").first()["n"] == 3


@pytest.mark.parametrize("unit", ["year", "month", "day"])
def test_retention_by_bounds_reads_the_partition_at_the_cutoff(spark, frame, tmp_path, unit):
    times = [dt.datetime(2021, 1, 31, 23), dt.datetime(2021, 6, 1), dt.datetime(2021, 6, 1, 9), dt.datetime(2021, 6, 2), dt.datetime(2022, 1, 1), None]
    path = f"{tmp_path}/by-{unit}"
    stored, parts = tables.by_period(frame("n int, at timestamp", *enumerate(times)), "at", unit)
    tables.store(stored, path, parts)
    limit = F.lit("2021-06-01 05:00:00").cast("timestamp")
    read = tables.at_cutoff(spark.read.parquet(path), parts, limit)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert parts[0] in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["n"] for r in read.collect()} == {"year": {0, 1, 2, 3}, "month": {1, 2, 3}, "day": {1, 2}}[unit]
    assert tables.retain(spark, path, parts, "at", "2021-06-01 05:00:00") == {"year": 0, "month": 1, "day": 1}[unit]
    assert {r["n"] for r in spark.read.parquet(path).collect()} == {2, 3, 4, 5}
    assert tables.retain(spark, path, parts, "at", "2021-12-31 23:00:00") == 1 + (unit == "day")
    assert {r["n"] for r in spark.read.parquet(path).collect()} == {4, 5}


# --- dimensions ---------------------------------------------------------------------------------------


def test_star(spark, frame):
    assert star.date_dim(spark).count() == 11323
    facts = frame("symbol string, date date, close double", ("A", D, 1.0), ("B", D, 2.0), ("Z", D, 3.0))
    symbols = star.dim(frame("symbol string, name string", ("A", "x"), ("A", "y"), ("B", "z")), ["symbol"], ["name"], "symbol_key")
    assert symbols.count() == 2
    rows = star.price_facts(facts, symbols).orderBy("close").collect()
    assert rows[2]["symbol_key"] == star.UNKNOWN and rows[0]["symbol_key"] != star.UNKNOWN and rows[0]["date_key"] == 20240101


def test_attributes_of_a_member_come_from_one_row(frame):
    df = frame("s string, at int, a string, b int", ("x", 1, "z", 1), ("x", 2, "a", None), ("y", 1, "m", 5))
    assert {(r["s"], r["a"], r["b"]) for r in star.dim(df, ["s"], ["a", "b"], "k", ["at"]).collect()} == {("x", "a", None), ("y", "m", 5)}


@pytest.mark.parametrize("size", [1_000_000, 2])
def test_versions_of_a_dimension(frame, size):
    d = lambda x: dt.datetime(2024, 1, x)
    rows = [
        ("x", d(1), 1, "a", 1), ("x", d(2), 1, "a", 1), ("x", d(3), 1, "b", None), ("x", d(3), 2, "b", 2), ("x", d(5), 1, "b", 2),
        ("x", d(7), 1, "a", 1), (None, d(4), 1, None, None), (None, d(6), 1, None, None), ("y", None, 1, "q", 1),
    ]
    versions = star.dim_versions(frame("s string, at timestamp, seq int, a string, b int", *rows), ["s"], ["a", "b"], "at", "key", ["seq"], size)
    found = {(r["s"], r["version"]): (r["a"], r["b"], r["valid_from"], r["valid_to"], r["key"]) for r in versions.collect()}
    assert {k: v[:4] for k, v in found.items()} == {
        ("x", 1): ("a", 1, d(1), d(3)), ("x", 2): ("b", 2, d(3), d(7)), ("x", 3): ("a", 1, d(7), None), (None, 1): (None, None, d(4), None),
    }
    facts = frame("s string, at timestamp, n int", ("x", d(1), 1), ("x", d(6), 2), ("x", d(7), 3), ("x", d(30), 4), (None, d(3), 5), ("z", d(3), 6))
    keyed = star.with_version(facts, versions, ["s"], "at", "key", ["version"], size)
    by_n = {r["n"]: r for r in keyed.collect()}
    assert {n: r["version"] for n, r in by_n.items()} == {1: 1, 2: 2, 3: 3, 4: 3, 5: None, 6: None}
    assert by_n[2]["key"] == found["x", 2][4] and by_n[6]["key"] == star.UNKNOWN



# --- streams ------------------------------------------------------------------------------------------


def land(spark, frame, path, *rows):
    frame("symbol string, ts timestamp, price double, volume bigint", *rows).coalesce(1).write.mode("append").parquet(path)


def tick(h, m, p, v=1):
    return ("A", dt.datetime(2024, 1, 1, h, m), p, v)


def test_folded_bars_take_late_ticks_and_replays(spark, frame, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, frame, source, tick(0, 10, 5.0), tick(0, 50, 7.0), tick(1, 5, 1.0))
    schema = spark.read.parquet(source).schema

    def run():
        stream = streams.ingest(spark, source, schema)
        streams.keep_bars(stream, out, f"{tmp_path}/cp", ["symbol"], "ts", "price", "volume", "1h").awaitTermination()
        return {r["bar"].hour: (r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in spark.read.parquet(out).collect()}

    assert run() == {0: (5, 7, 5, 7, 2), 1: (1, 1, 1, 1, 1)}
    land(spark, frame, source, tick(0, 1, 3.0), tick(0, 59, 4.0), tick(2, 0, 9.0))
    expected = {0: (3, 7, 3, 4, 4), 1: (1, 1, 1, 1, 1), 2: (9, 9, 9, 9, 1)}
    assert run() == expected
    batch = streams.partial_bars(frame("symbol string, ts timestamp, price double, volume bigint", tick(0, 1, 3.0)), ["symbol"], "ts", "price", "volume", "1h")
    known = streams.stream_id(spark, f"{tmp_path}/cp")
    streams.combine_bars(spark, out, batch, 1, ["symbol"], known)  # batch 1 has been applied already
    assert run() == expected
    # A stream with a new checkpoint counts its batches from 0 again, and is another stream.
    late = f"{tmp_path}/late"
    land(spark, frame, late, tick(1, 30, 8.0))
    streams.keep_bars(
        streams.ingest(spark, late, schema), out, f"{tmp_path}/cp2", ["symbol"], "ts", "price", "volume", "1h"
    ).awaitTermination()
    assert run() == {**expected, 1: (1, 8, 1, 8, 2)}


def test_stream_upsert_equals_batch(spark, frame, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    land(spark, frame, source, tick(0, 1, 1.0), tick(0, 2, 2.0))
    schema = spark.read.parquet(source).schema
    for rows in ([], [tick(0, 1, 8.0)]):
        if rows:
            land(spark, frame, source, *rows)
        stream = streams.ingest(spark, source, schema)
        streams.upsert(stream, out, f"{tmp_path}/cp", ["symbol", "ts"]).awaitTermination()
    assert sorted(r["price"] for r in spark.read.parquet(out).collect()) == [2.0, 8.0]


def test_stream_of_payloads(spark, tmp_path):
    body = {"values": [{"datetime": "2024-01-01", "close": "1.5"}, {"datetime": "2024-01-02", "close": "2.5"}]}
    raw = spark.createDataFrame([(json.dumps(body), "A", None)], "payload string, item string, requested_at timestamp")
    raw.write.parquet(f"{tmp_path}/in")
    from tidemark.sources import payloads

    stream = streams.read_payloads(payloads.landed(spark, f"{tmp_path}/in", stream=True), "bars")
    streams.to_table(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


# --- whole jobs ----------------------------------------------------------------------------------------


def payload(symbol, days, close=lambda n: 1.5):
    values = [
        {"datetime": f"2024-01-{n:02d}", "open": "1.2", "high": "2.0", "low": "1.0", "close": str(close(n)), "volume": "100"} for n in days
    ]
    return (json.dumps({"meta": {"currency": "USD"}, "values": values}), symbol)


def test_stock_job(spark, frame, tmp_path):
    raw = frame(
        "payload string, item string",
        payload("AAPL", range(1, 11), lambda n: 1.1 + n / 100), payload("MSFT.US", range(1, 11), lambda n: 1.2 + n / 100),
        ('{"code": 429, "message": "slow"}', "GOOGL"),
    )
    out = jobs.run(spark, jobs.JOBS["stock"], raw, f"{tmp_path}/t", runs=f"{tmp_path}/runs", run_id="r1")
    assert out.counts == {"total": 20, "inserted": 20, "updated": 0, "failed": 0, "merged": 0}
    assert [r["error_kind"] for r in out.rejected.collect()] == ["rate_limit"]
    stored = spark.read.parquet(f"{tmp_path}/t/stock_prices")
    assert {r["symbol"] for r in stored.select("symbol").distinct().collect()} == {"AAPL", "MSFT"}
    assert dict(stored.dtypes)["close"] == "decimal(12,4)"
    assert spark.read.parquet(f"{tmp_path}/runs").first()["status"] == "success"
    again = jobs.run(spark, jobs.JOBS["stock"], raw, f"{tmp_path}/t")
    assert again.counts["updated"] == 20 and again.counts["inserted"] == 0


def test_job_sends_broken_rows_to_quarantine(spark, frame, tmp_path):
    raw = frame("payload string, item string", payload("AAPL", range(1, 21), lambda n: 9.0 if n == 3 else 1.1 + n / 100))
    out = jobs.run(spark, jobs.JOBS["stock"], raw, f"{tmp_path}/t", run_id="r")
    assert (out.counts["total"], out.counts["failed"]) == (19, 1)
    row = spark.read.parquet(f"{tmp_path}/t/quarantine").first()
    assert row["failed_checks"] == ["high_gte_close"] and row["table_name"] == "stock_prices"


def test_other_jobs_and_success_table(spark, frame, tmp_path):
    obs = [{"date": f"2024-{m:02d}-01", "value": str(m), "realtime_start": "2024-06-01", "realtime_end": "9999-12-31"} for m in range(1, 7)]
    fx = [{"t": 1704067200000 + h * 3600000, "o": 1.1, "h": 1.3, "l": 1.0, "c": 1.2 + h / 1000} for h in range(5)]
    sky = lambda h: {"cod": 200, "dt": 1704067200 + h * 3600, "main": {"temp": 10 + h, "humidity": 50, "pressure": 1000}, "wind": {"speed": 3 + h}, "weather": [{"main": "Rain"}]}
    raw = {
        "fred": frame("payload string, item string", (json.dumps({"observations": obs}), "GDP")),
        "forex": frame("payload string, item string", (json.dumps({"results": fx}), "EUR/USD")),
        "weather": frame("payload string, item string", *[(json.dumps(sky(h)), "London") for h in range(4)]),
        "finnhub": frame("payload string, item string", (json.dumps({"s": "ok", "t": [1704067200], "o": [1], "h": [2], "l": [1], "c": [1.5], "v": [3]}), "AAPL")),
        "crypto": frame("payload string, item string", (json.dumps([[1609459200000, "1", "3", "1", "2", "5", 1, "9", 4]]), "BTC-USD")),
    }
    done = {r["job"]: r for r in jobs.run_all(spark, raw, f"{tmp_path}/t", f"{tmp_path}/runs", "day1").collect()}
    assert {name: (r["status"], r["loaded"], r["error"]) for name, r in done.items()} == {
        "fred": ("success", 6, None), "forex": ("success", 1, None), "weather": ("success", 4, None),
        "finnhub": ("success", 1, None), "crypto": ("success", 1, None),
    }
    rate = spark.read.parquet(f"{tmp_path}/t/forex_rates").first()
    assert (rate["from_currency"], rate["to_currency"]) == ("EUR", "USD")
    assert spark.read.parquet(f"{tmp_path}/t/weather_data").first()["weather_condition"] == "Rain"
    assert spark.read.parquet(f"{tmp_path}/runs").filter("status = 'success'").count() == 5


def test_job_with_features_and_layers(spark, frame, tmp_path):
    raw = frame("payload string, item string", payload("AAPL", range(1, 11), lambda n: 1.1 + n / 100))
    out = jobs.run(spark, jobs.JOBS["stock"], raw, with_features=True)
    assert "close_lag_1" in out.rows.columns and out.summary.first()["is_valid"]
    jobs.medallion(spark, jobs.JOBS["stock"], raw, f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m/gold/daily_stats_stock").count() == 10
    assert spark.read.parquet(f"{tmp_path}/m/bronze/stock").count() == 1


@pytest.mark.parametrize("counts, ok", [([(95, 5), (100, 0)], True), ([(90, 10)], False)])
def test_load_check(frame, counts, ok):
    assert jobs.load_check(frame("loaded bigint, failed bigint", *counts)).first()["ok"] is ok


def test_an_older_row_in_a_later_batch_changes_nothing(spark, frame, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    ddl = "k string, at timestamp, v int"

    def batch(*rows):
        frame(ddl, *rows).write.mode("append").parquet(source)
        stream = streams.ingest(spark, source, frame(ddl).schema)
        streams.upsert(stream, out, f"{tmp_path}/cp", ["k"], order=["at", "v"]).awaitTermination()
        return sorted((r["k"], r["v"]) for r in spark.read.parquet(out).collect())

    day = lambda n: dt.datetime(2024, 1, n)
    assert batch(("a", day(5), 1), ("b", day(1), 2)) == [("a", 1), ("b", 2)]
    assert batch(("a", day(4), 9), ("b", day(2), 3), ("c", None, 7)) == [("a", 1), ("b", 3), ("c", 7)]


def test_daily_stream_bars_with_ties(spark, frame, tmp_path):
    rows = frame("symbol string, ts timestamp, seq int, price double, volume bigint", *[
        ("s", dt.datetime(2024, 1, 1, 9), n, float(p), 1) for n, p in ((2, 5), (1, 3), (3, 4))
    ])
    bar = streams.partial_bars(rows, ["symbol"], "ts", "price", "volume", "1d", ["seq"]).first()
    assert (bar["open"], bar["high"], bar["low"], bar["close"], bar["volume"]) == (3, 5, 3, 4, 3)


def test_retention_keeps_rows_without_a_time(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    day = lambda y, m: dt.datetime(y, m, 1)
    rows = [("x y", day(2020, 1)), ("x y", None), ("z=1", day(2019, 1)), (None, day(2019, 2)), (None, day(2022, 1)), ("w", day(2023, 1))]
    tables.store(frame("p string, at timestamp", *rows), path, ["p"])
    assert tables.retain(spark, path, ["p"], "at", "2021-01-01") == 1
    kept = spark.read.parquet(path).collect()
    assert sorted((r["p"] or "", r["at"] and r["at"].year) for r in kept) == [("", 2022), ("w", 2023), ("x y", None)]


def test_a_failed_run_is_closed(spark, frame, tmp_path, monkeypatch):
    from tidemark.plans import jobs

    runs = str(tmp_path / "runs")
    monkeypatch.setattr(jobs, "load", lambda *a: (_ for _ in ()).throw(ValueError("x" * 900)))
    monkeypatch.setattr(jobs, "read_job", lambda job, raw: (raw, raw))
    monkeypatch.setattr(jobs, "transform", lambda *a: (raw, frame("symbol string, check_name string, status string")))
    monkeypatch.setattr(jobs.validate, "summary", lambda *a: None)
    raw = frame("symbol string", ("a",))
    with pytest.raises(ValueError):
        jobs.run(spark, jobs.JOBS["stock"], raw, str(tmp_path), runs=runs, run_id="r1")
    found = spark.read.parquet(runs).first()
    assert (found["status"], found["error_message"]) == ("failed", "x" * 900)


def test_features_of_bars_that_were_folded(spark, frame):
    values = [
        {"datetime": f"2024-01-{d:02d} {h}:00:00", "open": "1.2", "high": "9", "low": "1", "close": str(d + h / 100), "volume": "1"}
        for d in range(1, 6) for h in (10, 11)
    ]
    raw = frame("payload string, item string", (json.dumps({"values": values}), "AAPL"))
    rows = jobs.run(spark, jobs.JOBS["stock"], raw, with_features=True).rows.orderBy("timestamp").collect()
    assert [r["close"] for r in rows] == [1.11, 2.11, 3.11, 4.11, 5.11]
    assert [r["close_lag_1"] for r in rows] == [None, 1.11, 2.11, 3.11, 4.11]
    assert rows[2]["close_ma_3"] == pytest.approx(2.11) and rows[4]["close_std_3"] == pytest.approx(1.0)


def test_every_delivered_row_is_counted(spark, frame, tmp_path):
    def value(at, close="1.5"):
        return {"datetime": at, "open": "1.2", "high": "2.0", "low": "1.0", "close": close, "volume": "100"}

    values = [value(f"2024-01-{d:02d} 10:00:00") for d in range(1, 6)]
    # Two more ticks of a day, a repeat of one, three times that are none, and a bar whose close is above its high.
    values += [value("2024-01-02 11:00:00"), value("2024-01-02 12:00:00", "1.6"), value("2024-01-02 11:00:00")]
    values += [value("soon"), value("later"), value(None), value("2024-01-06 10:00:00", "9")]
    raw = frame("payload string, item string", (json.dumps({"values": values}), "AAPL"))
    out = jobs.run(spark, jobs.JOBS["stock"], raw, f"{tmp_path}/t", run_id="r")
    assert out.delivered == 12 == out.counts["total"] + out.counts["merged"] + out.counts["failed"]
    assert (out.counts["total"], out.counts["merged"], out.counts["failed"]) == (5, 3, 4)
    failed = [r["failed_checks"] for r in spark.read.parquet(f"{tmp_path}/t/quarantine").collect()]
    assert len(failed) == 4 and sum(f == ["high_gte_close"] for f in failed) == 1
    assert sum("date missing" in f or "null_timestamps" in f for f in failed) == 3


# --- late rows and copies across batches ---------------------------------------------------------------


def test_late_ticks_wait_and_are_folded_once(spark, frame, tmp_path):
    ddl = "symbol string, ts timestamp, price double, volume bigint"
    source, out, late = f"{tmp_path}/in", f"{tmp_path}/bars", f"{tmp_path}/late"
    how = (["symbol"], "ts", "price", "volume", "1h")
    at = lambda day, minute: dt.datetime(2024, 1, day, 10, minute)

    def deliver(*rows):
        frame(ddl, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = streams.ingest(spark, source, frame(ddl).schema)
        streams.keep_bars(stream, out, f"{tmp_path}/cp", *how, late=late, delay="1 hour").awaitTermination()

    def bars():
        return sorted((r.symbol, r.bar.day, r.open, r.high, r.low, r.close, r.volume) for r in spark.read.parquet(out).collect())

    deliver(("a", at(1, 10), 2.0, 1), ("a", at(5, 10), 5.0, 1))
    assert streams.late_rows(spark, late) is None
    assert streams.fold_late(spark, out, late, *how) == 0
    deliver(("a", at(1, 5), 1.0, 1), ("a", at(5, 5), 9.0, 1), ("b", at(2, 0), 7.0, 1), ("a", None, 3.0, 1))
    # Within an hour of the latest time is in time; both earlier days wait.
    assert bars() == [("a", 1, 2.0, 2.0, 2.0, 2.0, 1), ("a", 5, 9.0, 9.0, 5.0, 5.0, 2)]
    assert streams.late_rows(spark, late).count() == 2
    assert streams.fold_late(spark, out, late, *how) == 1
    folded = [("a", 1, 1.0, 2.0, 1.0, 2.0, 2), ("a", 5, 9.0, 9.0, 5.0, 5.0, 2), ("b", 2, 7.0, 7.0, 7.0, 7.0, 1)]
    assert bars() == folded
    assert streams.fold_late(spark, out, late, *how) == 0
    assert bars() == folded

    # A fold that stops after its rows are in and before it is noted is repeated, without a double count.
    deliver(("a", at(1, 20), 4.0, 1))
    name = streams.stream_id(spark, f"{tmp_path}/cp")
    rows = streams.late_rows(spark, late).filter("late_batch = 2")
    frame("stream string, upto bigint, done boolean", (name, 2, False)).write.mode("append").parquet(f"{late}/folds")
    streams.combine_bars(spark, out, streams.partial_bars(rows, *how), 2, ["symbol"], f"late {name}")
    deliver(("a", at(1, 30), 8.0, 1))
    assert streams.fold_late(spark, out, late, *how) == 1  # the planned range only
    assert bars()[0] == ("a", 1, 1.0, 4.0, 1.0, 4.0, 3)
    assert streams.fold_late(spark, out, late, *how) == 1
    assert bars()[0] == ("a", 1, 1.0, 8.0, 1.0, 8.0, 4)


def test_a_repeated_batch_is_divided_as_before(spark, frame, tmp_path):
    late, ddl = f"{tmp_path}/late", "k bigint, ts timestamp"
    first = frame(ddl, (1, dt.datetime(2024, 1, 5)))
    second = frame(ddl, (2, dt.datetime(2024, 1, 1)), (3, dt.datetime(2024, 1, 9)))
    streams.set_late_aside(first, 0, late, "s", "ts", "1 day")
    for _ in range(2):
        kept = streams.set_late_aside(second, 1, late, "s", "ts", "1 day")
        assert [r.k for r in kept.collect()] == [3]
        assert [r.k for r in streams.late_rows(spark, late).collect()] == [2]
    # Another stream has times of its own.
    assert streams.set_late_aside(second, 0, late, "t", "ts", "1 day").count() == 2


def test_copies_in_different_files_are_stored_once(spark, frame, tmp_path):
    ddl = "k bigint, ts timestamp, v string"
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    deliveries = [
        [(1, dt.datetime(2024, 1, 9), "x"), (1, dt.datetime(2024, 1, 9), "x"), (2, None, "n"), (None, dt.datetime(2024, 1, 1), "z")],
        [(1, dt.datetime(2024, 1, 9), "x"), (2, None, "n"), (3, dt.datetime(2023, 1, 1), "old"), (None, dt.datetime(2024, 1, 1), "z")],
    ]
    for rows in deliveries:
        frame(ddl, *rows).coalesce(1).write.mode("append").parquet(source)
        streams.keep_new(streams.ingest(spark, source, frame(ddl).schema), out, f"{tmp_path}/cp", ["k"], "ts").awaitTermination()
    got = sorted((str(r.k), r.v) for r in spark.read.parquet(out).collect())
    assert got == [("1", "x"), ("2", "n"), ("3", "old"), ("None", "z")]


def test_news_without_text_time_or_relation(spark, frame, tmp_path):
    items = [
        {"id": 1, "datetime": 1704067200, "headline": "Great gain", "summary": "", "related": "ACME", "url": "u1"},
        {"id": 2, "datetime": 1704067200, "headline": None, "summary": None, "related": " ", "url": "u2"},
        {"id": 3, "headline": "Late", "related": "ACME", "url": "u3"},
        {"id": 1, "datetime": 1704067200, "headline": "Great gain", "summary": "", "related": "ACME", "url": "u1"},
    ]
    raw = frame("payload string", (json.dumps(items),), (None,), ('{"code": 429}',))
    counts = jobs.news_sentiment(spark, raw, f"{tmp_path}/t", runs=f"{tmp_path}/runs", run_id="n1")
    assert counts == {"total": 2, "inserted": 2, "updated": 0, "failed": 1, "merged": 1}
    rows = {r["entity"]: r for r in spark.read.parquet(f"{tmp_path}/t/sentiment_data").collect()}
    assert (float(rows["ACME"]["sentiment_score"]), float(rows["ACME"]["confidence"])) == (0.6, 0.425)
    assert (float(rows["general"]["sentiment_score"]), float(rows["general"]["confidence"]), rows["general"]["raw_text"]) == (0, 1, None)
    assert spark.read.parquet(f"{tmp_path}/runs").first()["status"] == "partial_success"
    days = jobs.sentiment_days(spark.read.parquet(f"{tmp_path}/t/sentiment_data"))
    assert {r["entity"]: r["sentiment_polarity_count"] for r in days.collect()} == {"ACME": 1, "general": 1}


def test_a_run_that_fails_before_loading_is_closed_as_failed(spark, frame, tmp_path):
    with pytest.raises(Exception):
        jobs.run(spark, jobs.JOBS["stock"], frame("item string", ("AAPL",)), f"{tmp_path}/t", runs=f"{tmp_path}/runs", run_id="x")
    run = spark.read.parquet(f"{tmp_path}/runs").first()
    assert (run["status"], run["records_processed"]) == ("failed", 0) and run["error_message"] and run["ended_at"]


def test_weather_days_fill_gaps_and_replace_a_day(spark, frame, tmp_path):
    sky = lambda hour, temp: json.dumps({"cod": 200, "coord": {"lat": 1, "lon": 2}, "dt": 1704067200 + hour * 3600, "main": {"temp": temp, "humidity": 50}})
    first = frame("payload string, item string", (sky(0, None), "Rome"), (sky(1, 10), "Rome"), (sky(2, 14), "Rome"), (sky(2, 14), "Rome"), (None, "Rome"))
    assert jobs.weather_days(spark, first, str(tmp_path))["inserted"] == 1
    day = spark.read.parquet(f"{tmp_path}/weather_daily").first()
    assert (day["temperature_daily_min"], day["temperature_daily_max"], day["rain_1h_daily_total"]) == (10, 14, 0)
    again = frame("payload string, item string", (sky(0, 5), "Rome"), (sky(30, 7), "Rome"))
    assert jobs.weather_days(spark, again, str(tmp_path)) == {"total": 2, "inserted": 1, "updated": 1}
    stored = {str(r["date"]): r["temperature_daily_max"] for r in spark.read.parquet(f"{tmp_path}/weather_daily").collect()}
    assert stored == {"2024-01-01": 5, "2024-01-02": 7}


def test_coverage_of_the_catalogue(frame):
    rows = {(r["asset_type"], r["item"], r["category"]): r["n"] for r in sources.coverage(frame("s string", ("SPY",), ("SPY",), ("none",), (None,)), "s").collect()}
    assert rows["etf", "SPY", None] == rows["fund", "SPY", "broad_market"] == 2 and rows["stock", "AAPL", None] == 0
    assert sum(rows.values()) == 4
