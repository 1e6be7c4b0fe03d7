"""Chunked windows must equal plain windows, and quantiles from sketches the exact ones."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from conftest import column
from pyspark.sql import functions as F

import tidemark.operators.features as features_module
import tidemark.operators.series as series_module
import tidemark.operators.stats as stats
from tidemark.operators.features import ema
from tidemark.operators.series import chunked, in_chunks, over_series, running, series


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, in bursts, with ties, null values and null times; another is tiny."""
    rng = random.Random(7)
    rows, n = [], 0
    for key, size in (("hot", 1500), ("warm", 300), (None, 40), ("one", 1)):
        t = 0
        for _ in range(size):
            t += rng.choice([0, 0, 1, 1, 2, 5, 400 if rng.random() < 0.05 else 1])
            value = None if rng.random() < 0.2 else rng.random() * 100
            rows.append((key, t if rng.random() > 0.01 else None, n, value))
            n += 1
    raw = spark.createDataFrame(rows, "k string, t long, id long, v double")
    return raw.withColumn("ts", F.timestamp_seconds("t")).drop("t").cache()


S = series("k", "ts", "id")


def as_table(df, columns):
    return df.select("id", *columns).toPandas().sort_values("id").reset_index(drop=True)


def steps(frame, part):
    w = part.window()
    return frame.withColumns(
        {
            "lag_1": F.lag("v", 1).over(w),
            "lag_9": F.lag("v", 9).over(w),
            "lead_4": F.lead("v", 4).over(w),
            "mean": F.avg("v").over(w.rowsBetween(-9, 0)),
            "count": F.count("v").over(w.rowsBetween(-3, 6)),
        }
    )


@pytest.mark.parametrize("size", [10, 33, 100, 700])
def test_chunked_windows_equal_plain_windows(skewed, size):
    names = ["lag_1", "lag_9", "lead_4", "mean", "count"]
    plain = as_table(over_series(skewed, S, steps, 9, 6), names)
    chunked = as_table(over_series(skewed, S, steps, 9, 6, rows_per_chunk=size), names)
    pd.testing.assert_frame_equal(plain, chunked)


@pytest.mark.parametrize("size", [10, 120])
def test_running_columns_equal_plain_windows(skewed, size):
    spec = {"top": ("max", "v"), "total": ("sum", "v"), "before": ("last", "v"), "after": ("next", "v")}
    plain = as_table(running(skewed, S, spec), list(spec))
    chunked = as_table(running(skewed, S, spec, rows_per_chunk=size), list(spec))
    pd.testing.assert_frame_equal(plain, chunked)


def test_no_row_is_lost_or_repeated(skewed):
    out = over_series(skewed, S, steps, 9, rows_per_chunk=25)
    assert out.count() == skewed.count() == out.select("id").distinct().count()


def test_short_chunks_do_not_multiply_tasks(spark, skewed):
    """Rows are numbered in tasks that follow the rows, however short the chunks are; each non-empty task writes a file."""
    hot, cold = chunked(skewed, S, 2)
    assert hot.count() + cold.count() == skewed.count()
    assert len(hot.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, part = in_chunks(skewed, S, 2)
    sizes = rows.groupBy(*part.keys).count().toPandas()
    assert sizes["count"].max() == 2 and len(sizes) == 750 + 150 + 20 + 1


def test_ranges_drawn_by_the_driver_follow_the_rows(spark, skewed, monkeypatch):
    """The driver samples rows for each range, so their number must not follow the chunks."""
    asked, numbered = [], series_module._numbered
    monkeypatch.setattr(series_module, "_numbered", lambda rows, s, n: asked.append(n) or numbered(rows, s, n))
    out = over_series(skewed, S, steps, 9, 6, rows_per_chunk=20)
    running(out, S, {"top": ("max", "v")}, rows_per_chunk=20)
    assert len(asked) == 2 and max(asked) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ema_matches_the_recursive_definition(frame):
    df = frame("k string, t long, v double", ("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 4.0), ("a", 4, 8.0))
    assert column(ema(df, series("k", "t"), "v", (3,)), "ema_3", "t") == pytest.approx([1, 1.5, 2.75, 5.375])


@pytest.mark.parametrize("size", [None, 600])
def test_ema_with_gaps_matches_pandas(skewed, size):
    rows = skewed.filter("k = 'hot'")
    got = ema(rows, S, "v", (5,), rows_per_chunk=size).toPandas().sort_values(["ts", "id"], na_position="first")
    expected = got["v"].ewm(span=5, adjust=False).mean()
    assert (got["ema_5"] - expected).abs().max() < 1e-9


def test_ema_folds_many_chunks_a_few_at_a_time(skewed, monkeypatch):
    """Over chunks of chunks of chunks, some without a value; no row holds the chunks of a whole series."""
    widest, kept = [], features_module.stage

    def stage(df):
        out = kept(df)
        if "_along" in out.columns:
            widest.append(out.agg(F.max(F.size("_along"))).first()[0])
        return out

    monkeypatch.setattr(features_module, "CHUNKS_PER_FOLD", 7, raising=False)
    monkeypatch.setattr(features_module, "stage", stage)
    rows = skewed.filter("k = 'hot'").withColumn("v", F.expr("CASE WHEN id % 37 = 5 OR id > 1400 THEN v END"))
    got = ema(rows, S, "v", (5,), rows_per_chunk=4).toPandas().sort_values(["ts", "id"], na_position="first")
    expected = got["v"].ewm(span=5, adjust=False).mean()
    assert (got["ema_5"] - expected).abs().max() < 1e-9 and (got["ema_5"].isna() == expected.isna()).all()
    assert len(widest) == 4 and max(widest) == 7


@pytest.mark.parametrize("accuracy", [40, 10_000])
def test_sketched_quantiles_are_exact(skewed, monkeypatch, accuracy):
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", accuracy)
    wanted = {"v": [0.25, 0.5, 0.9], "id": [0.5]}
    exact = stats.quantiles(skewed, ["k"], wanted).toPandas().sort_values("k").reset_index(drop=True)
    for limit in (10**6, 0):  # counted by value, bracketed by a sketch
        other = stats.quantiles(skewed, ["k"], wanted, buffered_rows=1, counted_values=limit)
        other = other.toPandas().sort_values("k").reset_index(drop=True)
        pd.testing.assert_frame_equal(exact, other)


def test_quantiles_interpolate(frame):
    df = frame("v double", (1.0,), (2.0,), (3.0,), (10.0,))
    for rows, values in ((100, 0), (1, 100), (1, 0)):
        row = stats.quantiles(df, [], {"v": [0.25, 0.5, 0.75]}, rows, values).first()
        assert (row["v_p25"], row["v_p50"], row["v_p75"]) == (1.75, 2.5, 4.75)


def test_mode_ties_go_to_the_smallest(frame):
    df = frame("k string, a string, n int", ("x", "b", 10), ("x", "a", 9), ("x", "a", 10), ("x", "b", 9), ("y", None, None))
    rows = {r["k"]: (r["a_mode"], r["n_mode"]) for r in stats.modes(df, ["k"], ["a", "n"]).collect()}
    assert rows == {"x": ("a", 9), "y": (None, None)}


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    rows = spark.range(0, 4000, 1, 4).select((F.col("id") % 2).alias("k"), (F.col("id") * F.col("id") % 977).cast("double").alias("v"))
    exact = {r["k"]: r["v_p30"] for r in rows.groupBy("k").agg(F.percentile("v", F.lit(0.3)).alias("v_p30")).collect()}
    # A sketch this coarse puts its edges far from the ranks.
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", 3)
    found = stats._bracketed(rows, ["k"], [("v", 0.3, "v_p30")], margin=1e-6)
    assert {r["k"]: r["v_p30"] for r in found.collect()} == exact
