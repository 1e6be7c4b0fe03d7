"""Hourly weather to daily weather, and the features computed from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import comfort_index, heat_index, is_weekend, season, wind_chill
from tidemark.operators.series import join_on
from tidemark.operators.stats import modes

GROUP = ("location", "latitude", "longitude", "units", "source")
TEMPERATURES = (
    "temperature", "feels_like", "temp_min", "temp_max", "dew_point", "temp_day", "temp_night",
    "temp_eve", "temp_morn",
)
MEANS = ("pressure", "humidity", "cloudiness", "visibility", "uvi")
WINDS = ("wind_speed", "wind_gust")
TOTALS = ("rain_1h", "rain_3h", "snow_1h", "snow_3h", "pop")
LABELS = ("weather_main", "weather_description", "weather_icon")


def daily(hourly: DataFrame, ts: str = "timestamp", group: Sequence[str] = GROUP) -> DataFrame:
    """One row per day and place: ``<col>_daily_min|max|avg|total`` and ``<col>_mode``.

    Rows with a null in a grouping column are left out.
    """
    keys = ["date", *[c for c in group if c in hourly.columns]]
    rows = hourly.withColumn("date", F.to_date(ts)).dropna(subset=keys)
    has = lambda names: [c for c in names if c in hourly.columns]
    aggregates = []
    for c in has(TEMPERATURES):
        aggregates += [F.min(c).alias(f"{c}_daily_min"), F.max(c).alias(f"{c}_daily_max"), F.avg(c).alias(f"{c}_daily_avg")]
    aggregates += [F.avg(c).alias(f"{c}_daily_avg") for c in has(MEANS)]
    for c in has(WINDS):
        aggregates += [F.max(c).alias(f"{c}_daily_max"), F.avg(c).alias(f"{c}_daily_avg")]
    aggregates += [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}_daily_total") for c in has(TOTALS)]
    out = rows.groupBy(*keys).agg(*aggregates) if aggregates else rows.select(*keys).distinct()
    labels = has(LABELS)
    return join_on(out, modes(rows, keys, labels), keys) if labels else out


def features(df: DataFrame) -> DataFrame:
    """Range, heat index, wind chill, comfort, severity, season and weekend, from the columns present."""
    has = set(df.columns)
    if {"temperature_daily_max", "temperature_daily_min"} <= has:
        df = df.withColumn(
            "temperature_daily_range", F.col("temperature_daily_max") - F.col("temperature_daily_min")
        )
    elif {"temp_max", "temp_min"} <= has:
        df = df.withColumn("temperature_range", F.col("temp_max") - F.col("temp_min"))
    has = set(df.columns)
    added = {}
    if {"temperature_daily_avg", "humidity_daily_avg"} <= has:
        added["heat_index"] = heat_index("temperature_daily_avg", "humidity_daily_avg")
        added["comfort_index"] = comfort_index("temperature_daily_avg", "humidity_daily_avg")
    if {"temperature_daily_avg", "wind_speed_daily_avg"} <= has:
        added["wind_chill"] = wind_chill("temperature_daily_avg", "wind_speed_daily_avg")
    scales = {"wind_speed_daily_max": 20, "precipitation_daily_total": 50, "temperature_daily_range": 15}
    factors = [F.col(c) / scale for c, scale in scales.items() if c in has]
    if factors:
        added["weather_severity_score"] = sum(factors[1:], factors[0]) / len(factors)
    if "date" in has:
        added["season"] = season("date")
        added["is_weekend"] = is_weekend("date")
    return df.withColumns(added) if added else df
