"""What a user runs: landed payloads to clean, standardised, validated and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import catalogue, clean, features, sentiment, standardize, validate, weather
from tidemark.operators.series import Series
from tidemark.session import stage
from tidemark.sinks import tables
from tidemark.sources import payloads, tables as sources


@dataclass(frozen=True)
class Job:
    """One kind of run: where rows come from, what they are, and the table they go to."""

    name: str
    kind: str
    reader: str
    table: str
    schema: Mapping[str, str]
    options: Mapping[str, object] = field(default_factory=dict)
    # The bin that the table's key holds one row of. None: rows keep their own times, which are part of the key.
    granularity: str | None = None


_QUOTE = {
    "symbol": "str", "timestamp": "datetime", "open": "float", "high": "float", "low": "float", "close": "float",
    "volume": "int",
}

JOBS = {
    "stock": Job("stock", "stock", "bars", "stock_prices", {**_QUOTE}, {"asset_type": "stock"}, "1d"),
    "crypto": Job("crypto", "crypto", "klines", "crypto_prices", {**_QUOTE, "volume": "float", "exchange": "str"}),
    "forex": Job("forex", "forex", "aggregates", "forex_rates", {**_QUOTE}, {"forex": True}, "1d"),
    "fred": Job("fred", "economic", "observations", "economic_indicators", schemas.CLEAN_SCHEMAS["economic"]),
    "finnhub": Job("finnhub", "stock", "candles", "stock_prices", {**_QUOTE}, {}, "1d"),
    "weather": Job("weather", "weather", "current_weather", "weather_data", schemas.CLEAN_SCHEMAS["weather"]),
}


@dataclass
class Outcome:
    """Everything a run produced; only counters have been computed on the driver.

    ``delivered`` counts the rows of the payloads; when they are loaded it is total + merged + failed of ``counts``.
    """

    rows: DataFrame
    checks: DataFrame
    summary: DataFrame
    rejected: DataFrame
    counts: dict[str, int] = field(default_factory=dict)
    delivered: int | None = None


def read_job(job: Job, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the payloads named by item, rejected payloads)."""
    good, bad = payloads.split_errors(raw)
    rows = payloads.read(job.reader, good, **job.options)
    name = schemas.SERIES_KEYS[job.kind][0]
    if "item" in rows.columns and name != "item":
        rows = rows.drop(name) if name in rows.columns else rows
        rows = rows.withColumnRenamed("item", name)
    return rows, bad


def transform(
    job: Job, rows: DataFrame, with_features: bool = False, dropped: list[DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Clean, standardise, validate. Returns (rows to load, check results).

    ``rows`` is scanned several times, so it should be staged. Rows without a time stay rows of their own. Those
    that validation leaves out are added to ``dropped``, with their ``failed_checks``.
    """
    name = schemas.SERIES_KEYS[job.kind][0]
    time = "timestamp" if "timestamp" in rows.columns else "date"
    ties = (clean.SEQ,) if clean.SEQ in rows.columns else ()
    # Statistics and rows are both taken from each step, so steps are staged between.
    cleaned = clean.clean(rows, job.schema, Series((name,), time, ties), untimed=True)
    standard = standardize.standardize(stage(cleaned), job.kind, job.granularity, every=job.granularity is not None, untimed=True)
    standard = standard.drop(clean.SEQ)
    if with_features:
        # Resampling keeps only what can be folded into a bar, so features are taken from the rows that are loaded.
        value = "close" if "close" in standard.columns else "value"
        standard = stage(standard)
        timed, untimed = standard.filter(F.col("timestamp").isNotNull()), standard.filter(F.col("timestamp").isNull())
        timed = features.time_features(timed, Series((name,), "timestamp"), value)
        standard = timed.unionByName(untimed, allowMissingColumns=True)
    if "temperature" in standard.columns and "weather_main" in standard.columns:
        standard = standard.withColumn("weather_condition", F.col("weather_main"))
    standard, s = stage(standard), Series((name,), "timestamp")
    valid, checks = validate.validate(standard, job.kind, s)
    if dropped is not None:
        dropped.append(validate.invalid_rows(standard, checks, job.kind, s))
    return valid, checks


def run(
    spark: SparkSession,
    job: Job,
    raw: DataFrame,
    target: str | None = None,
    source: str | None = None,
    runs: str | None = None,
    run_id: str | None = None,
    with_features: bool = False,
) -> Outcome:
    """Payloads to rows and, when ``target`` is given, into the table.

    All items are one job, and a bad payload or row is set aside, so no item can stop the others. The record of the run is
    opened before anything is read, so a run that fails at any step is closed as failed.
    """
    recorded = target is not None and runs is not None and run_id is not None
    if recorded:
        tables.start_run(spark, runs, job.name, run_id)
    try:
        rows, rejected = read_job(job, raw)
        rows, dropped = stage(rows), []
        valid, checks = transform(job, rows, with_features, dropped)
        summary = validate.summary(checks, schemas.SERIES_KEYS[job.kind])
        outcome = Outcome(valid, checks, summary, rejected, delivered=rows.count())
        if target is not None:
            outcome.counts = load(spark, job, valid, target, source, run_id, dropped, outcome.delivered)
    except Exception as error:
        if recorded:
            tables.complete_run(spark, runs, run_id, 0, 0, error=str(error))
        raise
    if recorded:
        tables.complete_run(
            spark, runs, run_id, outcome.counts["total"] + outcome.counts["failed"], outcome.counts["failed"]
        )
    return outcome


def load(
    spark: SparkSession, job: Job, valid: DataFrame, target: str, source: str | None, run_id: str | None,
    dropped: Sequence[DataFrame] = (), delivered: int | None = None,
) -> dict[str, int]:
    """Rows into the job's table, rows it cannot hold and those dropped before into the quarantine: {total, inserted,
    updated, failed, merged}.

    ``merged`` counts the delivered rows that were repeats, were folded into a bar or gave way to a later row of the
    same key, so every row is accounted for.
    """
    entity = schemas.entity(job.table)
    if job.kind == "forex":
        valid = valid.withColumns(
            {"from_currency": F.substring("symbol", 1, 3), "to_currency": F.substring("symbol", 4, 3)}
        )
    good, bad = tables.model_rows(valid, entity, source or job.name)
    good, invalid = validate.quarantine(good, job.table)
    # The granularity of a job fits its key, so rows of one key tie in time and differ in content at most.
    partitioned, parts = tables.by_period(good, entity.time)
    # Both the table and the quarantine count need the rows, so they are computed once.
    staged = stage(partitioned)
    columns = [c for c in staged.columns if c not in tables.STAMPS]
    counts = tables.merge_upsert(
        spark, f"{target}/{job.table}", staged, list(entity.keys), parts, [entity.time, F.xxhash64(*columns)], entity.null_keys
    )
    record = lambda df: F.to_json(F.struct(*df.columns)).alias("record")
    failed = bad.select(record(bad), F.col("rejected").alias("failed_checks")).unionByName(
        invalid.select(record(invalid), "failed_checks")
    )
    for rows in dropped:
        failed = failed.unionByName(rows.select(record(rows.drop("failed_checks")), "failed_checks"))
    failed = stage(failed)
    counts["failed"] = failed.count()
    counts["merged"] = staged.count() - counts["total"]
    if delivered is not None:
        # Before this, cleaning and resampling only make several rows one.
        counts["merged"] += delivered - staged.count() - counts["failed"]
    if counts["failed"]:
        tables.append(failed.withColumns({"table_name": F.lit(job.table), "run_id": F.lit(run_id)}), f"{target}/quarantine")
    return counts


NEWS = Job("news", "sentiment", "news", "sentiment_data", {})


def news_sentiment(
    spark: SparkSession, raw: DataFrame, target: str, source: str | None = None, lexicon: sentiment.Lexicon = schemas.LEXICON,
    runs: str | None = None, run_id: str | None = None,
) -> dict[str, int]:
    """News payloads to scored rows in ``sentiment_data``. Returns {total, inserted, updated, failed, merged}.

    The entity is what an item is related to, else its category. The score is the polarity of headline and summary, the
    confidence one minus their subjectivity; both are rounded at the ninth digit before the table's four, so the order of
    a sum does not decide. Items without a time are quarantined; empty or null texts score 0 with confidence 1.
    """
    recorded = runs is not None and run_id is not None
    if recorded:
        tables.start_run(spark, runs, NEWS.name, run_id)
    try:
        good, _ = payloads.split_errors(raw)
        items = payloads.news(good, **NEWS.options)
        items = items.withColumn("raw_text", F.nullif(F.concat_ws(" ", F.nullif("headline", F.lit("")), F.nullif("summary", F.lit(""))), F.lit("")))
        scored = sentiment.score(items, "raw_text", lexicon)
        related = F.nullif(F.trim("related"), F.lit(""))
        rows = stage(
            scored.select(
                F.coalesce(related, "category").alias("entity"), F.col("datetime").alias("timestamp"),
                F.round("sentiment_polarity", 9).alias("sentiment_score"), F.round(1 - F.col("sentiment_subjectivity"), 9).alias("confidence"),
                "raw_text", "url",
            )
        )
        counts = load(spark, NEWS, rows, target, source, run_id, delivered=rows.count())
    except Exception as error:
        if recorded:
            tables.complete_run(spark, runs, run_id, 0, 0, error=str(error))
        raise
    if recorded:
        tables.complete_run(spark, runs, run_id, counts["total"] + counts["failed"], counts["failed"])
    return counts


def sentiment_days(stored: DataFrame) -> DataFrame:
    """Mean, deviation and count of the stored scores for each entity and day."""
    rows = stored.select(
        "entity", F.to_date("timestamp").alias("date"), F.col("sentiment_score").cast("double").alias("sentiment_polarity"),
        (1 - F.col("confidence").cast("double")).alias("sentiment_subjectivity"),
    )
    return sentiment.by_date(rows, ["entity", "date"])


def weather_days(spark: SparkSession, raw: DataFrame, target: str) -> dict[str, int]:
    """Weather payloads to days with features in ``weather_daily``, one row per place and day.

    Temperatures are filled from their neighbours, precipitation with 0 and other gaps with the median of the place; then
    outliers are capped. A later delivery of a day replaces the stored day, so a delivery holds whole days. Rows without
    a time, or without a value in one of ``weather.GROUP``, belong to no day.
    """
    rows, _ = read_job(JOBS["weather"], raw)
    ties = [clean.SEQ] if clean.SEQ in rows.columns else []
    timed = stage(clean.drop_repeats(rows.filter(F.col("timestamp").isNotNull()), ["timestamp", *ties]))
    cleaned = stage(clean.clean_weather(timed, Series(("location",), "timestamp", tuple(ties))))
    days, parts = tables.by_period(weather.features(weather.daily(cleaned)), "date")
    return tables.merge_upsert(spark, f"{target}/weather_daily", days, ["location", "latitude", "longitude", "date"], parts)


def run_all(spark: SparkSession, raw: Mapping[str, DataFrame], target: str, runs: str, run_id: str) -> DataFrame:
    """Every source that delivered payloads, and the success table: (job, status, counts)."""
    lines = []
    for name, frame in raw.items():  # a handful of sources; the items inside are one distributed job
        try:
            counts = run(spark, JOBS[name], frame, target, runs=runs, run_id=f"{run_id}_{name}").counts
            status = tables.run_status(counts["total"] + counts["failed"], counts["failed"])
            lines.append((name, status, counts["total"], counts["failed"], None))
        except Exception as error:  # one source must not stop the others
            lines.append((name, "failed", 0, 0, str(error)))
    return spark.createDataFrame(lines, "job string, status string, loaded bigint, failed bigint, error string")


def asset_metrics(bars: DataFrame, asset: str, items: Sequence[str] | None = None, s: Series | None = None) -> DataFrame:
    """Market metrics of one asset class, optionally of the listed (or default) items only."""
    if items is not None:
        bars = sources.only_items(bars, "symbol", items or schemas.DEFAULT_ITEMS[asset])
    return features.asset_metrics(bars, s or Series(("symbol",), "timestamp"), asset)


def market_summary(raw_quotes: DataFrame) -> DataFrame:
    """Index quotes with region, type and the mood of the market."""
    return catalogue.market_summary(payloads.quotes(raw_quotes, "index"))


def record_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source, as one job."""
    tagged = [df.select(F.lit(name).alias("source")) for name, df in frames.items()]
    stacked = tagged[0]
    for frame in tagged[1:]:
        stacked = stacked.unionByName(frame)
    return stacked.groupBy("source").agg(F.count(F.lit(1)).alias("records"))


def load_check(counts: DataFrame, threshold: float = schemas.LOAD_FAILURE_THRESHOLD) -> DataFrame:
    return catalogue.load_failure(counts, "loaded", "failed", threshold)


def backfill_plan(places: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day to request for every place: one row per place and day of the range."""
    return places.withColumn("date", F.explode(F.sequence(first, last)))


def medallion(spark: SparkSession, job: Job, raw: DataFrame, root: str) -> Outcome:
    """Raw payloads, clean rows and daily statistics as three table layers."""
    tables.append(raw, f"{root}/bronze/{job.name}")
    outcome = run(spark, job, raw, f"{root}/silver")
    if job.kind in ("stock", "crypto", "forex"):
        silver = spark.read.parquet(f"{root}/silver/{job.table}")
        time = schemas.entity(job.table).time
        keys = ["from_currency", "to_currency"] if job.kind == "forex" else ["symbol"]
        gold = catalogue.daily_stats(silver, keys, time)
        tables.store(gold, f"{root}/gold/daily_stats_{job.name}", mode="overwrite")
    return outcome
