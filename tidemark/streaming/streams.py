"""Continuous versions: incremental ingest, de-duplication, bars, upsert and quarantine."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.bars import _STEPS
from tidemark.operators.validate import quarantine
from tidemark.session import stage
from tidemark.sinks.tables import append, exists, insert_ignore, matched, merge_upsert, store, touched
from tidemark.sources.payloads import READERS


def ingest(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder since the last run; the checkpoint is the high-water mark."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_payloads(raw: DataFrame, source: str, **options) -> DataFrame:
    return READERS[source](raw, **options)


def _event_time(stream: DataFrame, time: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def without_repeats(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop re-delivered records; state is kept no longer than the watermark."""
    return _event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def bars(
    stream: DataFrame, keys: Sequence[str], time: str, price: str, volume: str, granularity: str, delay: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Open/high/low/close/volume per window (up to a day), emitted once the watermark has passed its end.

    ``ties`` order ticks of the same time; without them one of these is taken.
    """
    w = F.window(time, _STEPS[granularity])
    return (
        _event_time(stream, time)
        .withWatermark(time, delay)
        .groupBy(*keys, w.alias("_w"))
        .agg(*_bar_aggregates(time, price, volume, ties))
        .select(*keys, F.col("_w.start").alias("bar"), "open", "high", "low", "close", "volume")
    )


def _bar_aggregates(time: str, price: str, volume: str, ties: Sequence[str] = ()) -> list:
    order = F.struct(time, *ties)
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum(volume).alias("volume"),
    ]


def partial_bars(
    rows: DataFrame, keys: Sequence[str], time: str, price: str, volume: str, granularity: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Bars of one batch with the places of their first and last tick, so that they can be combined."""
    w = F.window(time, _STEPS[granularity])
    order = F.struct(F.col(time).alias("at"), *ties)
    return (
        rows.groupBy(*keys, w.alias("_w"))
        .agg(*_bar_aggregates(time, price, volume, ties), F.min(order).alias("open_at"), F.max(order).alias("close_at"))
        .select(
            *keys, F.col("_w.start").alias("bar"), "open", "high", "low", "close", "volume", "open_at", "close_at",
            F.to_date("_w.start").alias("day"),
        )
    )


def combine_bars(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, keys: Sequence[str], stream: str = "") -> None:
    """Fold the bars of a batch into the table. A bar remembers, for each stream that has fed it, the last batch
    it took in, so a batch that is delivered again changes nothing; late ticks are just another batch.

    ``stream`` names the run of batch ids: a stream with a new checkpoint counts from 0 again and is another stream.
    """
    mark = F.create_map(F.lit(stream), F.lit(batch_id).cast("bigint"))
    stamped = stage(batch.withColumn("batches", mark))
    if not exists(spark, path):
        store(stamped, path, ["day"])
        return
    target = spark.read.parquet(path)
    both = matched(touched(target, stamped, ["day"]), stamped, [*keys, "bar", "day"], {})
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}"))
    seen = F.try_element_at(old("batches"), F.lit(stream))
    applied = F.col("new").isNull() | F.coalesce(seen >= batch_id, F.lit(False))
    others = F.map_filter(F.coalesce(old("batches"), F.create_map().cast("map<string,bigint>")), lambda k, _: k != stream)
    fold = {
        "open": F.when(new("open_at") < old("open_at"), new("open")).otherwise(F.coalesce(old("open"), new("open"))),
        "close": F.when(old("close_at") > new("close_at"), old("close")).otherwise(new("close")),
        "high": F.greatest(old("high"), new("high")),
        "low": F.least(old("low"), new("low")),
        "volume": F.coalesce(old("volume") + new("volume"), old("volume"), new("volume")),
        "open_at": F.least(old("open_at"), new("open_at")),
        "close_at": F.greatest(old("close_at"), new("close_at")),
        "batches": F.map_concat(others, new("batches")),
    }
    columns = [
        F.when(applied, old(c)).otherwise(fold.get(c, new(c))).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ]
    store(both.select(*columns), path, ["day"], "overwrite")


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into the checkpoint: the same after a restart, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def keep_bars(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str, price: str, volume: str,
    granularity: str, once: bool = True, ties: Sequence[str] = (), late: str | None = None, delay: str = "1 hour",
) -> StreamingQuery:
    """Continuously folded bars, whatever the order the ticks arrive in.

    Without ``late`` every batch folds all of its ticks, so a tick of last year rewrites a day of last year. With
    ``late`` the ticks that come more than ``delay`` behind are kept there, and ``fold_late`` takes them in later:
    a batch then rewrites recent days only, and an old day is rewritten once for all its late ticks.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name, rows = stream_id(spark, checkpoint), batch
        if late is not None:
            batch.persist()
            rows = set_late_aside(batch, batch_id, late, name, time, delay)
        combine_bars(spark, path, partial_bars(rows, keys, time, price, volume, granularity, ties), batch_id, keys, name)
        batch.unpersist()

    return _start(stream, handle, checkpoint, once)


def set_late_aside(batch: DataFrame, batch_id: int, late: str, stream: str, time: str, delay: str) -> DataFrame:
    """The rows of a batch that are in time; the others go to the side table below ``late``.

    A row is late when its time lies more than ``delay`` before the greatest time of all earlier batches of the stream;
    a row without a time is never late. The greatest time so far is stored for the last two batches, so a batch that
    is delivered again is divided as before and replaces its own rows.
    """
    spark, seen = batch.sparkSession, f"{late}/seen"
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    highest = None
    if exists(spark, seen):
        before = spark.read.parquet(seen).filter((F.col("late_stream") == stream) & (F.col("batch") < batch_id))
        highest = before.agg(F.max("highest")).first()[0]
    top = batch.agg(F.greatest(F.max(micros), F.lit(highest).cast("bigint")).alias("highest"))
    mark = {"batch": F.lit(batch_id).cast("bigint"), "late_stream": F.lit(stream), "slot": F.lit(batch_id % 2)}
    behind = F.lit(False)
    if highest is not None:
        behind = F.coalesce(F.timestamp_micros(micros) < F.timestamp_micros(F.lit(highest)) - F.expr(f"INTERVAL {delay}"), F.lit(False))
    aside = batch.filter(behind)
    if not aside.isEmpty():
        aside = aside.withColumns({"late_stream": F.lit(stream), "late_batch": F.lit(batch_id)})
        store(aside, f"{late}/rows", ["late_stream", "late_batch"], "overwrite")
    store(top.withColumns(mark), seen, ["late_stream", "slot"], "overwrite")
    return batch.filter(~behind)


def late_rows(spark: SparkSession, late: str) -> DataFrame | None:
    """Everything that was set aside, with ``late_stream`` and ``late_batch``; None when nothing was."""
    return spark.read.parquet(f"{late}/rows") if exists(spark, f"{late}/rows") else None


def fold_late(
    spark: SparkSession, path: str, late: str, keys: Sequence[str], time: str, price: str, volume: str, granularity: str,
    ties: Sequence[str] = (),
) -> int:
    """Fold the rows set aside since the last fold into the bars, each touched day once. Returns the number of streams
    that had any.

    Which batches a fold takes is written down before it begins. An interrupted fold is repeated with just these, and
    bars that have taken them in leave them out. Not to be run while a stream writes to the same table.
    """
    rows, log, folded = late_rows(spark, late), f"{late}/folds", 0
    if rows is None:
        return folded
    newest = {r[0]: r[1] for r in rows.groupBy("late_stream").agg(F.max("late_batch")).collect()}  # one row per stream
    known = {}
    if exists(spark, log):
        ends = spark.read.parquet(log).groupBy("stream").agg(F.max("upto"), F.max(F.when(F.col("done"), F.col("upto"))))
        known = {r[0]: (r[1], r[2]) for r in ends.collect()}
    for stream, last in newest.items():
        planned, done = known.get(stream, (None, None))
        done = -1 if done is None else done
        upto = planned if planned is not None and planned > done else last
        if upto <= done:
            continue
        note = lambda finished: spark.range(1).select(
            F.lit(stream).alias("stream"), F.lit(upto).cast("bigint").alias("upto"), F.lit(finished).alias("done")
        )
        if upto != planned:
            append(note(False), log)
        chosen = rows.filter((F.col("late_stream") == stream) & (F.col("late_batch") > done) & (F.col("late_batch") <= upto))
        combine_bars(spark, path, partial_bars(chosen, keys, time, price, volume, granularity, ties), upto, keys, f"late {stream}")
        append(note(True), log)
        folded += 1
    return folded


def keep_new(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str, order: Sequence[str] = (), once: bool = True
) -> StreamingQuery:
    """Continuously store the records whose key the table does not hold, in whichever file or batch their copies come,
    however late.

    The table is the state: it is partitioned by the ``day`` of the time, and a batch is compared with the keys of its own
    days only. So copies of a record must bear the same day; of those in one batch the first in ``order`` stays. Records
    without a time share a day of their own. A repeated batch adds nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        dated = batch.withColumn("day", F.coalesce(F.to_date(time), F.lit("0001-01-01").cast("date")))
        insert_ignore(batch.sparkSession, path, dated, [*keys, "day"], ["day"], order)
        batch.unpersist()

    return _start(stream, handle, checkpoint, once)


def upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], parts: Sequence[str] = (),
    order: Sequence[str] = (), null_keys: Mapping[str, str] = {}, once: bool = True,
) -> StreamingQuery:
    """Continuous upsert. The row that is last in ``order`` stays, in whichever batch it comes; repeating a batch
    writes the same rows again."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_upsert(batch.sparkSession, path, batch, keys, parts, order, null_keys, newest_by=order)

    return _start(stream, handle, checkpoint, once)


def guarded(
    stream: DataFrame, table: str, valid_path: str, invalid_path: str, checkpoint: str,
    checks: Mapping[str, str] | None = None, once: bool = True,
) -> StreamingQuery:
    """Valid rows to one table, rows that break a rule to the quarantine table, per batch folder so
    that a repeated batch replaces its own files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("batch", F.lit(batch_id).cast("int"))
        valid, invalid = quarantine(stamped, table, checks)
        store(valid, valid_path, ["batch"], "overwrite")
        store(invalid, invalid_path, ["batch"], "overwrite")

    return _start(stream, handle, checkpoint, once)


def to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append-only file sink (exactly once by its own log)."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
