"""Writing: upsert, insert-or-ignore, revisions, quarantine, retention, model rows and run records.

Tables are partitioned Parquet. A merge rewrites only the partitions it touches, with dynamic
partition overwrite: files are staged and moved in when the job commits, so a lost executor repeats
tasks and changes nothing. Partition columns must be functions of the merge keys, so a row never
moves between partitions. Plain Parquet has no transactions; one writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import keep_one
from tidemark.schemas import Entity
from tidemark.session import pin, small, stage

STAMPS = ("created_at", "updated_at")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds any data."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(target)) and bool(fs.listStatus(target))


def by_period(df: DataFrame, time: str, unit: str = "month") -> tuple[DataFrame, list[str]]:
    """Add the partition columns of a time column: year, or year and month, or the date."""
    if unit == "year":
        return df.withColumn("year", F.year(time)), ["year"]
    if unit == "month":
        return df.withColumns({"year": F.year(time), "month": F.month(time)}), ["year", "month"]
    if unit == "day":
        return df.withColumn("day", F.to_date(time)), ["day"]
    raise ValueError(f"unknown partition unit: {unit}")


def store(df: DataFrame, path: str, parts: Sequence[str] = (), mode: str = "append", sort: Sequence[str] = ()) -> None:
    """Write with files sized by the adaptive rebalance: hot partitions are split, small ones joined."""
    out = df.hint("rebalance", *parts) if parts else df
    if sort:
        out = out.sortWithinPartitions(*parts, *sort)
    writer = out.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _canonical(c: str, null_keys: Mapping[str, str]) -> Column:
    """A null key stands for its declared default; other nulls match nulls."""
    return F.coalesce(F.col(c), F.lit(null_keys[c])) if c in null_keys else F.col(c)


def touched(target: DataFrame, incoming: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the partitions that receive rows. The partition list is pinned, and broadcast when its
    counted size allows, which lets Spark prune the target's folders."""
    if not parts:
        return target
    wanted = small(pin(incoming.select(*parts).distinct()))
    return target.join(wanted, list(parts), "left_semi")


def matched(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], null_keys: Mapping[str, str], how: str = "full"
) -> DataFrame:
    """Target and incoming rows of the same key side by side, as structs ``old`` and ``new``."""
    old = target.select(F.struct(*target.columns).alias("old"), *[_canonical(k, null_keys).alias(f"_o_{k}") for k in keys])
    new = incoming.select(F.struct(*incoming.columns).alias("new"), *[_canonical(k, null_keys).alias(f"_n_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
    return old.join(new, condition, how).select("old", "new")


def merged_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    null_keys: Mapping[str, str] = {},
    revisions: str | None = None,
    now: Column | None = None,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """Result of the upsert: the new row where there is one, ``created_at`` kept from the old row.

    With ``newest_by`` an old row whose values in these columns are greater stays as it is.

    ``revisions`` names the value column of a revision-aware table: on a conflict the row is marked
    ``is_revised`` and its ``revision_number`` grows by one. Adds ``_state``: inserted, updated or kept.
    """
    now = F.current_timestamp() if now is None else now
    both = matched(target, incoming, keys, null_keys)
    if newest_by:
        place = lambda side: F.struct(*[F.col(f"{side}.{c}").cast(target.schema[c].dataType) for c in newest_by])
        late = F.col("old").isNotNull() & F.coalesce(place("old") > place("new"), F.lit(False))
        both = both.withColumn("new", F.when(~late, F.col("new")))
    has_new, has_old = F.col("new").isNotNull(), F.col("old").isNotNull()
    new_columns = set(incoming.columns)
    columns = []
    for c in target.columns:
        old = F.col(f"old.{c}")
        new = F.col(f"new.{c}") if c in new_columns else F.lit(None)
        value = F.when(has_new, new).otherwise(old)
        if c == "created_at":
            value = F.coalesce(old, new, now)
        elif c == "updated_at":
            value = F.when(has_new, now).otherwise(old)
        elif revisions and c == "is_revised":
            value = F.when(has_new & has_old, True).when(has_new, F.coalesce(new, F.lit(False))).otherwise(old)
        elif revisions and c == "revision_number":
            start = F.coalesce(new, F.lit(0))
            value = F.when(has_new & has_old, F.coalesce(old, F.lit(0)) + 1).when(has_new, start).otherwise(old)
        elif c not in new_columns:
            value = old
        columns.append(value.cast(target.schema[c].dataType).alias(c))
    state = F.when(has_new & has_old, "updated").when(has_new, "inserted").otherwise("kept")
    return both.select(*columns, state.alias("_state"))


def merge_upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str] = (),
    order: Sequence[str] = (),
    null_keys: Mapping[str, str] = {},
    revisions: str | None = None,
    newest_by: Sequence[str] = (),
) -> dict[str, int]:
    """Upsert into the table and return {total, inserted, updated}.

    Of several incoming rows with one key the last in ``order`` wins. ``newest_by`` names columns of the table
    that order the rows of a key across deliveries: a row that is older than the stored one changes nothing.
    Without ``parts`` the whole table is the one partition that is rewritten, through a staged copy.
    """
    # The partitions and the rows both come from the delivery.
    delivered = incoming = stage(incoming)
    incoming = keep_one(incoming, [_canonical(k, null_keys) for k in keys], order or [F.xxhash64(*incoming.columns)], "last")
    if not exists(spark, path):
        counted = Observation()
        fresh = incoming
        for c in STAMPS:
            if c in incoming.columns:
                fresh = fresh.withColumn(c, F.coalesce(F.col(c), F.current_timestamp()))
        store(fresh.observe(counted, F.count(F.lit(1)).alias("n")), path, parts)
        return {"total": counted.get["n"], "inserted": counted.get["n"], "updated": 0}
    target = spark.read.parquet(path)
    for p in parts:  # partition values read back from folder names may come with another type
        delivered = delivered.withColumn(p, F.col(p).cast(target.schema[p].dataType))
        incoming = incoming.withColumn(p, F.col(p).cast(target.schema[p].dataType))
    # The partitions are those of the delivered rows, so listing them needs no window.
    rows = merged_rows(touched(target, delivered, parts), incoming, keys, null_keys, revisions, newest_by=newest_by)
    counted = Observation()
    rows = rows.observe(
        counted,
        F.count_if(F.col("_state") == "inserted").alias("inserted"),
        F.count_if(F.col("_state") == "updated").alias("updated"),
    ).drop("_state")
    if parts:
        store(rows, path, parts, mode="overwrite")
    else:
        replace_whole(spark, stage(rows), path)
    done = counted.get
    return {"total": done["inserted"] + done["updated"], **done}


def replace_whole(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Write ``rows`` beside an unpartitioned table, then put the new folder in its place.

    The old folder is moved aside first and deleted last, so at any moment one of the two is complete.
    """
    named = lambda suffix: spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{suffix}")
    mark = uuid.uuid4().hex
    fresh, old, root = named(f"._new-{mark}"), named(f"._old-{mark}"), named("")
    store(rows, fresh.toString())
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not (fs.rename(root, old) and fs.rename(fresh, root)):
        raise RuntimeError(f"could not replace {path}; the rows are in {fresh.toString()}")
    fs.delete(old, True)


def insert_ignore(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str] = (),
    order: Sequence[str] = (),
    null_keys: Mapping[str, str] = {},
) -> None:
    """Append only the keys the table does not hold; of several incoming rows the first wins."""
    incoming = keep_one(incoming, [_canonical(k, null_keys) for k in keys], order or [F.xxhash64(*incoming.columns)])
    if exists(spark, path):
        target = spark.read.parquet(path)
        incoming = new_rows(touched(target, incoming, parts), incoming, keys, null_keys)
    store(incoming, path, parts)


def new_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str], null_keys: Mapping[str, str] = {}) -> DataFrame:
    """Incoming rows whose key the target does not hold."""
    held = target.select(*[_canonical(k, null_keys).alias(f"_o_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & _canonical(k, null_keys).eqNullSafe(F.col(f"_o_{k}"))
    return incoming.join(held, condition, "left_anti")


def append(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    store(df, path, parts)


def to_csv(df: DataFrame, path: str, day: str, by: str = "symbol") -> None:
    """CSV with a header, one folder per symbol under a date-stamped folder."""
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).option("header", True).csv(f"{path}/{day}")


# --- model rows ----------------------------------------------------------------------------------


def model_rows(df: DataFrame, entity: Entity, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the entity's columns and types, rows with a value that does not fit its type).

    Columns the model does not have are dropped; absent ones are null; a row without a key is rejected.
    """
    types = dict(df.dtypes)

    def value(field: T.StructField) -> Column:
        if field.name in STAMPS:
            return F.current_timestamp()
        if field.name == "source" and source:
            return F.lit(source)
        if field.name not in types:
            return F.lit(None).cast(field.dataType)
        column = F.col(field.name)
        if types[field.name] in ("double", "float"):
            column = F.when(~F.isnan(column), column)
        return column.try_cast(field.dataType)

    def lost(field: T.StructField) -> Column:
        column = F.col(field.name)
        present = column.isNotNull()
        if types[field.name] in ("double", "float"):
            present = present & ~F.isnan(column)
        return present & value(field).isNull()

    present = [f for f in entity.schema if f.name in types and f.name not in STAMPS]
    bad = F.array_compact(F.array(*[F.when(lost(f), F.lit(f.name)) for f in present]))
    keyless = F.array_compact(
        F.array(
            *[
                F.when(value(entity.schema[k]).isNull(), F.lit(f"{k} missing"))
                for k in entity.keys
                if k not in entity.null_keys
            ]
        )
    )
    tagged = df.withColumn("rejected", F.concat(bad, keyless))
    good = tagged.filter(F.size("rejected") == 0).select(*[value(f).alias(f.name) for f in entity.schema])
    return good, tagged.filter(F.size("rejected") > 0)


def as_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Rows as JSON objects: NaN as null, times as ISO 8601 with zone."""

    def plain(c: str, dtype: str) -> Column:
        column = F.col(c)
        if dtype in ("double", "float"):
            return F.when(~F.isnan(column), column)
        if dtype in ("timestamp", "timestamp_ntz"):
            return F.date_format(column.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")
        return column

    fields = [plain(c, t).alias(c) for c, t in df.dtypes]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


# --- run records ---------------------------------------------------------------------------------


def run_status(total: int, failed: int, error: str | None = None) -> str:
    if error or (total and failed >= total):
        return "failed"
    return "partial_success" if failed else "success"


def start_run(spark: SparkSession, path: str, pipeline_id: str, run_id: str) -> None:
    """Append the record of a run that starts now."""
    row = [(pipeline_id, run_id, "running")]
    runs = spark.createDataFrame(row, "pipeline_id string, run_id string, status string")
    store(
        runs.select(
            "*",
            F.current_timestamp().alias("start_time"),
            F.lit(None).cast("timestamp").alias("ended_at"),
            F.lit(None).cast("double").alias("duration_seconds"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("records_processed", "records_failed", "warning_count")],
            F.lit(None).cast("string").alias("error_message"),
            # Closing a run rewrites the runs of its month only.
            F.date_format(F.current_timestamp(), "yyyyMM").cast("int").alias("month"),
        ),
        path,
        ["month"],
    )


def complete_run(
    spark: SparkSession, path: str, run_id: str, processed: int, failed: int, warnings: int = 0, error: str | None = None
) -> str:
    """Close a run: status, counters and duration in seconds. Returns a message."""
    runs = spark.read.parquet(path)
    mine = stage(runs.filter(F.col("run_id") == run_id))
    if mine.isEmpty():
        return f"run {run_id} not found"
    now = F.current_timestamp()
    closed = mine.withColumns(
        {
            "status": F.lit(run_status(processed, failed, error)),
            "ended_at": now,
            "duration_seconds": now.cast("double") - F.col("start_time").cast("double"),
            "records_processed": F.lit(processed).cast("bigint"),
            "records_failed": F.lit(failed).cast("bigint"),
            "warning_count": F.lit(warnings).cast("bigint"),
            "error_message": F.lit(error).cast("string"),
        }
    )
    merge_upsert(spark, path, closed, ["run_id"], ["month"], ["start_time"])
    return f"run {run_id} completed"


# --- retention -----------------------------------------------------------------------------------


def expired(df: DataFrame, time: str, cutoff: Column) -> DataFrame:
    return df.filter(F.col(time) < cutoff)


# Partition columns that ``by_period`` makes, with the expressions of the first day of a partition and of the next one.
_PERIODS = {
    ("year",): ("make_date(year, 1, 1)", "make_date(year + 1, 1, 1)"),
    ("year", "month"): ("make_date(year, month, 1)", "add_months(make_date(year, month, 1), 1)"),
    ("day",): ("day", "date_add(day, 1)"),
}


def at_cutoff(table: DataFrame, parts: Sequence[str], limit: Column) -> DataFrame:
    """The rows of the partition of a period that holds the cutoff; only its files are read."""
    first, following = _PERIODS[tuple(parts)]
    return table.filter((F.expr(first).cast("timestamp") < limit.cast("timestamp")) & (limit.cast("timestamp") < F.expr(following).cast("timestamp")))


def _old_folders(table: DataFrame, parts: Sequence[str], limit: Column) -> list[str]:
    """Folders of partitions whose whole period lies before the cutoff, by the partition values in their names.

    The names come from the file list that Spark has read on the driver; no data is read.
    """
    spark = table.sparkSession
    folders = sorted({file.rsplit("/", 1)[0] for file in table.inputFiles()})
    if not folders:
        return []
    named = spark.createDataFrame([(f,) for f in folders], "folder string")
    values = {p: F.regexp_extract("folder", f"(?:^|/){p}=([^/]*)", 1).try_cast(table.schema[p].dataType) for p in parts}
    # A partition without a value holds the rows without a time: its bound is null, and it stays.
    old = F.expr(_PERIODS[tuple(parts)][1]).cast("timestamp") <= limit.cast("timestamp")
    return [r["folder"] for r in named.withColumns(values).filter(old).select("folder").collect()]


def _folders(files: DataFrame) -> list[str]:
    """The folders of the files that hold the rows."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
    return [r["folder"] for r in files.select(folder).distinct().collect()]


def _counted_folders(table: DataFrame, parts: Sequence[str], time: str, limit: Column) -> tuple[DataFrame, list[str]]:
    """(rows of partitions that are old in part, folders of those wholly old) where the values say nothing about the time."""
    held = table.groupBy(*parts).agg(F.count_if(F.col(time) < limit).alias("_old"), F.count(F.lit(1)).alias("_all"))
    held = pin(held.filter("_old > 0"))
    inside = lambda chosen: table.join(chosen, reduce(and_, [table[p].eqNullSafe(chosen[p]) for p in parts]), "left_semi")
    # The folders are those that Spark itself lists for the files, whatever their values look like.
    files = inside(small(pin(held.filter("_old = _all").select(*parts))))
    return inside(small(pin(held.filter("_old < _all").select(*parts)))), _folders(files)


def retain(
    spark: SparkSession,
    path: str,
    parts: Sequence[str],
    time: str,
    cutoff: str,
    archive: str | None = None,
    summary: tuple[str, Sequence[str], Mapping[str, Column]] | None = None,
) -> int:
    """Remove what is older than ``cutoff``; first archive it, or write a summary, when asked to.

    A partition that is wholly older is dropped as a folder; one that holds the cutoff is rewritten. Rows without a time
    are kept. Where the partitions are those of ``by_period`` for ``time``, their values decide, and only the one
    at the cutoff is read; for others the rows are counted. Folders are deleted one by one, of which a table by month has few.
    ``summary`` is (path, group columns, aggregates). Returns the number of partitions dropped.
    """
    table = spark.read.parquet(path)
    limit = F.lit(cutoff).cast(table.schema[time].dataType)
    by_bounds = tuple(parts) in _PERIODS
    old = expired(table, time, limit)
    if by_bounds:
        old = old.filter(F.expr(_PERIODS[tuple(parts)][0]).cast("timestamp") < limit.cast("timestamp"))
    if archive:
        store(old, archive, parts)
    if summary:
        where, by, aggregates = summary
        store(old.groupBy(*by).agg(*[e.alias(n) for n, e in aggregates.items()]), where)
    if by_bounds:
        mixed, folders = at_cutoff(table, parts, limit), _old_folders(table, parts, limit)
    else:
        mixed, folders = _counted_folders(table, parts, time, limit)
    kept = stage(mixed)
    if not kept.isEmpty():
        # A row without a time is not old.
        later = kept.filter((F.col(time) >= limit) | F.col(time).isNull())
        store(later, path, parts, "overwrite")
        if by_bounds and later.isEmpty():
            # Nothing is left of the partition, and an empty write replaces nothing.
            folders = sorted({*folders, *_folders(mixed)})
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        if not fs.delete(folder, True):
            raise RuntimeError(f"could not delete {name}")
    return len(folders)
