"""Cleaning: duplicates, coercion, imputation, outliers. All per key, all order explicit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalar import clip, integral, parse_time
from tidemark.operators.series import ROWS_PER_CHUNK, Series, attach, join_on, running
from tidemark.operators.stats import modes, quantiles
from tidemark.session import stage

SEQ = "_seq"
# Columns that do not make a row another one when duplicates are dropped by default.
STAMP_NAMES = ("timestamp", "date", "created_at")
_NUMERIC = ("double", "float", "bigint", "int", "smallint", "tinyint", "decimal")


def is_numeric(dtype: str) -> bool:
    return dtype.startswith(_NUMERIC)


def is_time(dtype: str) -> bool:
    return dtype.startswith("timestamp") or dtype == "date"


def is_time_name(name: str) -> bool:
    return "time" in name.lower() or "date" in name.lower()


# --- duplicates ----------------------------------------------------------------------------------


def keep_one(
    df: DataFrame, subset: Sequence[str], order: Sequence[str | Column], keep: str = "first"
) -> DataFrame:
    """One row per ``subset``: the first or the last in ``order``.

    Spark turns the filtered ``row_number`` into a group limit below the shuffle, so each map task
    passes on one row per group and a huge group of copies costs nothing extra.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [c.asc_nulls_first() if keep == "first" else c.desc_nulls_last() for c in columns]
    w = Window.partitionBy(*subset).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def drop_duplicates(df: DataFrame, order: Sequence[str], subset: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of equal rows. By default the stamps ``STAMP_NAMES`` do not count as part of a row."""
    subset = subset or [c for c in df.columns if c not in STAMP_NAMES and c not in order]
    return keep_one(df, subset or df.columns, order)


def drop_repeats(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Keep the first of the rows that are equal in everything that was delivered, times included.

    Jobs use this: two observations with the same value at different times are two observations.
    """
    return keep_one(df, [c for c in df.columns if c != SEQ], order)


# --- coercion ------------------------------------------------------------------------------------


def coerced(column: str, logical: str, dtype: str) -> Column:
    value = F.col(column)
    if logical == "float":
        return value.try_cast("double")
    if logical == "int":
        return integral(column)
    if logical == "datetime":
        return value if is_time(dtype) else parse_time(column)
    if logical == "str":
        return value.cast("string")
    raise ValueError(f"unknown logical type: {logical}")


def coerce(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast to the schema's types; a value that does not convert becomes null."""
    types = dict(df.dtypes)
    return df.withColumns({c: coerced(c, t, types[c]) for c, t in schema.items() if c in types})


def coercion_losses(df: DataFrame, schema: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Per key and column, how many values do not convert (one scan)."""
    types = dict(df.dtypes)
    present = [c for c in schema if c in types]
    lost = {c: F.count_if(F.col(c).isNotNull() & coerced(c, schema[c], types[c]).isNull()) for c in present}
    wide = df.groupBy(*keys).agg(*[lost[c].alias(c) for c in present])
    return unpivot(wide, keys, present, "column", "lost")


def unpivot(wide: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return wide.select(*keys, F.inline(F.array(*pairs)))


def to_utc(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Read unzoned time columns as local times of ``zone`` and turn them into UTC timestamps."""
    columns = {
        c: F.to_utc_timestamp(F.col(c).cast("timestamp"), zone)
        for c, t in df.dtypes
        if is_time_name(c) and t == "timestamp_ntz"
    }
    return df.withColumns(columns) if columns else df


# --- imputation ----------------------------------------------------------------------------------


def missing_ratios(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Share of nulls per key and column, as ``<col>_missing``, in one scan."""
    return df.groupBy(*keys).agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_missing") for c in columns]
    )


def impute(
    df: DataFrame,
    s: Series,
    columns: Sequence[str] | None = None,
    threshold: float = schemas.MISSING_THRESHOLD,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Fill nulls: text by the mode and numbers by the median where the share of nulls is at most
    ``threshold``; times from the row before, always."""
    types = dict(df.dtypes)
    columns = [c for c in (columns or df.columns) if c not in s.keys and c != SEQ]
    text = [c for c in columns if types[c] == "string"]
    numbers = [c for c in columns if is_numeric(types[c]) and c not in s.order]
    times = [c for c in columns if is_time(types[c]) and c not in s.order]
    out = df
    if text or numbers:
        stats = missing_ratios(df, s.keys, [*text, *numbers])
        if numbers:
            stats = _beside(stats, quantiles(df, s.keys, {c: [0.5] for c in numbers}), s.keys)
        if text:
            stats = _beside(stats, modes(df, s.keys, text), s.keys)
        fills = {c: f"{c}_mode" for c in text} | {c: f"{c}_p50" for c in numbers}
        out = attach(out, stats, s.keys)
        out = out.withColumns(
            {
                c: F.when(F.col(f"{c}_missing") <= threshold, F.coalesce(F.col(c), F.col(fill).cast(types[c])))
                .otherwise(F.col(c))
                for c, fill in fills.items()
            }
        ).drop(*fills.values(), *[f"{c}_missing" for c in fills])
    if times:
        out = running(out, s, {f"_filled_{c}": ("last", c) for c in times}, rows_per_chunk)
        out = out.withColumns({c: F.col(f"_filled_{c}") for c in times}).drop(*[f"_filled_{c}" for c in times])
    return out.select(*df.columns)


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two per-key tables side by side; both hold exactly one row per key."""
    if not keys:
        return left.crossJoin(right)
    return join_on(left, right, keys)


def fill_both_ways(
    df: DataFrame, s: Series, columns: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Fill a null from the value before it or, at the start of a series, from the next one."""
    spec = {}
    for c in columns:
        spec[f"_last_{c}"] = ("last", c)
        spec[f"_next_{c}"] = ("next", c)
    out = running(df, s, spec, rows_per_chunk)
    out = out.withColumns({c: F.coalesce(f"_last_{c}", f"_next_{c}") for c in columns})
    return out.select(*df.columns)


# --- outliers ------------------------------------------------------------------------------------


def cap_outliers(df: DataFrame, keys: Sequence[str], columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Bound values at the quartiles -/+ ``factor`` times their distance, per key.

    A column that holds nulls for a key is left alone for that key.
    """
    quartiles = quantiles(df, keys, {c: [0.25, 0.75] for c in columns})
    stats = _beside(quartiles, missing_ratios(df, keys, columns), keys)
    out = attach(df, stats, keys)
    capped = {}
    for c in columns:
        low, high = F.col(f"{c}_p25"), F.col(f"{c}_p75")
        reach = (high - low) * factor
        capped[c] = F.when(F.col(f"{c}_missing") == 0, clip(c, low - reach, high + reach)).otherwise(F.col(c))
    return out.withColumns(capped).select(*df.columns)


def zscore_flags(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], threshold: float = schemas.Z_THRESHOLD
) -> DataFrame:
    """Add ``<col>_zscore`` and ``<col>_anomaly``; null and false where the key has fewer than three
    values or no spread."""
    stats = df.groupBy(*keys).agg(
        *[
            f(c).alias(f"{c}_{name}")
            for c in columns
            for name, f in (("_mean", F.avg), ("_std", F.stddev_samp), ("_n", F.count))
        ]
    )
    out = attach(df, stats, keys)
    flags = {}
    for c in columns:
        usable = (F.col(f"{c}__n") > 2) & (F.col(f"{c}__std") > 0)
        z = F.when(usable, (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std"))
        flags[f"{c}_zscore"] = z
        flags[f"{c}_anomaly"] = F.coalesce(F.abs(z) > threshold, F.lit(False))
    return out.withColumns(flags).select(*df.columns, *flags)


# --- the whole cleaner ---------------------------------------------------------------------------


def problems(
    df: DataFrame, schema: Mapping[str, str], keys: Sequence[str] = (), threshold: float = schemas.Z_THRESHOLD
) -> DataFrame:
    """Simple checks of a cleaned table, one row per finding: (keys, problem, rows).

    Required columns, nulls in time, price and value columns, negative prices and volumes, anomalies.
    """
    types = dict(df.dtypes)
    numbers = [c for c, t in df.dtypes if is_numeric(t) and c not in keys]
    counters = {f"missing column {c}": F.lit(1).cast("bigint") for c in schema if c not in types}
    counters = {name: F.max(one) for name, one in counters.items()}
    for c in ("timestamp", "date", "price", "value", "close"):
        if c in types:
            counters[f"null {c}"] = F.count_if(F.col(c).isNull())
    for c in ("price", "volume", "open", "high", "low", "close"):
        if c in types and is_numeric(types[c]):
            counters[f"negative {c}"] = F.count_if(F.col(c) < 0)
    flagged = zscore_flags(df, keys, numbers, threshold) if numbers else df
    for c in numbers:
        counters[f"anomaly {c}"] = F.count_if(F.col(f"{c}_anomaly"))
    wide = flagged.groupBy(*keys).agg(*[f.alias(name) for name, f in counters.items()])
    pairs = [F.struct(F.lit(n).alias("problem"), F.col(f"`{n}`").alias("rows")) for n in counters]
    return wide.select(*keys, F.inline(F.array(*pairs))).filter("rows > 0")


def clean(
    df: DataFrame,
    schema: Mapping[str, str],
    s: Series,
    threshold: float = schemas.MISSING_THRESHOLD,
    on_error: str = "keep",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    untimed: bool = False,
) -> DataFrame:
    """Repeated rows, types, nulls, time zone. ``on_error='fail'`` raises when a check other than the
    anomaly one finds something. With ``untimed`` rows without a time are no repeats of each other: a reader
    leaves no time where the delivered one does not parse.

    The rows are staged once after the repeats are gone, so that the statistics of the later steps do not
    repeat the shuffle.
    """
    order = [c for c in (SEQ, *s.order) if c in df.columns]
    if untimed:
        timed = drop_repeats(df.filter(F.col(s.time).isNotNull()), order)
        one = stage(timed.unionByName(df.filter(F.col(s.time).isNull())))
    else:
        one = stage(drop_repeats(df, order))
    out = to_utc(impute(coerce(one, schema), s, threshold=threshold, rows_per_chunk=rows_per_chunk))
    if on_error == "fail":
        found = problems(out, schema, s.keys).filter(~F.col("problem").startswith("anomaly"))
        names = [r[0] for r in found.select("problem").distinct().orderBy("problem").collect()]
        if names:
            raise ValueError(f"cleaned data has problems: {names}")
    return out


def clean_weather(df: DataFrame, s: Series, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Temperatures filled from their neighbours, precipitation with 0, other numbers with the
    median; then outliers are capped and physical bounds applied."""
    types = dict(df.dtypes)
    numbers = [c for c in df.columns if is_numeric(types[c]) and c not in (*s.keys, *s.order, SEQ)]
    temperatures = [c for c in numbers if "temp" in c.lower()]
    wet = [
        c for c in numbers
        if c not in temperatures and any(word in c.lower() for word in ("rain", "snow", "precip"))
    ]
    others = [c for c in numbers if c not in temperatures and c not in wet]
    out = df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(types[c])) for c in wet}) if wet else df
    if temperatures:
        out = fill_both_ways(out, s, temperatures, rows_per_chunk)
    if others:
        out = impute(out, s, others, threshold=1.0, rows_per_chunk=rows_per_chunk)
    out = cap_outliers(out, s.keys, numbers)
    bounds = {"temperature": (-50, 60), "humidity": (0, 100), "wind_speed": (0, 150)}
    return out.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items() if c in numbers})
