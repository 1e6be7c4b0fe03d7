"""Bring tables of one data type to canonical names, types, symbols, units and granularity."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar
from tidemark.operators import bars
from tidemark.operators.clean import SEQ, is_time, keep_one
from tidemark.operators.series import ROWS_PER_CHUNK, Series, attach

METADATA = ("standardized_at", "data_type", "granularity", "units")


def rename(df: DataFrame) -> DataFrame:
    """Sanitise the names, then map aliases to canonical names; the first alias present wins."""
    df = df.toDF(*[scalar.clean_name(c) for c in df.columns])
    names = set(df.columns)
    mapping = {}
    for canonical, aliases in schemas.COLUMN_ALIASES.items():
        found = next((a for a in aliases if a in names and a not in mapping), None)
        if found and found != canonical and canonical not in names:
            mapping[found] = canonical
    return df.withColumnsRenamed(mapping)


def set_types(df: DataFrame) -> DataFrame:
    """Numbers to double, volume to bigint when every digit counts, the rest as it is."""
    types = dict(df.dtypes)
    casts = {c: F.col(c).try_cast("double") for c in schemas.NUMERIC_COLUMNS if c in types}
    if "volume" in casts and types["volume"] in ("bigint", "int", "smallint"):
        casts["volume"] = F.col("volume").cast("bigint")
    return df.withColumns(casts) if casts else df


def set_time(df: DataFrame) -> DataFrame:
    """A UTC ``timestamp`` (from ``date`` when there is no other) and the date parts."""
    types = dict(df.dtypes)
    source = "timestamp" if "timestamp" in types else "date" if "date" in types else None
    if source is None:
        return df
    parsed = F.col(source).cast("timestamp") if is_time(types[source]) else scalar.parse_time(source)
    df = df.withColumn("timestamp", parsed)
    return df.withColumns(scalar.time_parts("timestamp"))


def set_symbols(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("symbol", scalar.clean_symbol("symbol", kind)) if "symbol" in df.columns else df


def set_units(df: DataFrame, kind: str) -> DataFrame:
    """Prices to US dollars, imperial weather to metric, economic units to canonical words."""
    names = set(df.columns)
    if kind in ("stock", "crypto", "forex", "economic") and "currency" in names:
        prices = [c for c in schemas.PRICE_COLUMNS if c in names]
        df = df.withColumns({c: scalar.to_usd(c, "currency") for c in prices}).withColumn("currency", F.lit("USD"))
    if kind == "weather" and "units" in names:
        changed = {}
        if "temperature" in names:
            changed["temperature"] = scalar.to_celsius("temperature", "units")
        if "wind_speed" in names:
            changed["wind_speed"] = scalar.to_metres_per_second("wind_speed", "units")
        df = df.withColumns({**changed, "units": F.lit("metric")})
    if kind == "economic" and "units" in names:
        df = df.withColumn("units", scalar.clean_unit("units"))
    return df


def add_required(df: DataFrame, kind: str) -> DataFrame:
    """Add missing required columns as nulls of their type."""
    missing = [c for c in schemas.REQUIRED_COLUMNS.get(kind, ()) if c not in df.columns]
    types = lambda c: "timestamp" if c == "timestamp" else "string" if c in schemas.TEXT_COLUMNS else "double"
    return df.withColumns({c: F.lit(None).cast(types(c)) for c in missing}) if missing else df


def finalize(df: DataFrame, kind: str, one: bool = True) -> DataFrame:
    """Last row per timestamp and series (unless ``one`` is off), metadata stamps, time columns first, metadata last."""
    key = [c for c in ("timestamp", "symbol", "series_id", "location") if c in df.columns]
    if key and one:
        ties = [SEQ] if SEQ in df.columns else [F.xxhash64(*df.columns)]
        df = keep_one(df, key, ties, keep="last")
    df = df.withColumns({"standardized_at": F.current_timestamp(), "data_type": F.lit(kind)})
    times = [c for c in df.columns if ("time" in c or "date" in c) and c not in METADATA]
    others = [c for c in df.columns if c not in times and c not in METADATA]
    return df.select(*times, *others, *[c for c in METADATA if c in df.columns])


def standardize(
    df: DataFrame,
    kind: str,
    target: str | None = None,
    fill_gaps: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    every: bool = False,
    untimed: bool = False,
) -> DataFrame:
    """The whole chain for one data type.

    Series whose detected granularity is finer than the target are resampled; the others are kept. With ``every``
    all series are resampled, so that there is one row per bin, as a table whose key is the bin needs it. With
    ``untimed`` each row without a time is kept, as a row of its own that belongs to no bin.
    """
    df = add_required(set_units(set_symbols(set_time(set_types(rename(df))), kind), kind), kind)
    keys = [c for c in schemas.SERIES_KEYS.get(kind, ()) if c in df.columns]
    target = target or schemas.TARGET_GRANULARITY.get(kind)
    apart = None
    if untimed and "timestamp" in df.columns:
        apart, df = df.filter(F.col("timestamp").isNull()), df.filter(F.col("timestamp").isNotNull())
    if keys and target and "timestamp" in df.columns:
        df = to_granularity(df, kind, keys, target, fill_gaps, rows_per_chunk, every)
    out = finalize(df, kind)
    if apart is None:
        return out
    apart = finalize(apart, kind, one=False)
    return out.unionByName(apart.select(*[c for c in apart.columns if c in out.columns]), allowMissingColumns=True)


def to_granularity(
    df: DataFrame, kind: str, keys: list[str], target: str, fill_gaps: bool, rows_per_chunk: int, every: bool = False
) -> DataFrame:
    """Resample the series that are finer than ``target``, or all of them."""
    ranks = {label: n for n, (label, _) in enumerate(schemas.GRANULARITY_LIMITS)}
    ties = (SEQ,) if SEQ in df.columns else ()
    if every:
        coarse, finer = None, df
    else:
        found = bars.granularity(df, Series(tuple(keys), "timestamp", ties), rows_per_chunk)
        tagged = attach(df, found.select(*keys, "granularity"), keys)
        fine = F.coalesce(F.col("granularity").isin([g for g, n in ranks.items() if n < ranks.get(target, 0)]), F.lit(False))
        coarse, finer = tagged.filter(~fine), tagged.filter(fine)
    rules = dict(bars.RULES[kind])
    # Known to be the same in every row by now; aggregating text would force a sort on the map side.
    constants = {"weather": {"units": "metric"}, "sentiment": {}}.get(kind, {"currency": "USD"})
    constants = {c: F.lit(v) for c, v in constants.items() if c in df.columns}
    if kind == "economic" and "units" in df.columns:
        rules["units"] = "first"
    binned = bars.resample(finer, keys, "timestamp", target, rules, ties, fill_gaps)
    binned = binned.withColumns({"granularity": F.lit(target), **constants})
    dates = {c: e for c, e in scalar.time_parts("timestamp").items() if c in df.columns}
    binned = binned.withColumns(dates)
    return binned if coarse is None else coarse.unionByName(binned, allowMissingColumns=True)


def standardize_all(tables: Mapping[str, DataFrame], kind: str, **options) -> DataFrame:
    """Several tables of one data type as one job; their series stay apart by key and item."""
    return standardize(combine(tables), kind, **options)


def combine(tables: Mapping[str, DataFrame], item_column: str | None = "item") -> DataFrame:
    """Per-item tables as one table, the item in a column."""
    frames = [df.withColumn(item_column, F.lit(item)) if item_column else df for item, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
