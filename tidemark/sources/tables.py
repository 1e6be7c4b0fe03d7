"""Stored tables, the incremental filter, and the catalogue of requested items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, **equal) -> DataFrame:
    """Parquet scan with the projection and the equality filters pushed into it."""
    df = spark.read.parquet(path)
    for name, value in equal.items():
        df = df.filter(F.col(name) == value)
    return df.select(*columns) if columns else df


def scan_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """Table of a relational database, read in ranges of a numeric key."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high)
    return reader.option("numPartitions", parts).options(**options).load()


def newer_than(df: DataFrame, field: str, mark) -> DataFrame:
    """Rows past the high-water mark; all rows when there is none."""
    return df if mark is None else df.filter(F.col(field) > F.lit(mark))


LOOKBACK_DAYS = {
    "candles": 365, "weather": 30, "pollution": 7, "stock_bars": 180, "forex_bars": 14, "terminal": 365,
}


def in_range(df: DataFrame, time: str, asof: Column, days: int | None = None, kind: str | None = None) -> DataFrame:
    """Rows between ``asof`` minus the look-back and ``asof``."""
    days = LOOKBACK_DAYS[kind] if days is None else days
    return df.filter(F.col(time).between(asof - F.expr(f"INTERVAL {int(days)} DAYS"), asof))


def universe(spark: SparkSession) -> DataFrame:
    """The default items: (asset_type, item, category). A fixed list of about fifty rows."""
    rows = [(kind, item, None) for kind, items in schemas.DEFAULT_ITEMS.items() for item in items]
    rows += [("fund", item, name) for name, items in schemas.FUND_CATEGORIES.items() for item in items]
    rows += [("index_region", item, meta[1]) for item, meta in schemas.INDEX_METADATA.items()]
    return spark.createDataFrame(rows, "asset_type string, item string, category string")


def members(kind: str, name: str) -> tuple[str, ...]:
    """Members of a fund category or an index region (case does not matter); else the default list."""
    if kind == "etf":
        return schemas.FUND_CATEGORIES.get(name, schemas.DEFAULT_ITEMS["etf"])
    found = tuple(i for i, meta in schemas.INDEX_METADATA.items() if meta[1].lower() == name.lower())
    return found or schemas.DEFAULT_ITEMS["index"]


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows delivered for every item of the catalogue, 0 for those without any: (asset_type, item, category, n)."""
    counted = df.groupBy(F.col(column).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    known = F.broadcast(universe(df.sparkSession))  # about fifty rows
    # Only counts of catalogue items are left for the outer join, at most one for each.
    held = counted.join(known.select("item").distinct(), "item", "left_semi")
    return known.join(held, "item", "left").select("asset_type", "item", "category", F.coalesce("n", F.lit(0)).alias("n"))


def only_items(df: DataFrame, column: str, items: Sequence[str]) -> DataFrame:
    """Rows of the listed items; a literal list is pushed into the scan."""
    return df.filter(F.col(column).isin(*items))


def valid_intervals(df: DataFrame, column: str = "interval") -> DataFrame:
    return only_items(df, column, schemas.INTERVALS)
