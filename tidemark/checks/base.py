"""Registration of queries over the driver tables, and the shaping their results share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one folder, read lazily: ``t.events``, ``t.orders`` and so on."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable types: rounded doubles, long integers, unzoned timestamps."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(name))
    return df.select(*columns)


def query(sql: str | None = None, digits: int = 6):
    """Register ``fn(tables)`` under its name, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: tidy(fn(Tables(spark, folder)), digits)
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
