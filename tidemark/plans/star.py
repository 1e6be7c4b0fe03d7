"""Star schema: date, symbol and source dimensions and their versions, facts, and time-split training sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import calendar_features
from tidemark.operators import catalogue
from tidemark.operators.series import ROWS_PER_CHUNK, Series, join_on, over_series, running
from tidemark.session import pin, small

UNKNOWN = -1


def date_key(c: str):
    return F.date_format(c, "yyyyMMdd").cast("int")


def date_dim(spark: SparkSession, first: str = "2000-01-01", last: str = "2030-12-31") -> DataFrame:
    """One row per day between two dates."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return days.select(date_key("date").alias("date_key"), "date", *[e.alias(n) for n, e in calendar_features("date").items()])


def dim(df: DataFrame, natural: Sequence[str], attributes: Sequence[str], key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per natural key with a stable hash key.

    All attributes come from one row: the last in ``order``, and among equals the one with the greatest attributes.
    """
    row = F.struct(*attributes)
    rows = df.groupBy(*natural).agg(F.max_by(row, F.struct(*order, row)).alias("_row"))
    return rows.select(F.xxhash64(*natural).alias(key), *natural, "_row.*")


def dim_versions(
    df: DataFrame, natural: Sequence[str], attributes: Sequence[str], time: str, key: str, ties: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Versions of a dimension from ordered deliveries: key, natural key, attributes, version, valid_from, valid_to.

    A delivery whose attributes are those of the one before it changes nothing. Of several deliveries at one time the last
    by ``ties`` counts. A version is valid from its time until that of the next one, which is not part of it; the newest has
    no end. Versions are numbered from 1; the key is a hash of the natural key and the time. Rows without a time are no version.
    """
    row = F.struct(*attributes)
    last = df.filter(F.col(time).isNotNull()).groupBy(*natural, F.col(time).alias("valid_from"))
    last = last.agg(F.max_by(row, F.struct(*ties, row)).alias("_row"))
    s = Series(tuple(natural), "valid_from")

    def mark(frame: DataFrame, part: Series) -> DataFrame:
        w = part.window()
        before = F.lag("_row").over(w)
        return frame.withColumn("_same", before.isNotNull() & before.eqNullSafe(F.col("_row")))

    changed = over_series(last, s, mark, 1, rows_per_chunk=rows_per_chunk).filter(~F.col("_same")).drop("_same")
    closed = over_series(
        changed, s, lambda f, p: f.withColumn("valid_to", F.lead("valid_from").over(p.window())), 0, 1, rows_per_chunk=rows_per_chunk
    )
    numbered = running(closed.withColumn("_one", F.lit(1).cast("bigint")), s, {"version": ("sum", "_one")}, rows_per_chunk)
    return numbered.select(F.xxhash64(*natural, "valid_from").alias(key), *natural, "_row.*", "version", "valid_from", "valid_to")


def with_version(
    facts: DataFrame, versions: DataFrame, natural: Sequence[str], time: str, key: str, columns: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Facts with the key (and ``columns``) of the version that was valid at their time.

    Facts before the first version, without a member or without a time get the unknown key.
    """
    far = F.lit("9999-12-31").cast(dict(versions.dtypes)["valid_to"])
    until = F.coalesce(F.col("valid_to") - F.expr("INTERVAL 1 MICROSECOND"), far)
    ranges = versions.select(*natural, "valid_from", until.alias("_end"), key, *columns)
    found = catalogue.known_at(facts, ranges, list(natural), time, "valid_from", "_end", keep_unknown=True, rows_per_chunk=rows_per_chunk)
    return found.drop("valid_from", "_end").withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN).cast("bigint")))


def with_key(facts: DataFrame, dimension: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Facts with the dimension's key; a missing member gets the unknown key.

    The dimension's keys are pinned and broadcast only when counted small.
    """
    keys = small(pin(dimension.select(*natural, key)))
    joined = join_on(facts, keys, natural)
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN).cast("bigint")))


def price_facts(bars: DataFrame, symbols: DataFrame, symbol: str = "symbol", time: str = "date") -> DataFrame:
    """Daily price facts keyed by date and symbol."""
    facts = with_key(bars, symbols, [symbol], "symbol_key").withColumn("date_key", date_key(time))
    measures = [c for c in ("open", "high", "low", "close", "volume") if c in facts.columns]
    return facts.select("date_key", "symbol_key", *measures)


def split_by_time(df: DataFrame, time: str, train_end: str, test_end: str) -> DataFrame:
    """Rows up to the end of the training period and of the test period, marked; later rows go."""
    day = F.to_date(time)
    return df.withColumn(
        "split", F.when(day <= F.lit(train_end).cast("date"), "train").when(day <= F.lit(test_end).cast("date"), "test")
    ).filter("split IS NOT NULL")


def training_sets(df: DataFrame, model: str, time: str, train_end: str, test_end: str) -> DataFrame:
    """The record that describes a split: date ranges per model."""
    marked = split_by_time(df, time, train_end, test_end)
    within = lambda part: F.when(F.col("split") == part, F.to_date(time))
    return marked.agg(
        F.lit(model).alias("model_name"),
        F.min(within("train")).alias("train_start_date"),
        F.max(within("train")).alias("train_end_date"),
        F.min(within("test")).alias("test_start_date"),
        F.max(within("test")).alias("test_end_date"),
    )
