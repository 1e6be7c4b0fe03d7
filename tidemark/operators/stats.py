"""Exact order statistics and modes that never gather one key's rows in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import join_on
from tidemark.session import pin, small

# Up to this many rows per key, Spark's exact ``percentile`` (one buffer per key) is used.
BUFFERED_ROWS = 1_000_000
# Larger keys with up to this many distinct values per column are counted by value first.
COUNTED_VALUES = 1_000_000
SKETCH_ACCURACY = 10_000
_ALL = "_all"


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, Sequence[float]],
    buffered_rows: int = BUFFERED_ROWS,
    counted_values: int = COUNTED_VALUES,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key, as columns ``<col>_p<100 * prob>``.

    ``percentile`` keeps every distinct value of a key in one aggregation buffer, so it runs on the
    rows only when the largest key is known to fit. A larger key with few distinct values (prices
    move in ticks) is first counted by value, which spreads it, and the counts are the frequencies.
    Otherwise a mergeable sketch brackets each quantile within 2/10,000 of the ranks, a second scan
    counts the values below the bracket and the distinct values inside it, and the exact order
    statistics are read from those counts.
    """
    columns = [(c, p, f"{c}_p{p * 100:g}".replace(".", "_")) for c, probs in wanted.items() for p in probs]
    if not keys:
        keyed = df.withColumn(_ALL, F.lit(0))
        return quantiles(keyed, [_ALL], wanted, buffered_rows, counted_values).drop(_ALL)
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest <= buffered_rows:
        return df.groupBy(*keys).agg(*[F.percentile(c, F.lit(p)).alias(name) for c, p, name in columns])
    used = sorted({c for c, _, _ in columns})
    distinct = df.groupBy(*keys).agg(F.greatest(F.lit(0), *[F.approx_count_distinct(c) for c in used]).alias("_n"))
    if distinct.agg(F.max("_n")).first()[0] <= counted_values:
        return _counted(df, keys, used, columns)
    return _bracketed(df, keys, columns)


def _counted(df: DataFrame, keys: Sequence[str], used: Sequence[str], columns: list[tuple[str, float, str]]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("v")) for c in used]
    counts = df.select(*keys, F.inline(F.array(*pairs))).groupBy(*keys, "stat", "v").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(*keys).agg(
        *[F.percentile(F.when(F.col("stat") == c, F.col("v")), F.lit(p), F.col("c")).alias(name) for c, p, name in columns]
    )


def _bracketed(
    df: DataFrame, keys: Sequence[str], columns: list[tuple[str, float, str]], margin: float = 2.0 / SKETCH_ACCURACY
) -> DataFrame:
    """Quantiles from the counts inside brackets. If a wanted rank lies outside its bracket, all brackets are widened."""
    used = sorted({c for c, _, _ in columns})
    edges = [
        F.percentile_approx(
            c, [max(p - margin, 0.0), min(p + margin, 1.0)], F.lit(SKETCH_ACCURACY)
        ).alias(f"_edge_{name}")
        for c, p, name in columns
    ]
    sketch = pin(df.groupBy(*keys).agg(*[F.count(c).alias(f"_n_{c}") for c in used], *edges))
    rows = join_on(df.select(*keys, *used), small(sketch), keys)

    def probe(c: str, p: float, name: str):
        """Null when the value lies above the bracket; a null ``v`` counts a value below it."""
        value = F.col(c).cast("double")
        # Below this size a rank is wider than the margin, so every value stays in the bracket.
        whole = F.col(f"_n_{c}") <= 2 * SKETCH_ACCURACY
        low = F.element_at(f"_edge_{name}", 1).cast("double")
        high = F.element_at(f"_edge_{name}", 2).cast("double")
        entry = lambda v: F.struct(
            F.lit(name).alias("stat"), F.lit(p).alias("p"), F.col(f"_n_{c}").alias("n"), v.alias("v")
        )
        return (
            F.when(value.isNull(), None)
            .when(whole | value.between(low, high), entry(value))
            .when(value < low, entry(F.lit(None).cast("double")))
        )

    counted = (
        rows.select(*keys, F.inline(F.array_compact(F.array(*[probe(*spec) for spec in columns]))))
        .groupBy(*keys, "stat", "p", "n", "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upto = (
        Window.partitionBy(*keys, "stat")
        .orderBy(F.col("v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rank = F.col("p") * (F.col("n") - 1)
    ranked = counted.withColumn("seen", F.sum("c").over(upto)).withColumn("rank", rank)
    picked = ranked.groupBy(*keys, "stat").agg(
        F.min(F.when(F.col("seen") > F.floor("rank"), F.col("v"))).alias("lo"),
        F.min(F.when(F.col("seen") > F.ceil("rank"), F.col("v"))).alias("hi"),
        F.first("rank").alias("rank"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("below"),
        F.max("seen").alias("reached"),
    )
    picked = pin(picked)
    outside = (F.floor("rank") < F.col("below")) | (F.ceil("rank") >= F.col("reached"))
    if margin < 1.0 and not picked.filter(outside).isEmpty():
        return _bracketed(df, keys, columns, min(1.0, margin * 16))
    value = F.col("lo") + (F.col("rank") - F.floor("rank")) * (F.col("hi") - F.col("lo"))
    found = picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("stat") == name, value)).alias(name) for _, _, name in columns]
    )
    # Keys whose values are all null have no counted rows and still get a (null) result.
    return join_on(sketch.select(*keys), found, keys)


def modes(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Most frequent value per key and column (ties go to the smallest), as ``<col>_mode``.

    Values are counted first, so a hot key is spread over its distinct values.
    """
    long = df.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("stat"), F.col(c).cast("string").alias("v"))
                    for c in columns
                ]
            )
        ),
    )
    counts = long.groupBy(*keys, "stat", "v").agg(F.count(F.lit(1)).alias("c"))
    types = dict(df.dtypes)
    return counts.groupBy(*keys).agg(
        *[
            F.min(F.when((F.col("stat") == c) & F.col("v").isNotNull(), F.struct(-F.col("c"), F.col("v").cast(types[c]).alias("v"))))
            .getField("v")
            .alias(f"{c}_mode")
            for c in columns
        ]
    )
