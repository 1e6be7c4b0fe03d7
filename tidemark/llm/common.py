"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import small, stage


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def own(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name


def named(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return df["`" + name.replace("`", "``") + "`"]


def number_rows(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within each group, in ascending ``order`` (nulls first), without a gap.

    No task receives a whole group: rows are dealt by ranges of (groups, order), the place inside a
    partition is read off, and the counts of the partitions before it are added. The counts have one
    row for each partition and each group, so ``groups`` must have few values (shards, lengths).
    Rows that tie in all of these columns are numbered in any order, but each gets its own number;
    add a unique last column to ``order`` where a third of all rows may tie. ``df`` is read twice,
    so it should be a table or a staged one. The result is staged.
    """
    place, part = own(df, "_place"), own(df, "_part")
    keys = [named(df, c).asc_nulls_first() for c in [*groups, *order]]
    dealt = df.repartitionByRange(partitions(df), *keys)
    keys = [named(dealt, c).asc_nulls_first() for c in [*groups, *order]]
    row = F.monotonically_increasing_id()
    # The upper bits of the id are the partition, the lower 33 the row inside it.
    laid = stage(dealt.sortWithinPartitions(*keys).select("*", row.alias(place)))
    laid = laid.withColumn(part, F.shiftright(named(laid, place), 33))
    counts = laid.groupBy(*[named(laid, c) for c in groups], part).agg(
        F.count(F.lit(1)).alias("_n"), F.min(named(laid, place)).alias("_first")
    )
    before = F.expr(
        f"coalesce(sum(_n) over (partition by {', '.join(f'`{c}`' for c in groups) or '1'} order by `{part}` "
        "rows between unbounded preceding and 1 preceding), 0)"
    )
    shift = counts.select(*groups, part, (before - F.col("_first")).alias("_shift"))
    renamed = [f"_g{i}" for i in range(len(groups))]
    shift = small(stage(shift.toDF(*renamed, "_gp", "_shift")))
    match = named(laid, part) == shift["_gp"]
    for own_name, other in zip(groups, renamed, strict=True):
        match &= named(laid, own_name).eqNullSafe(shift[other])
    joined = laid.join(shift, match, "inner")
    return joined.select(*[named(joined, c) for c in df.columns], (named(joined, place) + F.col("_shift")).alias(name))
