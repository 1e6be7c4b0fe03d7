"""Shards by jump consistent hashing, in DataFrame expressions only.

A key walks along a pseudo-random sequence of ever higher shard numbers and stays at the last one
below the number of shards. There is no ring table, and a further shard takes rows only into itself:
the walk of a key is the same, it merely may go one step further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, number_rows, own
from tidemark.session import stage

# Fixed value: the multiplier of the 64-bit congruential generator in the published algorithm
# (Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm").
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW0, _LOW1 = _LOW & 0xFFFF, _LOW >> 16


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to ``shards`` - 1) of a 64-bit integer key; a null key counts as 0.

    The generator needs products modulo 2^64, which overflow a long. The state is therefore kept as two
    unsigned halves of 32 bits in longs, and every partial product fits into a long.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("h"),
        key.bitwiseAND(F.lit(0xFFFFFFFF)).alias("l"),
        F.lit(-1).cast("bigint").alias("b"),
        F.lit(0).cast("bigint").alias("j"),
    )

    def step(s: Column, _: Column) -> Column:
        mask = F.lit(0xFFFFFFFF)
        t1 = s["l"] * F.lit(_LOW1)
        low = s["l"] * F.lit(_LOW0) + F.shiftleft(t1.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
        carry = F.shiftright(low, 32) + F.shiftright(t1, 16)
        cross = s["h"] * F.lit(_LOW0) + F.shiftleft((s["h"] * F.lit(_LOW1)).bitwiseAND(F.lit(0xFFFF)), 16)
        h = (carry + (s["l"] * F.lit(_HIGH)).bitwiseAND(mask) + cross).bitwiseAND(mask)
        j = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(h, 1) + 1).cast("double")))
        moved = F.struct(h.alias("h"), low.bitwiseAND(mask).alias("l"), s["j"].alias("b"), j.cast("bigint").alias("j"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    return walk["b"].cast("int")


def with_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; a projection, so nothing is shuffled and every row is kept.

    A string key is hashed to 64 bits first; an integer key is used as it is. Null keys go to one fixed
    shard. Equal keys share a shard: that is the law. A column that is already called ``name`` is replaced.
    """
    column = named(df, key)
    if dict(df.dtypes)[key] not in ("bigint", "int", "smallint", "tinyint"):
        column = F.when(column.isNotNull(), F.xxhash64(column))
    return df.withColumn(name, jump_hash(column, shards))


def digest(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """One row for each row of ``df``: key, size, checksum, shard, place inside the shard, shard after growth.

    Places are numbered in key order; rows with an equal key are told apart by an id of their own, so a
    key that holds a third of all rows is still dealt over many tasks. Null or empty texts have size 1.
    """
    content = F.coalesce(named(df, text), F.lit(""))
    column = named(df, key)
    slim = df.select(
        column.alias("key"),
        (F.octet_length(content).cast("bigint") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    slim = with_shards(with_shards(slim, "key", shards), "key", shards + 1, "grown_shard")
    row = own(slim, "_row")
    slim = stage(slim.withColumn(row, F.monotonically_increasing_id()))
    return number_rows(slim, ["shard"], ["key", row], "slot").drop(row)
