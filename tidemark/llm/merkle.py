"""A Merkle manifest of a dataset: digests of rows, roots of groups, one root, and a proof for each row.

Nodes of a group are numbered and cut into aligned blocks of ``WIDTH`` ** ``depth``. A block keeps each of
its levels as one string of hexadecimal digests; every digest has 64 places, so fixed-width substrings give
the runs to hash into parents, and what flanks a digest inside its run gives the siblings of a proof. The
roots of the blocks are the nodes of the next tier, where the same is done again, until each group has one
block. The roots of the groups go through the same tiers as one further group. A block is all that a task
ever holds of a group, so a group with a third of all rows is as good as any other.

Levels are kept as binary: a substring of bytes starts where it is told, one of text walks from the front.
Everything here is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, number_rows
from tidemark.session import pin, small, stage

# Subroots with their paths (some 1.5 KB each) are broadcast up to this many groups.
GROUPS = 10_000

WIDTH = 3
DEPTH = 6
DIGEST = 64


def field(column: Column) -> Column:
    """A value as ``byte count:value``, so that no two rows run together; null as ``-``."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    """The digest of a row: hexadecimal SHA-256 of its fields in order."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _cut(level: Column, first: Column, size: int) -> Column:
    return F.substring(level, first.cast("int") + 1, F.lit(size))


def _nodes(level: Column) -> Column:
    return (F.octet_length(level) / DIGEST).cast("int")


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(_nodes(level) / WIDTH).cast("int") - 1)
    return F.array_join(
        F.transform(runs, lambda r: F.sha2(_cut(level, r * (DIGEST * WIDTH), DIGEST * WIDTH), 256)), ""
    ).cast("binary")


def _levels(first: Column, whole: Column, depth: int) -> Column:
    """The levels of a block, lowest first: up to one node if it is the ``whole`` group, else ``depth`` times."""

    def step(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when(whole & (_nodes(top) == 1), levels).otherwise(F.array_append(levels, _parents(top)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(first), step)


def _path(levels: Column, at: Column) -> Column:
    """Siblings of the node at place ``at`` of the lowest level, up to the top of the block."""

    def siblings(level: Column, height: Column) -> Column:
        place = F.floor(at / F.pow(F.lit(float(WIDTH)), height)).cast("int")
        run = _cut(level, (place - place % WIDTH) * DIGEST, DIGEST * WIDTH)
        before = (place % WIDTH) * DIGEST
        left, right = F.substring(run, F.lit(1), before), F.substring(run, before + DIGEST + 1, F.lit(DIGEST * WIDTH))
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    below_top = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(below_top, siblings)


def _tier(nodes: DataFrame, depth: int) -> tuple[DataFrame, bool]:
    """Blocks of ``nodes`` (g, idx, h, more) with their levels, staged, and whether every group has one block.

    ``g`` is a struct that is never null itself, so a null source is a group like any other.
    """
    block = F.floor(F.col("idx") / WIDTH**depth).cast("bigint")
    item = F.struct("idx", "h", "more")
    blocks = nodes.groupBy("g", block.alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    counted = nodes.groupBy(F.col("g").alias("_g")).agg(F.floor(F.max("idx") / WIDTH**depth).cast("bigint").alias("last"))
    counted = pin(counted)
    blocks = blocks.join(small(counted), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    first = F.array_join(F.transform("items", lambda x: x["h"]), "").cast("binary")
    blocks = stage(blocks.select("g", "block", "items", _levels(first, F.col("last") == 0, depth).alias("levels")))
    return blocks, counted.filter("last > 0").isEmpty()


def _climb(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """The tiers over ``nodes``, lowest first; the blocks of the last one hold the roots of the groups."""
    tiers = []
    while True:
        blocks, done = _tier(nodes, depth)
        tiers.append(blocks)
        if done:
            return tiers
        root = F.element_at("levels", -1).cast("string")
        nodes = blocks.select("g", F.col("block").alias("idx"), root.alias("h"), F.lit(None).cast("int").alias("more"))


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the lowest tier with their paths; ``above`` gives each group (ag) a subroot, a path and the root."""
    paths = None
    for blocks in reversed(tiers):
        if paths is None:
            held = blocks.join(above, F.col("g").eqNullSafe(F.col("ag"))).drop("ag")
        else:
            upper = paths.select(
                F.col("g").alias("ag"), F.col("idx").alias("ablock"), F.col("path").alias("apath"), "subroot", "root"
            )
            held = blocks.join(upper, F.col("g").eqNullSafe(F.col("ag")) & (F.col("block") == F.col("ablock"))).drop("ag", "ablock")
        each = held.select("*", F.posexplode("items").alias("at", "item"))
        path = F.concat(_path(F.col("levels"), F.col("at")), F.col("apath"))
        paths = each.select("g", "item.idx", "item.h", "item.more", path.alias("path"), "subroot", "root")
    return paths


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str, keep: list[str], depth: int = DEPTH) -> DataFrame:
    """One row for each row: its columns ``keep``, ``group``, leaf, subroot, root and path (array of left and right siblings).

    Leaves of a group ascend by ``order`` (nulls first), then by digest; rows that are equal in all of these take
    neighbouring places in any order. Groups ascend by ``group``, null first, strings bytewise. A group of one leaf
    has that leaf as its root, and one group's root is the root. An empty table gives no row. ``leaf`` must hold
    digests of 64 hexadecimal digits; other columns may have any names. ``depth`` sets the size of blocks, not the result.
    """
    slim = rows.select(
        F.struct(named(rows, group).alias("v")).alias("g"), F.struct(*[named(rows, c).alias(f"o{i}") for i, c in enumerate(order)]).alias("o"),
        named(rows, leaf).alias("h"), F.struct(*[named(rows, c).alias(f"k{i}") for i, c in enumerate(keep)]).alias("more"),
    )
    slim = stage(slim.withColumn("row", F.monotonically_increasing_id()))
    nodes = number_rows(slim, ["g"], ["o", "h", "row"], "idx").select("g", "idx", "h", "more")
    tiers = _climb(nodes, depth)
    tops = tiers[-1].select("g", F.element_at("levels", -1).cast("string").alias("h"))
    groups = stage(tops.select(F.struct(F.lit(0).alias("v")).alias("all"), "g", "h"))
    ranked = number_rows(groups, [], ["g"], "idx").select(F.col("all").alias("g"), "idx", "h", F.col("g").alias("more"))
    summit = _climb(ranked, depth)
    top = summit[-1].select(
        F.col("g").alias("ag"), F.element_at("levels", -1).cast("string").alias("root"),
        F.lit(None).cast("string").alias("subroot"), F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("apath"),
    )
    roots = _descend(summit, top)
    above = pin(roots.select(F.col("more").alias("ag"), F.col("path").alias("apath"), F.col("h").alias("subroot"), "root"))
    found = _descend(tiers, small(above, GROUPS))
    kept = [F.col(f"more.k{i}").alias(c) for i, c in enumerate(keep)]
    return found.select(*kept, F.col("g.v").alias("group"), F.col("h").alias("leaf"), "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path in one string, from the leaf upwards, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
