"""Exact k best inner products with a KD-tree for each shard of the vectors.

A tree splits its shard at medians down to leaves and keeps the tight bounding box of every node. The
inner product of a query with anything in a box is at most the sum over dimensions of the larger of the
products with the two box sides. A query takes the node with the highest bound next, and stops when that
bound is below its k-th score. It begins in one shard, and the k-th score found there goes with it to
all others, so these can leave out whole trees.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import named
from tidemark.session import stage

SHARD_ROWS = 4096
QUERY_BLOCK = 4096
LEAF = 64
_FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


class KDTree:
    """Median splits along the widest side; equal points are split as well, so the depth is bounded."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(points))
        self.points = points
        low, high, span, children = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            here = points[self.order[a:b]]
            node = len(low)
            low.append(here.min(0))
            high.append(here.max(0))
            span.append((a, b))
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            if b - a > leaf:
                axis, middle = int((high[-1] - low[-1]).argmax()), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(here[:, axis], middle)]
                todo += [(a, a + middle, node), (a + middle, b, node)]
        self.low, self.high, self.span, self.children = np.array(low), np.array(high), span, children
        self.sorted = points[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest possible product of each query with each node's box; whole numbers, exact in a double."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def best(self, query: np.ndarray, bounds: np.ndarray, k: int, least: float, ids: np.ndarray, own: int):
        """The ``k`` best (score, place), ties to the smaller ``ids``, among scores of ``least`` or more; ``own`` is left out."""
        heap = [(-bounds[0], 0)]
        scores, places = np.zeros(0), np.zeros(0, np.int64)
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            a, b = self.span[node]
            now = self.sorted[a:b] @ query
            keep = np.flatnonzero(now >= least)
            at = self.order[a:b][keep]
            keep, at = keep[at != own], at[at != own]
            if not len(keep):
                continue
            scores, places = np.concatenate([scores, now[keep]]), np.concatenate([places, at])
            top = np.lexsort((places, ids[places], -scores))[:k]
            scores, places = scores[top], places[top]
            if len(scores) == k:
                least = max(least, scores[-1])
        return scores, places


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["v"].tolist(), np.float64).reshape(len(frame), -1)


def _search(k: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            # In order of id, so that the place of a point breaks ties as its id and row do.
            candidates = candidates.sort_values(["vec_id", "row"], ignore_index=True)
            tree, points = KDTree(_matrix(candidates)), _matrix(queries)
            ids, rows = candidates["vec_id"].to_numpy(), candidates["row"].to_numpy()
            bounds = tree.bounds(points)
            place = {r: i for i, r in enumerate(rows)}
            for q, least, row, name, limits in zip(points, queries["least"], queries["row"], queries["vec_id"], bounds, strict=True):
                least = -np.inf if pd.isna(least) else float(least)
                scores, at = tree.best(q, limits, k, least, ids, place.get(row, -1))
                out += [(row, name, int(rows[p]), int(ids[p]), int(s)) for s, p in zip(scores, at, strict=True)]
        return pd.DataFrame(out, columns=["query_row", "query_id", "row", "vec_id", "score"])

    return run


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double; null if the vector or a component is null or not finite."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & finite & (F.size(vector) > 0), F.transform(parts, lambda x: F.floor(x * scale)))


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int) -> DataFrame:
    """The ``k`` best rows for each query row: query_id, rank (from 1), vec_id, score.

    Components are whole numbers whose products add up to less than 2^53. Rows with a null key or vector take
    no part; a query meets vectors of its own length only, and never its own row. A repeated row is a row of
    its own, as a candidate and as a query. Other columns are left out. Queries go to every shard of
    ``SHARD_ROWS`` vectors in blocks, which is what an exact search must look at; memory is bounded by a
    shard and a block.
    """
    slim = df.select(
        named(df, key).cast("bigint").alias("vec_id"), named(df, vector).alias("v"), is_query.alias("ask")
    ).where("v is not null and vec_id is not null")
    slim = stage(slim.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()))
    dims = slim.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("ask").cast("bigint")).alias("q"))
    parts = dims.select(
        "dim",
        F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.col("q") / QUERY_BLOCK)).cast("int").alias("blocks"),
    )
    slim = slim.join(stage(parts), "dim").withColumn("h", F.xxhash64("row"))
    slim = slim.withColumn("shard", F.pmod("h", "shards").cast("int"))
    slim = stage(slim.withColumn("block", F.pmod(F.shiftrightunsigned("h", 20), "blocks").cast("int")))
    asks = stage(slim.where("ask"))
    home = (
        slim.groupBy("dim", "shard")
        .cogroup(asks.withColumn("least", F.lit(None).cast("bigint")).groupBy("dim", "shard"))
        .applyInPandas(_search(k), _FOUND)
    )
    home = stage(home)
    least = home.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    asks = asks.join(least.select(F.col("query_row").alias("row"), "least"), "row", "left")
    spread = asks.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where(F.col("to") != F.col("shard"))
    spread = spread.drop("shard").withColumnRenamed("to", "shard")
    copies = slim.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    away = (
        copies.groupBy("dim", "shard", "block")
        .cogroup(spread.groupBy("dim", "shard", "block"))
        .applyInPandas(_search(k), _FOUND)
    )
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = home.unionByName(away).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
