"""Query over exact vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import vector_search
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}

EVERY = 50
BEST = 5


def op7_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    vectors = vectors.withColumn("v", vector_search.quantised(F.col("embedding")))
    return vector_search.top_k(vectors, "vec_id", "v", F.col("vec_id") % EVERY == 0, BEST)


QUERIES["op7_top_k"] = op7_top_k
ORACLES["op7_top_k"] = f"""
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {BEST}
"""
