"""Query over the Merkle manifest of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.common import table
from tidemark.llm.query_layout import CRC_TABLE

QUERIES: dict = {}
ORACLES: dict = {}

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark, folder):
    """Rows without a doc_id are not tampered with. Rows equal in source, doc_id and content may take each other's place."""
    docs = table(spark, folder, "documents").select(*FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select(
        "doc_id", "source", merkle.digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
        merkle.digest(*[F.col(c) for c in FIELDS[:-1]], altered).alias("tampered"),
    )
    found = merkle.manifest(leaves, "source", ["doc_id"], "leaf", ["doc_id", "tampered"])
    found = found.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES["op13_merkle_manifest"] = op13_merkle_manifest


def _fields(text: str) -> str:
    names = [f"{c}::VARCHAR" for c in FIELDS[:-1]] + [text]
    return " || ".join(f"coalesce(octet_length(encode({n}))::VARCHAR || ':' || {n}, '-')" for n in names)


# Two trees by recursion over levels: tree 0 has one group for each source, tree 1 has the subroots as its leaves.
ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE {CRC_TABLE}, marked AS (
  SELECT *, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
        lambda pair: ('0x' || pair)::BIGINT)),
      lambda s, x: xor(s >> 8, c[(xor(s, x) & 255) + 1]))) % 2 = 0 AS chosen
  FROM documents, crc
), hashed AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, sha256({_fields("text")}) AS leaf,
    sha256({_fields("(CASE WHEN chosen THEN replace(text, chr(10), '') ELSE text END)")}) AS tampered
  FROM marked
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed
), tree(lvl, g, idx, h, n) AS (
  SELECT 0, g, idx, leaf, count(*) OVER (PARTITION BY g) FROM leaves
  UNION ALL
  SELECT lvl + 1, g, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY lvl, g, idx // 3, n
), subroots AS (SELECT g, h FROM tree WHERE n = 1
), top(lvl, idx, h, n) AS (
  SELECT 0, g, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n
), both_trees AS (
  SELECT lvl, g, idx, h, n FROM tree UNION ALL SELECT 1000 + lvl, -1, idx, h, n FROM top
), sides AS (
  SELECT a.lvl, a.g, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM both_trees a JOIN both_trees b ON a.lvl = b.lvl AND a.g = b.g AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.lvl, a.g, a.idx
), walk(g, idx, own, lvl, place, node, proof) AS (
  SELECT g, idx, g, 0, idx, tampered, '' FROM leaves
  UNION ALL
  SELECT w.g, w.idx, CASE WHEN s.g IS NULL THEN -1 ELSE w.own END, CASE WHEN s.g IS NULL THEN 1000 ELSE w.lvl + 1 END,
    CASE WHEN s.g IS NULL THEN w.g ELSE w.place // 3 END,
    CASE WHEN s.g IS NULL THEN w.node ELSE sha256(s.l || w.node || s.r) END, CASE WHEN s.g IS NULL THEN w.proof ELSE w.proof || s.l || s.r END
  FROM walk w LEFT JOIN sides s ON s.lvl = w.lvl AND s.g = w.own AND s.idx = w.place WHERE s.g IS NOT NULL OR w.own >= 0
), ends AS (SELECT g, idx, arg_max(node, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM walk WHERE own = -1 GROUP BY g, idx
), root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots s USING (g) JOIN ends USING (g, idx), root
"""
