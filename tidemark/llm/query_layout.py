"""Queries over sharding, packing and token files."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import packing, sharding, token_files, vector_packing
from tidemark.llm.common import table
from tidemark.session import shared_folder

QUERIES: dict = {}
ORACLES: dict = {}

SHARDS = 16
CAPACITY = 1024
END = 2
# Instruction data: at most so many tokens, segments and tokens that bear loss in a sequence, and the end of an example.
LIMITS = vector_packing.Limits(tokens=2048, segments=64, loss=2048)
EXAMPLE_END = 1

# SQL for the table of the CRC-32 checksum.
CRC_TABLE = """bits(k, i, v) AS (
  SELECT k, 0, k FROM range(256) t(k)
  UNION ALL
  SELECT k, i + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM bits WHERE i < 8
), crc AS (SELECT list(v ORDER BY k) AS c FROM bits WHERE i = 8)"""


def op2_sharding(spark, folder):
    found = sharding.digest(table(spark, folder, "documents"), "doc_id", "text", SHARDS)
    return found.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


QUERIES["op2_sharding"] = op2_sharding
ORACLES["op2_sharding"] = f"""
WITH RECURSIVE {CRC_TABLE},
sums AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, rowid_,
    xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda pair: ('0x' || pair)::BIGINT)),
      lambda s, x: xor(s >> 8, c[(xor(s, x) & 255) + 1]))) AS text_crc32
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents), crc
), walk(rowid_, n, k, b, j) AS (
  SELECT rowid_, n, CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END,
    -1::BIGINT, 0::BIGINT FROM sums, (VALUES ({SHARDS}), ({SHARDS + 1})) t(n)
  UNION ALL
  SELECT rowid_, n, next, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT rowid_, n, j, (k * {sharding.MULTIPLIER} + 1) % 18446744073709551616 AS next FROM walk WHERE j < n)
), ends AS (SELECT rowid_, n, max(b)::INT AS shard FROM walk WHERE j >= n GROUP BY ALL)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard AS shard,
  row_number() OVER (PARTITION BY a.shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, g.shard AS grown_shard
FROM sums JOIN ends a USING (rowid_) JOIN ends g USING (rowid_) WHERE a.n = {SHARDS} AND g.n = {SHARDS + 1}
"""


def op8_packing(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), "doc_id", "text", path, CAPACITY, END).select(
        F.col("key").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_token_files(spark, folder):
    out = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(table(spark, folder, "documents"), "doc_id", "text", path, out, END)
    return token_files.digest(spark, out).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op11_vector_packing(spark, folder):
    """Documents are examples of one part that bears loss; the sequences are as long as their pieces together."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, folder, "documents")
    found = vector_packing.pack(docs, "doc_id", [("text", True)], path, LIMITS, EXAMPLE_END)
    return found.select(
        F.col("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss"
    )


QUERIES |= {"op11_vector_packing": op11_vector_packing, "op8_packing": op8_packing, "op9_token_files": op9_token_files}
