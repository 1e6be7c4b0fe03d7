"""Query over token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}

LIMIT = 2048


def op1_token_counts(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = tokens.token_counts(table(spark, folder, "documents"), "doc_id", "text", path)
    return found.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


QUERIES["op1_token_counts"] = op1_token_counts
