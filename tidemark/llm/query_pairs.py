"""Queries over near duplicates and repeated passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import jaccard, repeats
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def op10_ngram_jaccard(spark, folder):
    return jaccard.near_duplicates(table(spark, folder, "documents"), "doc_id", "text").withColumnRenamed("key", "doc_id")


QUERIES["op10_ngram_jaccard"] = op10_ngram_jaccard


def op4_suffix_dedup(spark, folder):
    found = repeats.without_repeats(table(spark, folder, "documents"), "doc_id", "text")
    return found.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES["op4_suffix_dedup"] = op4_suffix_dedup
