"""The corpus pipeline: the stages, each of which is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard, language, packing, repeats
from tidemark.llm.query_layout import CAPACITY, END
from tidemark.llm.query_text import FOLD, fold
from tidemark.session import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those without a letter go. Learned from the labelled rows outside the held-out fold."""
    model = language.learn(docs, "doc_id", "text", "lang", fold("doc_id") != FOLD)
    return language.with_language(docs, "text", model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of like documents the one with the smallest doc_id."""
    return jaccard.one_of_each_group(docs, "doc_id", "text")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages that occur earlier; ``n_chars`` follows the text.

    A document that is repeated as a whole stays, with an empty text.
    """
    found = repeats.trimmed(docs, "doc_id", "text")
    changed = {"n_chars": F.char_length("text").cast("bigint")} if "n_chars" in docs.columns else {}
    return found.withColumns(changed).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text holds no item of the benchmark, whatever their doc_id."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_texts(docs, "text", items, "item_id", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    found = packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, END)
    return found.withColumnRenamed("key", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

# Trained classifiers and tokenizers cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
