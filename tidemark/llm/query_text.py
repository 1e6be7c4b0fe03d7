"""Queries over languages, benchmark leaks and web pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_text, language
from tidemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}

FOLD = 2


def fold(key: str) -> Column:
    """One of four folds, by the checksum of the key as text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def op3_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.learn(docs, "doc_id", "text", "lang", fold("doc_id") != FOLD)
    found = language.identify(docs, "text", model)
    return found.select("doc_id", (fold("doc_id") == FOLD).alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES["op3_language_id"] = op3_language_id


def op5_decontamination(spark, folder):
    docs, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.leaks(docs, "doc_id", "text", bench, "item_id", "text")
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


def op6_html_text(spark, folder):
    pages = table(spark, folder, "pages")
    found = html_text.main_text(pages, "html", html_text.train(pages, "page_id", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


QUERIES |= {"op5_decontamination": op5_decontamination, "op6_html_text": op6_html_text}
