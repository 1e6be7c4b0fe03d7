"""Query over the periodic runs of the documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm import runs
from tidemark.llm.common import table

QUERIES: dict = {}
# The runs of a text are found by comparing it with itself at every distance, which SQL cannot do on whole
# tables in time; tests hold the query against a brute-force version.
ORACLES: dict = {}

BLANKS = r"[\x20\x09-\x0D]+"


def with_planted_runs(key: Column, text: Column) -> Column:
    """The text, or for a tenth of the keys its words up to a place that the key sets, and then a period of them repeated.

    A text without a word, or of a row without a key, stays as it is.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")

    def turned(found: Column) -> Column:
        n = F.size(found).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(found, place(i).cast("int"))), " ")

    # The one element of an array is a way to name the words, so that the text is split once.
    planted = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, turned(w))), 1)
    return F.when(h % 10 == 0, F.coalesce(planted, text)).otherwise(text)


def op12_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.periodic_runs(docs, "doc_id", "text")
    order = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(order)
    length, period = -best["length"], best["period"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        F.col("key").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES["op12_periodic_runs"] = op12_periodic_runs
