from __future__ import annotations

import os

import pytest
from brute import groups, repeats

import __spark_entry__ as driver
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


def test_every_operator_has_a_query():
    names = set(driver.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnRenamed("source", "key")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        rows = docs.collect()
        if name != "packing":
            after = {r.doc_id: r for r in rows}
            assert docs.columns == columns and len(after) == len(rows)
        texts = sorted((d, r.text) for d, r in before.items())
        if name == "language_id":
            assert set(after) == {d for d, t in texts if any(c.isalpha() for c in t or "")}
        elif name == "ngram_jaccard":
            assert set(after) == {d for d, (_, c) in groups(texts).items() if c == d}
        elif name == "suffix_dedup":
            expected = repeats(texts)
            assert {d: (r.text, r.n_chars) for d, r in after.items()} == {
                d: (t := e[4].decode("utf-8", "ignore"), len(t)) for d, e in expected.items()
            }
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            leaked = {d for d, t in texts if any(i in t for i in items)}
            assert leaked <= set(before) - set(after) and len(before) - len(after) <= len(leaked) + 2
        else:
            assert {r.doc_id for r in rows} == set(before)
            places = {(r.sequence_id, p) for r in rows for p in range(r.offset, r.offset + r.length)}
            assert len(places) == sum(r.length for r in rows) and max(p for _, p in places) < corpus_pipeline.CAPACITY
        before = after


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() == 0


def test_stages_take_nulls(spark, frame):
    docs = frame(
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
        (None, "le chat est la", None, None, None), (1, None, "fr", "s", 0), (2, "the dog is in it", "en", None, 1), (2, "the dog is in it", "en", None, 1),
        (3, "", None, "s", None),
    )
    kept = {"language_id": 3, "ngram_jaccard": 4, "suffix_dedup": 5, "decontamination": 5, "packing": 5}
    for name, stage in corpus_pipeline.STAGES:
        assert len(stage(spark, docs, FOLDER).collect()) == kept[name], name
