from __future__ import annotations

import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from brute import jump
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, sharding, token_files, tokens
from tidemark.llm.common import number_rows
from tidemark.llm.pieces import PieceEncoder, PieceTable

FILES = {name: public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json")}
LIBRARY = {name: Tokenizer.from_file(path) for name, path in FILES.items()}
ENCODERS = {name: PieceEncoder(path) for name, path in FILES.items()}
TEXTS = [
    "It's a dog's life, isn't it?  Yes\n\n we'll SEE 123 ½ x²", "", None, " ", "déjà vu, Ärger 'tis", "’curly’ œuvre İstanbul ΣΑΣ 漢字",
    "a<|endoftext|>b <|startoftext|>", "x" * 5000, "word " * 3000, "'s", "\t'\n're ''s a's", "\xa0\x85 nbsp \x1c sep",
]
ROWS = [(k, t, k * 10, "n") for k, t in enumerate(TEXTS)]
DDL = "doc_id bigint, text string, row bigint, key string"


def ids(name, text):
    return LIBRARY[name].encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab'sStTlLvVeErRdDmM  \n\r\t\x85\xa0\x1c1²½ªßÉé.,!-_ÿœ’Σ"), max_size=14), max_size=8))
def test_pieces_give_the_ids_of_the_library(name, texts):
    found = ENCODERS[name].encode(texts)
    assert [list(x) for x in found] == [ids(name, t) for t in texts]
    assert list(ENCODERS[name].counts(texts)) == [len(x) for x in found]


def test_piece_table_finds_what_was_added():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 70_000).astype(np.uint64) << np.uint64(1))
    table = PieceTable(4)
    table.add(keys[::2])
    assert (table.find(keys[::2]) == np.arange(len(keys[::2]))).all()
    assert (table.find(keys[1::2]) == -1).all()


def test_a_worker_may_forget_its_pieces():
    small = PieceEncoder(FILES["byte_bpe_50k.json"], most_pieces=3)
    for text in ("one two three four five", "six seven eight", "one two"):
        assert list(small.encode([text])[0]) == ids("byte_bpe_50k.json", text)


@pytest.mark.parametrize("name", FILES)
def test_token_counts(frame, name):
    found = tokens.token_counts(frame(DDL, *ROWS), "doc_id", "text", FILES[name]).collect()
    assert {r.key: (r.n_bytes, r.n_tokens) for r in found} == {
        k: (len((t or "").encode()), len(ids(name, t))) for k, t in enumerate(TEXTS)
    }
    assert len(found) == len(ROWS)


def test_token_counts_of_a_sentencepiece_file(frame):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    found = tokens.token_counts(frame(DDL, *ROWS), "doc_id", "text", path).collect()
    assert {r.key: r.n_tokens for r in found} == {k: len(model.encode(t or "")) for k, t in enumerate(TEXTS)}


def test_empty_tables(frame, tmp_path, spark):
    none = frame(DDL)
    path = FILES["byte_bpe_50k.json"]
    assert tokens.token_counts(none, "doc_id", "text", path).collect() == []
    assert sharding.digest(none, "doc_id", "text", 4).collect() == []
    assert packing.pack(none, "doc_id", "text", path, 16).collect() == []
    token_files.write_tokens(none, "doc_id", "text", path, str(tmp_path / "t"))
    assert token_files.digest(spark, str(tmp_path / "t")).collect() == []


def test_jump_hash_and_growth(frame):
    keys = [None, 0, 1, -1, 2**63 - 1, -(2**63), *range(5, 3000)]
    df = frame("k bigint", *[(k,) for k in keys])
    for shards in (1, 7, 16):
        rows = df.select("k", sharding.jump_hash(F.col("k"), shards).alias("a"), sharding.jump_hash(F.col("k"), shards + 1).alias("b")).collect()
        for k, a, b in rows:
            assert (a, b) == (jump(k or 0, shards), jump(k or 0, shards + 1))
            assert a == b or b == shards
    assert sharding.with_shards(frame("s string, shard int", ("a", 9), ("a", 8), (None, 7)), "s", 5).select("shard").distinct().count() <= 2


def test_shard_digest(frame):
    rows = [*ROWS, ROWS[0], ROWS[0], (None, "x", 1, "n")]
    found = sharding.digest(frame(DDL, *rows), "doc_id", "text", 3).collect()
    assert sorted((r["size"], r.text_crc32) for r in found) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows
    )
    for shard, slots in Counter(r.shard for r in found).items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(slots))


def test_number_rows_of_a_hot_group(spark):
    rows = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 3).alias("g"), "id")
    found = number_rows(rows, ["g"], ["id"], "n").orderBy("g", "id").collect()
    place = Counter()
    for r in found:
        assert r.n == place[r.g]
        place[r.g] += 1
    assert len(found) == 3000


def check_plan(counts, capacity):
    used, sequences = Counter(), {}
    for length, first, pieces, base, each, offset in packing.plan(counts, capacity):
        assert first == used[length]
        used[length] += pieces
        for r in range(pieces):
            sequences.setdefault(base + r // each, []).append((offset + r % each * length, length))
    assert used == Counter({k: v for k, v in counts.items() if v})
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 40), max_size=12))
def test_plan_places_everything_once(counts):
    check_plan(counts, 30)


def test_plan_is_tight():
    random.seed(4)
    counts = Counter(min(1024, int(random.lognormvariate(5.3, 1.2)) + 1) for _ in range(20_000))
    least = -(-sum(k * v for k, v in counts.items()) // 1024)
    assert check_plan(counts, 1024) <= least * 1.01 + 1
    assert check_plan({6: 4, 5: 2, 4: 4}, 10) == 5
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_packing_round_trip(frame):
    name = "byte_bpe_50k.json"
    rows = [*ROWS, ROWS[0]]
    packed = packing.pack(frame(DDL, *rows), "doc_id", "text", FILES[name], 64, 2, with_ids=True)
    cells = packed.collect()
    assert Counter(c.key for c in cells if c.piece == 0) == Counter(k for k, *_ in rows)
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(len(x) <= 64 for x in joined.values())
    for k, text in enumerate(TEXTS):
        whole = [*ids(name, text), 2]
        own = {c.piece: c for c in cells if c.key == k}
        assert [len(own[p].ids) for p in sorted(own)][1:] == [64] * (len(own) - 1)
        assert sum((own[p].ids for p in sorted(own)), []) == whole
        for c in own.values():
            assert c.ids == whole[c.start : c.start + c.length] and c.ids_crc32 == crc(c.ids)
    for c in cells:
        assert joined[c.sequence_id][c.offset : c.offset + c.length] == c.ids


def test_token_files_round_trip(frame, spark, tmp_path):
    name, out = "word_bpe_49k.json", str(tmp_path / "tokens")
    rows = [(k, t, 1, "z") for k, t in reversed(list(enumerate(TEXTS)))] + [(3, "again", 0, "z"), (None, "first", 0, "z")]
    token_files.write_tokens(frame(DDL, *rows), "doc_id", "text", FILES[name], out, 2)
    stored = token_files.read_tokens(spark, out).orderBy("start").collect()
    assert [r.key for r in stored] == sorted((k for k, *_ in rows), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in stored:
        assert r.start == at and len(r.ids) == r.n_tokens and r.ids[-1] == 2
        at += r.n_tokens
    assert sorted(r.ids for r in stored) == sorted([*ids(name, t), 2] for _, t, *_ in rows)
    digest = token_files.digest(spark, out).orderBy("start").collect()
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in digest] == [(r.start, r.n_tokens, crc(r.ids)) for r in stored]
    assert token_files.lengths(spark, out).columns == ["key", "row", "n_tokens"]


def test_token_files_encodings(frame, tmp_path):
    import pyarrow.parquet as pq

    out = str(tmp_path / "tokens")
    token_files.write_tokens(frame(DDL, *ROWS), "doc_id", "text", FILES["word_bpe_49k.json"], out)
    file = next(p for p in Path(out).glob("*.parquet") if pq.read_metadata(p).num_rows)
    column = pq.read_metadata(file).row_group(0).column(3)
    assert column.path_in_schema.startswith("ids") and column.compression == "ZSTD"
    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)
    assert column.has_offset_index
