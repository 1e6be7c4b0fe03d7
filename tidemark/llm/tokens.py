"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a broadcast table of frequent pieces: a 64-bit hash and a token count each. Tier two is the
cache of the worker, which encodes a piece by the library when it meets it for the first time. No piece
is ever shuffled, and which pieces are in which tier has no influence on the counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named
from tidemark.llm.memory import released, slices

# Bounds of tier one: rows that are looked at, and pieces that are broadcast (12 bytes each).
SAMPLE_ROWS = 2_000
FREQUENT = 65_536

_ENCODERS: dict = {}


def _strings(column: pa.Array) -> list:
    return column.to_pylist()


def _count_pieces(path: str, keep: int):
    """Of the texts of a task: the hashes, token counts and occurrences of its most frequent pieces."""

    def run(batches):
        from tidemark.llm.pieces import PieceEncoder

        encoder, seen = PieceEncoder(path), None
        for batch in (part for whole in batches for part in slices(whole, [0])):
            texts = [t for t in _strings(batch.column(0)) if t]
            for easy, _ in encoder._sorted_out(texts):
                if easy:
                    found, _ = encoder._pieces(encoder._lower([texts[k] for k in easy]))
                    now = np.bincount(found, minlength=encoder.table.count)
                    seen = now if seen is None else np.pad(seen, (0, len(now) - len(seen))) + now
        if seen is not None:
            used = np.flatnonzero(encoder.table.values >= 0)
            number = encoder.table.values[used]
            top = np.argsort(-seen[number], kind="stable")[:keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in (
                    encoder.table.keys[used][top], encoder.lengths[number][top], seen[number][top].astype(np.int64)
                )], names=["keys", "lengths", "seen"],
            )

    return run


def frequent_pieces(df: DataFrame, key: str, text: str, path: str, sample_rows: int = SAMPLE_ROWS, keep: int = FREQUENT):
    """Hashes and token counts of frequent pieces, from about ``sample_rows`` rows chosen by a hash of their key."""
    total = df.count()
    every = max(1, -(-total // sample_rows))
    chosen = df.where(F.pmod(F.xxhash64(named(df, key)), F.lit(every)) == 0).select(named(df, text).cast("string").alias("text"))
    parts = chosen.mapInArrow(released(_count_pieces(path, keep)), "keys binary, lengths binary, seen binary").collect()
    keys = np.concatenate([np.frombuffer(p.keys, np.uint64) for p in parts] or [np.zeros(0, np.uint64)])
    lengths = np.concatenate([np.frombuffer(p.lengths, np.int32) for p in parts] or [np.zeros(0, np.int32)])
    seen = np.concatenate([np.frombuffer(p.seen, np.int64) for p in parts] or [np.zeros(0, np.int64)])
    new, first, back = np.unique(keys, return_index=True, return_inverse=True)
    top = np.argsort(-np.bincount(back, seen, len(new)), kind="stable")[:keep]
    return new[top], lengths[first][top]


def token_counts(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of each row, by the library of the file at ``path``.

    A ``.json`` file is for tokenizers, a ``.model`` file for sentencepiece; no begin, end or other special
    token is added, nothing is cut off. Special strings inside a text count as the library's default has it.
    Null texts count as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows; other columns are left out.
    The path must be readable on every worker.
    """
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"))
    schema = f"key {dict(slim.dtypes)['key']}, n_bytes bigint, n_tokens bigint"
    known = None
    if path.endswith(".json"):
        known = df.sparkSession.sparkContext.broadcast(frequent_pieces(df, key, text, path))

    def run(batches):
        counts = _counter(path, known)
        for batch in (part for whole in batches for part in slices(whole, [1])):
            texts = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counts(_strings(texts)), pa.int64())], names=["key", "n_bytes", "n_tokens"]
            )

    return slim.mapInArrow(released(run), schema)


def _counter(path: str, known):
    import pyarrow.compute  # noqa: F401  used by the caller in the worker

    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(model.encode(t)) if t else 0 for t in texts]
    name = (path, known.id if hasattr(known, "id") else id(known))
    if name not in _ENCODERS:
        from tidemark.llm.pieces import PieceEncoder

        keys, lengths = known.value
        encoder = PieceEncoder(path)
        encoder.known(keys, lengths)
        _ENCODERS.clear()
        _ENCODERS[name] = encoder
    return _ENCODERS[name].counts
