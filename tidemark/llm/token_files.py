"""Token ids as Parquet: an integer list column, in key order, with sizes that allow selective reads.

Each row is one document: key, ``row`` (partition and place, ascending as the keys are), ``n_tokens`` and
``ids``. Ids are dictionary encoded while the dictionary of a row group fits its page, and delta packed
beyond. Row groups and pages are small and carry page indexes, so a reader that wants the lengths, or the
ids of a few keys, reads little more than that.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, partitions
from tidemark.llm.memory import released, slices
from tidemark.session import small, stage

WRITER = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


def _encode(path: str, end: int | None, names: list[str]):
    def run(batches):
        from tidemark.llm.pieces import encoder

        for batch in (part for whole in batches for part in slices(whole, [2])):
            ids = encoder(path).encode(batch.column(2).to_pylist())
            tail = 0 if end is None else 1
            sizes = np.array([len(x) + tail for x in ids], np.int64)
            flat = np.empty(int(sizes.sum()), np.int32)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            for x, a in zip(ids, edges[:-1], strict=True):
                flat[a : a + len(x)] = x
            if tail:
                flat[edges[1:] - 1] = end
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), lists], names=names)

    return released(run)


def write_tokens(df: DataFrame, key: str, text: str, path: str, out: str, end: int | None = None) -> None:
    """Encodes every whole text and writes the files to ``out``, in ascending order of ``key`` (nulls first).

    ``end`` is appended to each document. Null texts count as empty. Rows with an equal key stay separate rows
    and may be dealt over several partitions. Other columns are left out; the texts are shuffled once, by ranges.
    """
    # The id of the scanned row tells rows with an equal key apart, so that their range can be split.
    slim = df.select(
        named(df, key).alias("key"), named(df, text).cast("string").alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    dealt = slim.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order)
    placed = dealt.select("key", F.monotonically_increasing_id().alias("row"), "text")
    schema = f"key {dict(slim.dtypes)['key']}, row bigint, n_tokens bigint, ids array<int>"
    names = ["key", "row", "n_tokens", "ids"]
    placed.mapInArrow(_encode(path, end, names), schema).write.options(**WRITER).parquet(out)


def lengths(spark, out: str) -> DataFrame:
    """Key, row and token count of each document; the ids are not read."""
    return spark.read.parquet(out).select("key", "row", "n_tokens")


def with_starts(spark, out: str, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``row`` and ``n_tokens``) and ``start``: the number of ids of all documents before it.

    Counts are added up by partition first; within a partition a window runs in row order.
    """
    part = F.shiftright("row", 33)
    sums = lengths(spark, out).groupBy(part.alias("_p")).agg(F.sum("n_tokens").alias("_sum"))
    before = F.expr("coalesce(sum(_sum) over (order by _p rows between unbounded preceding and 1 preceding), 0)")
    # One row for each partition of the writing job.
    offsets = small(stage(sums.select("_p", before.alias("_before"))))
    inside = F.expr(
        "sum(n_tokens) over (partition by _part order by row rows between unbounded preceding and current row) - n_tokens"
    )
    placed = rows.withColumn("_part", part).withColumn("_inside", inside)
    joined = placed.join(offsets, placed["_part"] == offsets["_p"])
    return joined.withColumn("start", F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_p", "_before")


def read_tokens(spark, out: str) -> DataFrame:
    """key, start, n_tokens and ids of every document, from the files."""
    return with_starts(spark, out, spark.read.parquet(out)).select("key", "start", "n_tokens", "ids")


def _checksums(batches):
    for batch in batches:
        lists = batch.column(2)
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        edges = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(edges), pa.int64()), pa.array(sums, pa.int64())],
            names=["key", "row", "n_tokens", "ids_crc32"],
        )


def digest(spark, out: str) -> DataFrame:
    """key, start, n_tokens and the checksum of the ids of each document, all from the files."""
    stored = spark.read.parquet(out).select("key", "row", "ids")
    schema = f"key {dict(stored.dtypes)['key']}, row bigint, n_tokens bigint, ids_crc32 bigint"
    return with_starts(spark, out, stored.mapInArrow(_checksums, schema)).select("key", "start", "n_tokens", "ids_crc32")
