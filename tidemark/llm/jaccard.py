"""Documents whose sets of word n-grams are alike (Jaccard), and the groups that such links form.

The overlap of two documents is an entry of the product of the document-by-n-gram incidence matrix with
its transpose. It is never formed as a whole. Rows that are equal are one row (a class). Two sets that are
alike overlap in at least ``t`` of the larger one, so in one common order of all n-grams they share one of
the first ``n - ceil(t * n) + 1`` of each (its prefix), and only these columns enter the product.

The order has rare n-grams first. For a fixed share of all n-grams (by their hash) the columns are formed
and counted; an n-gram that occurs once cannot be shared, so it only takes up a place of the prefix. Those
left follow by their counts, then the n-grams outside the share. A set with enough n-grams of its own has
an empty prefix.

A column connects two of its classes only if their sizes and their places in it allow the overlap that they
need: else a few common n-grams would chain nearly everything together, and the more so the larger the input.
The classes that columns connect form blocks of rows; a class can be like those of its block only. The
product is taken block by block: within a task the overlaps of its classes are added up from their whole
sets, as a dense product for n-grams of many classes and pair by pair for the others. Pairs below the bound
that their sizes set are discarded. Large blocks are cut, and each pair of parts is a task. A task returns
no pairs but a forest that connects what is linked, since groups are what is asked for.

A count sketch of fixed size tells which columns are very long; these are dealt over several tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytes_of import utf8
from tidemark.llm.common import named, own, partitions
from tidemark.llm.components import components
from tidemark.llm.keyset import KeySet, key_set
from tidemark.llm.memory import released, slices
from tidemark.session import small, stage

PERCENT = 75
# Share of all n-grams whose columns are counted; above 1 - PERCENT / 100, so that frequent ones can be passed over.
SHARE = 0.35
SKETCH_BITS = 20
_SKETCH_BLOCK = 4096
# A column with more classes than this is dealt over several tasks.
COLUMN_ROWS = 4096
# Classes of a part of a block; a task has two parts at most.
BLOCK_ROWS = 1024
# N-grams of so many classes of a task enter its dense product, so many at a time.
DENSE_FROM = 12
# Columns of more members than this are connected one by one, others many at a time.
_FEW = 64
_CELLS = 1 << 20
_DENSE_COLUMNS = 512
_SEEN = 100_000
_LIMIT = np.uint64(int(SHARE * 2**32) << 32)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sids(sets: list[np.ndarray]) -> list[bytes]:
    """128-bit ids of sets; their first half is the node under which a set is looked up."""
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]


def _nodes(sids: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(s[:8] for s in sids), np.int64)


def _classes(batches):
    from tidemark.llm.shingles import shingle_sets

    for batch in (part for whole in batches for part in slices(whole, [1])):
        sets = shingle_sets(*utf8(batch.column(1)))
        sids = _sids(sets)
        counted = [int(np.searchsorted(s, _LIMIT)) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.binary()), pa.array(_nodes(sids), pa.int64()),
             pa.array(counted, pa.int64())],
            names=["key", "n", "sid", "node", "counted"],
        )


def _sketch(batches):
    from tidemark.llm.shingles import shingle_sets

    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in (part for whole in batches for part in slices(whole, [0])):
        sets = shingle_sets(*utf8(batch.column(0)))
        if sets:
            counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
    blocks = counts.reshape(-1, _SKETCH_BLOCK)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"]
    )


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_SKETCH_BLOCK, np.int64)
    for cell in frame["counts"]:
        total += np.frombuffer(cell, np.int64)
    return pd.DataFrame({"block": [frame["block"].iloc[0]], "counts": [total.tobytes()]})


def count_sketch(texts: DataFrame) -> np.ndarray:
    """In how many texts the n-grams of each of 2^SKETCH_BITS cells occur; its size does not depend on the input."""
    schema = "block int, counts binary"
    # Two steps, so that no task holds the cells of all scan tasks.
    cells = texts.mapInArrow(released(_sketch), schema).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    cells = cells.groupBy("block", "_salt").applyInPandas(_add, schema).groupBy("block").applyInPandas(_add, schema)
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in cells.collect():
        total[r["block"] * _SKETCH_BLOCK : (r["block"] + 1) * _SKETCH_BLOCK] = np.frombuffer(r["counts"], np.int64)
    return total


def _columns(sketch, percent: int):
    """The entries of the counted columns: n-gram, node, and (for long columns) estimated length and salt in one number."""

    def run(batches):
        from tidemark.llm.shingles import shingle_sets

        counts = sketch.value
        usual = 2 * counts.mean() + 16
        salts = 1 + np.maximum(0, counts - usual).astype(np.int64) // COLUMN_ROWS
        seen: set[int] = set()
        for batch in (part for whole in batches for part in slices(whole, [0])):
            sets = shingle_sets(*utf8(batch.column(0)))
            grams, owner, about = [], [], []
            for s, node in zip(sets, _nodes(_sids(sets)), strict=True):
                # Equal sets of one task are one class already here.
                if not len(s) or int(node) in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(int(node))
                n = len(s)
                # All of the counted share, and further ones in order of hash if these are fewer than the prefix.
                first = s[: max(n - -(-percent * n // 100) + 1, int(np.searchsorted(s, _LIMIT)))]
                cell = (first >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                parts = salts[cell]
                mixed = (first ^ np.uint64(node & 0x7FFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                grams.append(first)
                owner.append(np.full(len(first), node))
                about.append(np.where(parts > 1, counts[cell] << 24 | np.minimum(1 + mixed.astype(np.int64) % parts, (1 << 24) - 1), 0))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(grams)), pa.array(np.concatenate(owner)), pa.array(np.concatenate(about))],
                    names=["gram", "node", "about"],
                )

    return run


def _prefixes(entries: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The columns that enter the product: the prefix of each class, without what occurs once.

    (gram, node, n, left): the size of the class, and how many of its n-grams there are from this one on, or more.
    """
    column = Window.partitionBy("gram", "about")
    counted = entries.withColumn("lo", F.min("node").over(column)).withColumn("hi", F.max("node").over(column))
    counted = counted.withColumn("size", F.count(F.lit(1)).over(column)).where("lo <> hi or about > 0")
    counted = counted.select("gram", "node", F.when(F.col("about") > 0, F.shiftright("about", 24)).otherwise(F.col("size")).alias("size"))
    # A class that several tasks have met is in a column once. The counts hold it as often, which is all the same: the
    # order only has to be the same for everybody.
    counted = counted.distinct()
    late = (F.shiftrightunsigned("gram", 32) >= F.lit(int(_LIMIT) >> 32)).cast("int")
    # The order of the n-grams outside the share is that of their hashes, unsigned, in which ``_columns`` has chosen them.
    own_order = Window.partitionBy("node").orderBy(late, F.when(late == 0, F.col("size")), F.col("gram").bitwiseXOR(F.lit(-(2**63))))
    ranked = counted.withColumn("late", late).withColumn("rank", F.row_number().over(own_order) - 1)
    ranked = ranked.withColumn("early", F.sum(F.lit(1) - F.col("late")).over(Window.partitionBy("node")))
    sizes = sizes.withColumnRenamed("node", "_node")
    joined = ranked.join(sizes, ranked["node"] == sizes["_node"])
    # Before the shared n-grams of the share come those that occur once. Outside of it this is a lower bound.
    place = F.col("rank") + F.col("counted") - F.col("early")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return joined.where(place < prefix).select("gram", "node", "n", (F.col("n") - place).alias("left"))


def _connected(need: np.ndarray, may: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Of columns with as many members each: the first member that each member is connected with, or itself.

    Two members fit if either's ``may`` reaches the other's ``need``, and, with equal needs, if they are ``same``.
    """
    fits = may[:, :, None] >= need[:, None, :]
    fits &= fits.transpose(0, 2, 1)
    fits &= (need[:, :, None] != need[:, None, :]) | same[:, :, None]
    first = np.broadcast_to(np.arange(need.shape[1]), need.shape)
    while True:
        after = np.minimum(first, np.where(fits, first[:, None, :], need.shape[1]).min(2))
        after = np.take_along_axis(after, after, 1)
        if (after == first).all():
            return after
        first = after


def _connected_one(need: np.ndarray, may: np.ndarray, same: np.ndarray) -> np.ndarray:
    """``_connected`` for one column of any length, without a matrix."""
    first, rest = np.arange(len(need)), np.arange(len(need))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        todo = [seed]
        while todo and len(rest):
            x = todo.pop()
            fits = (need[rest] <= may[x]) & (may[rest] >= need[x]) & ((need[rest] != need[x]) | same[x])
            if fits.any():
                first[rest[fits]] = seed
                todo += rest[fits].tolist()
                rest = rest[~fits]
    return first


def _ties(percent: int):
    """Rows sorted by column and node, one for each size and place there: those that are connected, and the least node of their part."""

    def found(gram, n, left, node, times) -> pa.RecordBatch:
        need = percent * n
        # The overlap is ``left`` at most, and it has to be ``percent`` / (100 + ``percent``) of both sizes together.
        may = (100 + percent) * left - need
        # Sets of one size that are not equal differ in an n-gram.
        same = (100 + percent) * (n - 1) >= 2 * need
        edges = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1], [True]]))
        starts, sizes = edges[:-1], np.diff(edges)
        first = np.arange(len(gram))
        for size in np.unique(sizes[(sizes > 1) & (sizes <= _FEW)]).tolist():
            own = starts[sizes == size]
            step = max(1, _CELLS // size**2)
            for at in range(0, len(own), step):
                rows = own[at : at + step, None] + np.arange(size)
                first[rows] = own[at : at + step, None] + _connected(need[rows], may[rows], same[rows])
        for start, size in zip(starts[sizes > _FEW].tolist(), sizes[sizes > _FEW].tolist(), strict=True):
            part = slice(start, start + size)
            first[part] = start + _connected_one(need[part], may[part], same[part])
        alone = (np.bincount(first, minlength=len(first)) == 1)[first]
        rows = np.flatnonzero(~alone | (times > 1) & same & (may >= need))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (gram[rows], n[rows], left[rows], node[first[rows]])], names=["_gram", "_n", "_left", "first"])

    def run(batches):
        held = None
        for batch in batches:
            more = [c.to_numpy() for c in batch.columns]
            held = [np.concatenate(pair) for pair in zip(held, more, strict=True)] if held else more
            # The last column may go on.
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole:
                yield found(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held and len(held[0]):
            yield found(*held)

    return run


def _stars(entries: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the classes of each column which may be alike by their sizes and places."""
    # Members of one size and place fit the same others, so a task has one row for all of them.
    kinds = entries.groupBy("gram", "n", "left").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("times"))
    kinds = kinds.select("gram", "n", "left", "node", "times").repartition(partitions(entries), "gram").sortWithinPartitions("gram", "node")
    ties = kinds.mapInArrow(released(_ties(percent)), "_gram bigint, _n bigint, _left bigint, first bigint")
    star = entries.join(ties, (F.col("gram") == F.col("_gram")) & (F.col("n") == F.col("_n")) & (F.col("left") == F.col("_left")))
    return star.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()


def _blobs(wanted: KeySet):
    """The texts whose node may be wanted, compressed, under the id of their set."""

    def run(batches):
        import zstandard

        from tidemark.llm.shingles import shingle_sets

        pack, seen = zstandard.ZstdCompressor(3), set()
        for batch in (part for whole in batches for part in slices(whole, [0])):
            data, edges = utf8(batch.column(0))
            sids = _sids(shingle_sets(data, edges))
            rows = [int(k) for k in np.flatnonzero(wanted.may_hold(_nodes(sids)))] if sids else []
            # One text of a set is enough.
            rows = [k for k in rows if sids[k] not in seen and not seen.add(sids[k])]
            if len(seen) > _SEEN:
                seen.clear()
            chosen = [sids[k] for k in rows]
            cells = [pack.compress(data[edges[k] : edges[k + 1]].tobytes()) for k in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chosen, pa.binary()), pa.array(_nodes(chosen), pa.int64()), pa.array(cells, pa.binary())], names=["sid", "node", "blob"]
            )

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The overlap of every two sets: the incidence matrix times its transpose."""
    m = len(sets)
    total = np.zeros((m, m), np.int32)
    grams = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    owner = np.repeat(np.arange(m), [len(s) for s in sets])[order]
    edges = np.flatnonzero(np.concatenate([[True], grams[order][1:] != grams[order][:-1], [True]])) if len(grams) else np.zeros(1, np.int64)
    starts, sizes = edges[:-1], np.diff(edges)
    for size in range(2, DENSE_FROM):
        rows = owner[starts[sizes == size][:, None] + np.arange(size)]
        for a in range(size if len(rows) else 0):
            for b in range(a + 1, size):
                np.add.at(total, (rows[:, a], rows[:, b]), 1)
    dense = np.flatnonzero(sizes >= DENSE_FROM)
    for at in range(0, len(dense), _DENSE_COLUMNS):
        part = dense[at : at + _DENSE_COLUMNS]
        block = np.zeros((m, len(part)), np.float32)
        # Whole numbers below 2^24 are exact here, and a part has far fewer columns.
        block[np.concatenate([owner[starts[c] : starts[c] + sizes[c]] for c in part]), np.repeat(np.arange(len(part)), sizes[part])] = 1
        total += np.triu(block @ block.T, 1).astype(np.int32)
    return total + total.T


def forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is alike among the sets: of each group its first member with each other one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    common = overlaps(sets).astype(np.int64)
    linked = (100 * common >= percent * (sizes[:, None] + sizes - common)) & (common > 0)
    left, out = linked.any(1), []
    for seed in np.flatnonzero(left):
        if not left[seed]:
            continue
        group = np.zeros(len(sets), bool)
        edge = np.array([seed])
        group[seed] = True
        while len(edge):
            edge = np.flatnonzero(linked[edge].any(0) & ~group)
            group[edge] = True
        left &= ~group
        out += [(int(seed), int(k)) for k in np.flatnonzero(group) if k != seed]
    return out


def _products(percent: int):
    """Rows sorted by task (block, two parts): the links of each task's classes."""

    def run(batches):
        import zstandard

        from tidemark.llm.shingles import shingle_sets

        unpack = zstandard.ZstdDecompressor()

        def links(sids: list[bytes], texts: list[bytes]) -> pa.RecordBatch:
            edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            sets = shingle_sets(np.frombuffer(b"".join(texts) + bytes(16), np.uint8), edges)
            found = forest(sets, percent)
            ends = [pa.array([sids[pair[side]] for pair in found], pa.binary()) for side in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        at, sids, texts = None, [], []
        for batch in batches:
            for *task, sid, blob in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if task != at:
                    if len(sids) > 1:
                        yield links(sids, texts)
                    at, sids, texts = task, [], []
                sids.append(sid)
                texts.append(unpack.decompress(blob))
        if len(sids) > 1:
            yield links(sids, texts)

    return run


def _links(texts: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the alike sets of the product's columns."""
    blocks = components(stage(_stars(entries, percent)))
    parts = blocks.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    rows = blocks.join(parts, "comp").withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = stage(rows.select(F.col("comp").alias("block"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.col("node").alias("want")))
    asked = stage(rows.select("want").distinct())
    blobs = texts.mapInArrow(released(_blobs(key_set(asked.select(F.col("want").alias("h"))))), "sid binary, node bigint, blob binary")
    blobs = blobs.join(asked, blobs["node"] == asked["want"], "left_semi")
    blobs = stage(blobs.dropDuplicates(["sid"]))
    rows = rows.join(blobs, rows["want"] == blobs["node"]).select("block", "low", "high", "sid", "blob")
    rows = rows.repartition(partitions(rows), "block", "low", "high").sortWithinPartitions("block", "low", "high", "sid")
    return rows.mapInArrow(released(_products(percent)), "a binary, b binary").distinct()


def _labelled(df: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(key, n, sid, comp) of each row: its number of shingles, the id of their set and the least id of its group, if it has any."""
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"))
    texts = slim.select("text")
    kind = dict(slim.dtypes)["key"]
    rows = stage(slim.mapInArrow(released(_classes), f"key {kind}, n bigint, sid binary, node bigint, counted bigint"))
    sketch = df.sparkSession.sparkContext.broadcast(count_sketch(texts))
    entries = texts.mapInArrow(released(_columns(sketch, percent)), "gram bigint, node bigint, about bigint")
    sizes = rows.groupBy("node").agg(F.min("n").alias("n"), F.min("counted").alias("counted"))
    entries = stage(_prefixes(entries, sizes, percent))
    found = components(stage(_links(texts, entries, percent)))
    labelled = rows.join(found.withColumnRenamed("node", "_sid"), F.col("sid") == F.col("_sid"), "left")
    return stage(labelled.select("key", "n", "sid", F.when(F.col("n") > 0, F.coalesce("comp", "sid")).alias("comp")))


def near_duplicates(df: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles and component_id of each row: the smallest key that links reach from it.

    Two texts link when 100 * |A and B| >= percent * |A or B| for their sets of five-word shingles; texts
    with equal sets link. A null text, or one without a word, has no shingle and no link; its component is
    its own key. Rows with a null key link as others do and get the smallest key of their group, null if
    there is none. Repeated rows are kept. Other columns are left out.
    """
    labelled = _labelled(df, key, text, percent)
    smallest = labelled.where("comp is not null").groupBy(F.col("comp").alias("_comp")).agg(F.min("key").alias("least"))
    out = labelled.join(smallest, F.col("comp") == F.col("_comp"), "left")
    return out.select("key", F.col("n").alias("n_shingles"), F.when(F.col("comp").isNull(), F.col("key")).otherwise(F.col("least")).alias("component_id"))


def _set_ids(batches):
    """The rows with the size and the id of the shingle set of their last column, in place of that column."""
    from tidemark.llm.shingles import shingle_sets

    for batch in (part for whole in batches for part in slices(whole, [whole.num_columns - 1])):
        sets = shingle_sets(*utf8(batch.column(batch.num_columns - 1)))
        made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(_sids(sets), pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], "n", "sid"])


def one_of_each_group(df: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest key, and of the least set and text among rows of that key.

    It is decided for each row, so rows of one key with different texts stay as long as no other row is like them; a row with a
    null key stays only where no row of its group has a key. A text without a word is in no group: equal rows of one key are
    one, and those with a null key stay. The texts are shuffled only where the keys to leave out are too many to broadcast.
    """
    found = _labelled(df, key, text, percent)
    twice = found.where("key is not null").groupBy(F.col("key").alias("_twice")).agg(F.count(F.lit(1)).alias("times"))
    twice = small(stage(twice.where("times > 1").select("_twice")))
    first = found.where("n > 0").groupBy(F.col("comp").alias("_comp")).agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "sid")).alias("first"))
    first = stage(first)
    judged = found.join(first, F.col("comp") == F.col("_comp"))
    out = small(stage(judged.where(F.col("key") != F.col("first.key")).select(F.col("key").alias("_out")).distinct()))
    keyed = df.where(named(df, key).isNotNull())
    rows = keyed.join(twice, named(keyed, key) == twice["_twice"], "left_anti")
    rows = rows.join(out, named(rows, key) == out["_out"], "left_anti")
    # Rows whose key is not theirs alone are told apart by their sets.
    several = keyed.join(twice, named(keyed, key) == twice["_twice"], "left_semi").unionByName(df.where(named(df, key).isNull()))
    size, sid = own(df, "_n"), own(df, "_sid")
    schema = T.StructType([*several.schema.fields, T.StructField(size, T.LongType()), T.StructField(sid, T.BinaryType())])
    several = several.select("*", named(several, text).cast("string").alias(own(df, "_text"))).mapInArrow(released(_set_ids), schema)
    kept = first.select(F.col("first.key").alias("_key"), F.col("first.sid").alias("_first"))
    kept = kept.join(twice, F.col("_key") == F.col("_twice"), "left_semi").unionByName(kept.where("_key is null"))
    kept = small(stage(kept))
    k, worded = named(several, key), named(several, size) > 0
    grouped = several.where(worded).join(kept, k.eqNullSafe(kept["_key"]) & (named(several, sid) == kept["_first"]), "left_semi")
    bare = several.where(~worded)
    for part, same in ((grouped, [key, sid]), (bare.where(k.isNotNull()), [key, text])):
        place = F.row_number().over(Window.partitionBy(*[named(part, c) for c in same]).orderBy(named(part, text)))
        rank = own(part, "_rank")
        part = part.withColumn(rank, place).where(F.col(rank) == 1)
        rows = rows.unionByName(part.select(*[named(part, c) for c in df.columns]))
    return rows.unionByName(bare.where(k.isNull()).select(*[named(bare, c) for c in df.columns]))
