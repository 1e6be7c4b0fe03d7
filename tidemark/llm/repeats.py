"""Bytes that lie in a string of a given length which also starts earlier in the corpus.

Sorting all suffixes by their first ``length`` bytes puts repeated windows into equal groups. The sort is
a radix sort from the most significant digit, and a suffix leaves it as soon as its group has one member.

Digit one, the bytes of an anchor. Of the ``gram``-byte strings inside a window, the one with the least
hash is its anchor, so equal windows have equal anchors at the same offset. Neighbouring windows mostly
share their anchor, which turns some thirty suffixes into one entry; anchors that occur once end here.
Digit two, all bytes that the windows of an entry cover. Where they are equal, every window of the later
entry is repeated. Only the first entry of each such class goes on, if its anchor has other classes.
Digit three, the anchor and half of the bytes that are left, on the one or the other side.
Digit four, the rest of the window. Windows that are equal here are equal in all ``length`` bytes.

Equality is that of hashes: 128 bits of two independent hashes for digits one and two together, 64 bits
and the remaining bytes themselves for the last two.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytes_of import chunks, utf8
from tidemark.llm.common import named, partitions
from tidemark.llm.keyset import KeySet, key_set
from tidemark.llm.memory import released, slices
from tidemark.llm.pieces import _mix
from tidemark.session import small, stage

LENGTH = 100
GRAM = 32
_TILE = 500_000
# Texts whose equal entries are found before the shuffle, in bytes.
BATCH_BYTES = 8_000_000
# Classes of one anchor in a batch beyond which they are dealt out by class.
ANCHOR_ROWS = 64
# Entries of one third digit beyond which every window is dealt out on its own.
DIGIT_ROWS = 512
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)
REPEATED, PLAIN, OPEN = 0, 1, 2
_POWERS: list[np.ndarray] = []
_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _TILE + 4096)
        found = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    step, total = 1, len(x) - width + 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:total], x[width - step : width - step + total])


def entries(data: np.ndarray, edges: np.ndarray, length: int, gram: int):
    """Of joined texts: text, anchor hash, class hash, first window, last window, anchor (places in the text)."""
    width = length - gram + 1
    parts = []
    for a, b in chunks(edges, _TILE):
        begin, end = int(edges[a]), int(edges[b])
        # A text that is longer than a tile is read in tiles that overlap by a window.
        for at in range(begin, max(begin + 1, end), _TILE) if end - begin > _TILE + 4096 else (begin,):
            stop = min(end, at + _TILE + length - 1) if end - begin > _TILE + 4096 else end
            n = stop - at
            if n < length:
                continue
            power, inverse = _powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_CODES[data[at:stop]] * power[:n], out=sums[1:])
            grams = _mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
            order = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
            anchor = (_PLACE - (_least(order, width) & _PLACE)).astype(np.int64)
            turn = np.zeros(n + 1, np.int8)
            first = np.maximum(edges[a:b], at) - at
            last = np.minimum(edges[a + 1 : b + 1], stop) - at - length + 1
            fits = last > first
            turn[first[fits]] += 1
            turn[last[fits]] -= 1
            windows = np.flatnonzero(np.cumsum(turn[:-1], dtype=np.int8))
            if not len(windows):
                continue
            own = anchor[windows]
            change = np.flatnonzero((own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
            lo, hi = windows[np.concatenate([[0], change])], windows[np.concatenate([change - 1, [len(windows) - 1]])]
            own = own[np.concatenate([[0], change])]
            span = _mix((sums[hi + length] - sums[lo]) * inverse[lo] ^ _mix((hi - lo).astype(np.uint64) + np.uint64(77)))
            text = np.searchsorted(edges, lo + at, "right") - 1
            shift = at - edges[text]
            parts.append((text, grams[own], span, lo + shift, hi + shift, own + shift))
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _pack(lo, hi, anchor, kind):
    """First window, further windows (7 bits), anchor behind the first window (7 bits) and kind (2 bits) in a long."""
    return lo << 16 | (hi - lo) << 9 | (anchor - lo) << 2 | kind


def _unpack(place):
    lo = place >> 16
    return lo, lo + (place >> 9 & 127), lo + (place >> 2 & 127), place & 3


def _find(length: int, gram: int):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, [2], BATCH_BYTES)):
            text, digit, span, lo, hi, anchor = entries(*utf8(batch.column(2)), length, gram)
            if not len(text):
                continue
            docs = pa.table({"k": batch.column(0), "t": batch.column(1)})
            rank = np.empty(batch.num_rows, np.int64)
            rank[pa.compute.sort_indices(docs, [("k", "ascending"), ("t", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(rank))
            # Equal entries of this batch: all but the earliest are repeated, whatever the other batches hold.
            kind = np.full(len(text), PLAIN)
            both = _mix(digit * np.uint64(3) + span)
            order = np.argsort(both, kind="stable")
            same = both[order[1:]] == both[order[:-1]]
            member = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
            rows = order[member]
            rows = rows[np.lexsort((lo[rows], rank[text[rows]], both[rows]))]
            later = rows[1:][both[rows[1:]] == both[rows[:-1]]]
            kind[later] = REPEATED
            digit = digit.copy()
            # They pass on to any task.
            digit[later] = _mix(both[later] + np.arange(len(later), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
            rest = np.flatnonzero(kind == PLAIN)
            value, first, back, count = np.unique(digit[rest], return_index=True, return_inverse=True, return_counts=True)
            crowded = rest[count[back] > ANCHOR_ROWS]
            extra = rest[first[count > ANCHOR_ROWS]]
            place = _pack(lo, hi, anchor, kind)
            columns = [digit, span, text, place]
            if len(crowded):
                # One of them stays with the anchor, as a witness for the other batches.
                witness = [c[extra] for c in columns]
                digit[crowded] = both[crowded]
                place[crowded] += OPEN - PLAIN
                columns = [np.concatenate(pair) for pair in zip(columns, witness, strict=True)]
            digit, span, text, place = columns
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digit.view(np.int64)), pa.array(span.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array(place)],
                names=["digit", "span", "key", "tid", "place"],
            )

    return run


def _sort_out(batches):
    """Sorted entries: repeated ones (kind 0) and the first of each class where an anchor has several (kind 2)."""
    last, pending = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        digit, span, place = (batch.column(k).to_numpy() for k in (0, 1, 4))
        kind = place & 3
        before = np.concatenate([[last[0] if last else digit[0] ^ 1], digit[:-1]])
        spans = np.concatenate([[last[1] if last else 0], span[:-1]])
        same = digit == before
        equal = same & (span == spans)
        further = same & ~equal
        group = np.cumsum(~same)
        several = np.bincount(group, further, group[-1] + 1) > 0
        head = np.flatnonzero(~same)
        plain = kind != REPEATED
        opened = (further | (kind == OPEN)) & ~equal
        opened[head] |= several[group[head]]
        opened &= plain
        out = [(batch, np.flatnonzero(equal | ~plain), REPEATED), (batch, np.flatnonzero(opened), OPEN)]
        if pending is not None and several[0]:
            out.append((pending, np.zeros(1, np.int64), OPEN))
            pending = None
        if group[-1] > 0:
            tail = int(head[-1])
            pending = None if several[-1] or opened[tail] or not plain[tail] else batch.slice(tail, 1)
        last = int(digit[-1]), int(span[-1])
        for source, rows, what in out:
            if len(rows):
                at = pa.array(rows)
                places = source.column(4).to_numpy()[rows]
                yield pa.RecordBatch.from_arrays(
                    [source.column(2).take(at), source.column(3).take(at), pa.array(places >> 2 << 2 | what)], names=["key", "tid", "place"]
                )


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _contents(length: int, gram: int):
    """For each open entry: the third digit and the bytes around it, for windows that reach far to the right or to the left."""
    half = (length - gram) // 2

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            digits, owner, firsts, offsets, rests = [], [], [], [], []
            for k, (blob, places) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                data = unpack.decompress(blob)
                for place in sorted(set(places)):
                    lo, hi, anchor, _ = _unpack(place)
                    # Windows that start at most ``half`` before the anchor share what follows it, the others what precedes it.
                    for a, b, mid, side in (
                        (max(lo, anchor - half), hi, (anchor, anchor + gram + length - gram - half), b"R"),
                        (lo, min(hi, anchor - half - 1), (anchor - half - 1, anchor + gram), b"L"),
                    ):
                        if a <= b:
                            digits.append(_hash(side + data[mid[0] : mid[1]]))
                            owner.append(k)
                            firsts.append(a)
                            offsets.append(anchor - a)
                            rests.append(data[a : mid[0]] + data[mid[1] : b + length])
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digits, pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(firsts, pa.int64()),
                 pa.array(offsets, pa.int32()), pa.array(rests, pa.binary())],
                names=["digit", "key", "tid", "first", "before", "rest"],
            )

    return run


def _rest(length: int, gram: int) -> tuple[int, int]:
    """How many bytes of a window are outside the third digit: right-hand windows, left-hand windows."""
    half = (length - gram) // 2
    return half, length - gram - half - 1


def _deal(length: int, gram: int):
    """Entries of a crowded third digit become one row for each window, under a digit of its own."""
    right, left = _rest(length, gram)
    half = (length - gram) // 2

    def run(batches):
        for batch in batches:
            rows, digits, firsts, befores, rests = [], [], [], [], []
            columns = [batch.column(k).to_pylist() for k in (0, 3, 4, 5, 6)]
            for k, (digit, first, before, rest, crowded) in enumerate(zip(*columns, strict=True)):
                if crowded is None:
                    rows.append(k)
                    digits.append(digit)
                    firsts.append(first)
                    befores.append(before)
                    rests.append(rest)
                    continue
                size = right if before <= half else left
                for j in range(len(rest) - size + 1):
                    rows.append(k)
                    part = rest[j : j + size]
                    digits.append(_hash(digit.to_bytes(8, "little", signed=True) + (before - j).to_bytes(4, "little", signed=True) + part))
                    firsts.append(first + j)
                    befores.append(before - j)
                    rests.append(part)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digits, pa.int64()), batch.column(1).take(at), batch.column(2).take(at), pa.array(firsts, pa.int64()),
                 pa.array(befores, pa.int32()), pa.array(rests, pa.binary())],
                names=["digit", "key", "tid", "first", "before", "rest"],
            )

    return run


def _resolve(length: int, gram: int):
    """Rows sorted by (digit, key, tid, first): the windows whose rest was met before under the same digit and offset."""
    right, left = _rest(length, gram)
    half = (length - gram) // 2

    def run(batches):
        at, seen = None, set()
        for batch in batches:
            rows, lows, highs = [], [], []
            columns = [batch.column(k).to_pylist() for k in (0, 3, 4, 5)]
            for k, (digit, first, before, rest) in enumerate(zip(*columns, strict=True)):
                if digit != at:
                    at, seen = digit, set()
                size = right if before <= half else left
                begin = None
                for j in range(len(rest) - size + 1):
                    window = (before - j, rest[j : j + size])
                    if window in seen:
                        if begin is None:
                            begin = j
                        continue
                    seen.add(window)
                    if begin is not None:
                        rows.append(k)
                        lows.append(first + begin)
                        highs.append(first + j - 1)
                        begin = None
                if begin is not None:
                    rows.append(k)
                    lows.append(first + begin)
                    highs.append(first + len(rest) - size)
            at_ = pa.array(rows, pa.int64())
            lo, hi = np.array(lows, np.int64), np.array(highs, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(at_), batch.column(2).take(at_), pa.array(_pack(lo, hi, lo, REPEATED))], names=["key", "tid", "place"]
            )

    return run


def spans_of(places, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) of the bytes in repeated windows."""
    lo, hi, _, _ = _unpack(np.sort(np.asarray(places, np.int64)))
    end = np.maximum.accumulate(hi + length)
    new = np.concatenate([[True], lo[1:] > end[:-1]])
    heads = np.flatnonzero(new)
    return lo[heads], end[np.concatenate([heads[1:] - 1, [len(lo) - 1]])]


def _blobs(wanted: KeySet, names: list[str]):
    """Compressed texts, and further columns, of the rows whose document may be in the set."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(3)
        for batch in (part for whole in batches for part in slices(whole, [2])):
            rows = np.flatnonzero(wanted.may_hold(batch.column(3).to_numpy()))
            chosen = batch.take(pa.array(rows))
            data, edges = utf8(chosen.column(2))
            cells = [pack.compress(data[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            more = [chosen.column(k) for k in range(4, chosen.num_columns)]
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1), pa.array(cells, pa.binary()), *more], names=names)

    return run


def _places(marks: DataFrame) -> DataFrame:
    return stage(marks.groupBy("key", "tid").agg(F.collect_list("place").alias("places")))


def _with_text(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    """(key, tid, blob, places, and what else ``docs`` has) of the documents that have marks."""
    wanted = key_set(per_doc.select(F.xxhash64("key", "tid").alias("h")))
    more = docs.columns[3:]
    fields = {f.name: f for f in docs.schema}
    schema = T.StructType([fields["key"], fields["tid"], T.StructField("blob", T.BinaryType()), *[fields[c] for c in more]])
    blobs = docs.select("key", "tid", "text", F.xxhash64("key", "tid").alias("h"), *more).mapInArrow(released(_blobs(wanted, schema.names)), schema)
    per_doc = per_doc.toDF("_key", "_tid", "places")
    match = blobs["key"].eqNullSafe(per_doc["_key"]) & (blobs["tid"] == per_doc["_tid"])
    return blobs.join(per_doc, match).select("key", "tid", "blob", "places", *more)


def repeated_spans(
    df: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM, carry: list[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows (key, tid, text, and a struct of the ``carry`` columns), the distinct documents, and their marks.

    Marks (key, tid, place) are windows that also start earlier.

    ``tid`` is 0 unless a key occurs more than once; then it is a hash of the text, and such documents are in
    the order of key and hash. Rows that are equal in key and text are one document.
    """
    if not 0 < gram < length <= gram + 127:
        raise ValueError("gram must be below length, by 127 at most")
    carried = [F.struct(*[named(df, c) for c in carry]).alias("carry")] if carry else []
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"), *carried)
    kind = dict(slim.dtypes)["key"]
    twice = slim.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("_key"))
    twice = small(stage(twice))
    known = slim["key"].eqNullSafe(twice["_key"])
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    single = slim.join(twice, known, "left_anti").withColumn("tid", F.lit(0).cast("bigint"))
    several = slim.join(twice, known, "left_semi").withColumn("tid", content)
    whole = single.unionByName(several).select("key", "tid", "text", *["carry"] * bool(carry))
    docs = single.select("key", "tid", "text").unionByName(several.select("key", "tid", "text").dropDuplicates(["key", "tid"]))
    rows = docs.mapInArrow(released(_find(length, gram)), f"digit bigint, span bigint, key {kind}, tid bigint, place bigint")
    rows = rows.repartition(partitions(rows), "digit").sortWithinPartitions("digit", "span", "key", "tid", "place")
    marks = stage(rows.mapInArrow(released(_sort_out), f"key {kind}, tid bigint, place bigint"))
    is_open = F.col("place").bitwiseAND(F.lit(3)) == OPEN
    row = f"digit bigint, key {kind}, tid bigint, first bigint, before int, rest binary"
    contents = stage(_with_text(docs, _places(marks.where(is_open))).mapInArrow(released(_contents(length, gram)), row))
    crowded = contents.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DIGIT_ROWS)
    crowded = small(stage(crowded.select(F.col("digit").alias("_digit"), F.lit(1).alias("crowded"))))
    dealt = contents.join(crowded, contents["digit"] == crowded["_digit"], "left").drop("_digit").mapInArrow(released(_deal(length, gram)), row)
    dealt = dealt.repartition(partitions(dealt), "digit").sortWithinPartitions("digit", "key", "tid", "first")
    resolved = dealt.mapInArrow(released(_resolve(length, gram)), f"key {kind}, tid bigint, place bigint")
    return whole, docs, marks.where(~is_open).unionByName(resolved)


def _rest_of(data: bytes, places, length: int) -> tuple[bytes, int]:
    """What is left of a text, and how many runs are gone."""
    begin, end = spans_of(places, length)
    edges = [0, *(int(x) for pair in zip(begin, end, strict=True) for x in pair), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(begin)


def _digests(length: int):
    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, count, sums = [], [], []
            for blob, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = unpack.decompress(blob)
                rest, runs = _rest_of(data, places, length)
                removed.append(len(data) - len(rest))
                count.append(runs)
                sums.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sums, pa.string())],
                names=["key", "tid", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def _kept(length: int):
    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            cells = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            kept = [_rest_of(unpack.decompress(blob), places, length)[0].decode("utf-8", "ignore") for blob, places in cells]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), batch.column(4)], names=["text", "carry"])

    return run


def without_repeats(df: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each row of ``df``: key, n_bytes, n_removed, n_spans and kept_sha256.

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document with a smaller
    key (null is smallest), or earlier in the same one. Strings are judged on the input and do not cross
    documents. Null texts count as empty. See ``repeated_spans`` for repeated keys.
    """
    rows, docs, marks = repeated_spans(df, key, text, length, gram)
    schema = f"key {dict(docs.dtypes)['key']}, tid bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    cut = _with_text(docs, _places(marks)).mapInArrow(released(_digests(length)), schema)
    cut = cut.withColumnsRenamed({"key": "_key", "tid": "_tid", "kept_sha256": "_sha"})
    content = F.coalesce("text", F.lit("")).cast("binary")
    whole = rows.select("key", "tid", F.length(content).cast("bigint").alias("n_bytes"), F.sha2(content, 256).alias("sha"))
    joined = whole.join(cut, whole["key"].eqNullSafe(cut["_key"]) & (whole["tid"] == cut["_tid"]), "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "key", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("_sha", "sha").alias("kept_sha256"),
    )


def trimmed(df: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All rows and columns of ``df``, without the repeated bytes of the text; the rules are those of ``without_repeats``.

    A null text stays null. A character of which only a part remains is left out. Rows that lose nothing are not
    shuffled, unless the documents that do are too many to broadcast their keys.
    """
    others = [c for c in df.columns if c != text]
    rows, _, marks = repeated_spans(df, key, text, length, gram, others)
    per_doc = _places(marks)
    schema = T.StructType([T.StructField("text", T.StringType()), rows.schema["carry"]])
    cut = _with_text(rows, per_doc).mapInArrow(released(_kept(length)), schema)
    keys = small(per_doc.select(F.col("key").alias("_key"), F.col("tid").alias("_tid")))
    same = rows["key"].eqNullSafe(keys["_key"]) & (rows["tid"] == keys["_tid"])
    out = rows.join(keys, same, "left_anti").select("text", "carry").unionByName(cut)
    return out.select(*[F.col("text").alias(text) if c == text else F.col("carry").getField(c).alias(c) for c in df.columns])
