"""Documents that hold questions of a benchmark, also with other numbers, names or units.

Texts are turned into templates: numbers, units behind a number, and names become typed placeholders, the
other words are lower-cased, and marks are left out. Windows of ``WINDOW`` template words of the documents
are joined by hash with those of the benchmark, and so are windows of the words as they are. Windows on one diagonal (the same distance between the two
places) must also fill their slots consistently: one value of the question always stands for the same value
of the document and the other way round. Where values conflict, template windows that hold a value's less frequent
partner do not count; windows of the words themselves have no slots and always count. A document leaks an item
if the windows that count cover at least ``COVERAGE`` of the item's windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytes_of import chunks, utf8
from tidemark.llm.common import named, own
from tidemark.llm.keyset import KeySet, key_set
from tidemark.llm.memory import released, slices
from tidemark.llm.pieces import piece_hash
from tidemark.llm.shingles import _join
from tidemark.session import small, stage

WINDOW = 6
COVERAGE = 0.5
# The place of a whole text that has too few words for windows.
WHOLE = -1

UNITS = (
    "mm cm m km mg g kg t ml l s sec min h hr hrs ms inch inches foot feet ft yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons liter "
    "liters litre litres second seconds minute minutes hour hours day days week weeks month months year years percent degree degrees "
    "dollar dollars cent cents euro euros eur usd gbp watt watts kw kwh volt volts joule joules hz khz mhz ghz mph kmh kb mb gb tb"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
NUMBER, UNIT, NAME = 1, 2, 3

_OTHER, _LETTER, _DIGIT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_END = np.zeros(256, bool)
_END[list(b".!?:;\n\r\"")] = True


def _hashes(words) -> np.ndarray:
    raw = [w.encode() for w in words]
    size = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw) + bytes(16), np.uint8)
    return np.sort(piece_hash(data, np.cumsum(size) - size, size))


_UNIT_HASHES, _NUMBER_HASHES = _hashes(UNITS), _hashes(NUMBERS)
_UPPER_LATIN = np.zeros(256, bool)
_UPPER_LATIN[0x80:0x9F] = True
_UPPER_LATIN[0x97] = False


def template(data: np.ndarray, edges: np.ndarray):
    """Of joined texts: the first word of each text, template hashes, placeholder kinds and literal hashes of the words,
    and where a capitalised word begins a sentence, which may be a name or not.

    Case is folded for the letters of ASCII and Latin-1; others are compared as they are.
    """
    n = int(edges[-1])
    raw = data[:n]
    upper = (raw >= 65) & (raw <= 90)
    if n > 1:
        upper[1:] |= (raw[:-1] == 0xC3) & _UPPER_LATIN[raw[1:]]
    low = np.concatenate([raw + upper.astype(np.uint8) * 32, np.zeros(16, np.uint8)])
    kind = _KIND[raw]
    if n > 2:
        point = np.flatnonzero((kind[:-2] == _DIGIT) & ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & (kind[2:] == _DIGIT)) + 1
        kind[point] = _DIGIT
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change[edges] = True
    starts = np.flatnonzero(change[:n])
    sizes = np.diff(starts, append=n)
    word = kind[starts] != _OTHER
    starts, sizes = starts[word], sizes[word]
    literal = piece_hash(low, starts, sizes) if len(starts) else np.zeros(0, np.uint64)
    places = np.searchsorted(starts, edges)
    slot, opens = np.zeros(len(starts), np.uint8), np.zeros(len(starts), bool)
    if len(starts):
        number = (kind[starts] == _DIGIT) | np.isin(literal, _NUMBER_HASHES)
        slot[number] = NUMBER
        unit = np.isin(literal, _UNIT_HASHES)
        unit[1:] &= number[:-1]
        first = places[:-1][places[:-1] < places[1:]]
        unit[first] = False
        slot[unit & ~number] = UNIT
        # Capitalised words that do not begin a sentence.
        wide = (raw[starts] >= 0xC2).astype(np.int64)
        begins = upper[np.minimum(starts + wide, n - 1)]
        after = np.minimum(starts + wide + 1, n - 1)
        lower_next = (sizes > wide + 1) & ~upper[after] & ~upper[np.minimum(after + 1, n - 1)]
        ends = np.concatenate([[0], np.cumsum(_END[raw])])
        sentence = np.ones(len(starts), bool)
        sentence[1:] = ends[starts[1:]] > ends[starts[:-1] + sizes[:-1]]
        sentence[first] = True
        capital = begins & lower_next & (slot == 0)
        slot[capital & ~sentence] = NAME
        opens = capital & sentence
    shown = np.where(slot > 0, slot.astype(np.uint64), literal)
    return places, shown, slot, literal, opens


def _spans(slot: np.ndarray, base: np.ndarray, first: np.ndarray, last: np.ndarray, width: int):
    """Of windows with too many placeholders, wider ones: (index, begin, end) of the spans inside their texts.

    A span holds the window and ``width - width // 2`` literal words, of which 0, 1, ... are taken from before it. A text with
    so many literal words has a span for each of its windows.
    """
    need = width - width // 2
    literals = np.flatnonzero(slot == 0)
    before = np.searchsorted(literals, base)
    for j in range(need + 1):
        begins, ends = before - j, before - j + need - 1
        ok = np.flatnonzero((begins >= 0) & (ends < len(literals)))
        begin = literals[begins[ok]] if j else base[ok]
        end = np.maximum(base[ok] + width, literals[ends[ok]] + 1)
        inside = (begin >= first[ok]) & (end <= last[ok])
        yield ok[inside], begin[inside], end[inside]


def _span_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of runs of words of any length, from sums of the words times powers of an odd number."""
    step = 0x9E3779B97F4A7C15
    powers = np.full(len(words) + 1, step, np.uint64)
    back = np.full(len(words) + 1, pow(step, -1, 1 << 64), np.uint64)
    powers[0] = back[0] = 1
    powers, back = np.cumprod(powers, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_join(np.zeros(1, np.uint64), words) * powers[:-1], dtype=np.uint64)])
    return _join(_join(np.full(len(begin), seed, np.uint64), (end - begin).astype(np.uint64)), (sums[end] - sums[begin]) * back[begin])


def _windows(data: np.ndarray, edges: np.ndarray, width: int):
    """Windows of ``width`` words: text, place, hash, first word and the one behind, placeholder kinds and literal words.

    First those of the template that have placeholders, then those where also a capitalised word that begins a sentence is a
    name, then those of the words themselves, so that a difference in case alone, which makes a name of a word or not,
    hides nothing. Template windows in which placeholders are more than half of
    the words are widened. A text with too few words, or too few of them literal, has its whole sequence at the place ``WHOLE``.
    """
    need = width - width // 2
    for a, b in chunks(edges, 1_000_000):
        part = np.concatenate([data[edges[a] : edges[b]], np.zeros(16, np.uint8)])
        places, shown, slot, literal, opens = template(part, edges[a : b + 1] - edges[a])
        total = max(0, len(shown) - width + 1)
        owner = np.searchsorted(places, np.arange(total), "right") - 1
        whole = np.arange(total) + width <= places[owner + 1]
        filled, opened = np.zeros(total, np.int64), np.zeros(total, np.int64)
        for k in range(width):
            filled += slot[k : k + total] > 0
            opened += opens[k : k + total]
        plain = np.zeros_like(slot)
        named_slot, named_shown = np.where(opens, NAME, slot).astype(np.uint8), np.where(opens, np.uint64(NAME), shown)
        for words, kinds, fits in (
            (shown, slot, whole & (filled > 0) & (2 * filled <= width)),
            (named_shown, named_slot, whole & (opened > 0) & (2 * (filled + opened) <= width)),
            (literal, plain, whole),
        ):
            hashes = np.full(total, width + (kinds is plain), np.uint64)
            for k in range(width):
                hashes = _join(hashes, words[k : k + total])
            at = np.flatnonzero(fits)
            yield a + owner[at], at - places[owner[at]], hashes[at], at, at + width, kinds, literal
        dense = np.flatnonzero(whole & (2 * filled > width))
        texts = owner[dense]
        if len(dense):
            for k, begin, end in _spans(slot, dense, places[texts], places[texts + 1], width):
                place = dense[k] - places[texts[k]]
                yield a + texts[k], place, _span_hashes(shown, begin, end, width + 2), begin, end, slot, literal
        literals = np.concatenate([[0], np.cumsum(slot == 0)])
        size, held = np.diff(places), np.diff(literals[places])
        for words, kinds, short in ((shown, slot, (size > 0) & ((size < width) | (held < need))), (literal, plain, (size > 0) & (size < width))):
            texts = np.flatnonzero(short)
            if len(texts):
                begin, end = places[texts], places[texts + 1]
                yield a + texts, np.full(len(texts), WHOLE), _span_hashes(words, begin, end, width + 3 + (kinds is plain)), begin, end, kinds, literal


def _slots(begin: np.ndarray, end: np.ndarray, slot: np.ndarray, literal: np.ndarray) -> list[list[int]]:
    """The literal words behind the placeholders of each window, in order."""
    signed = literal.view(np.int64)
    return [[int(signed[p]) for p in range(x, y) if slot[p]] for x, y in zip(begin, end, strict=True)]


def _emit(width: int, wanted: KeySet | None):
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, [1])):
            for text, place, hashes, begin, end, slot, literal in _windows(*utf8(batch.column(1)), width):
                if wanted is not None:
                    keep = np.flatnonzero(wanted.may_hold(hashes.view(np.int64)))
                    text, place, hashes, begin, end = text[keep], place[keep], hashes[keep], begin[keep], end[keep]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text)), pa.array(place), pa.array(hashes.view(np.int64)),
                     pa.array(_slots(begin, end, slot, literal), pa.list_(pa.int64()))],
                    names=["key", "place", "hash", "slots"],
                )

    return released(run)


def _template_windows(df: DataFrame, key: str, text: str, width: int, wanted: KeySet | None = None) -> DataFrame:
    slim = df.select(named(df, key).alias("key"), named(df, text).cast("string").alias("text"))
    return slim.mapInArrow(_emit(width, wanted), f"key {dict(slim.dtypes)['key']}, place bigint, hash bigint, slots array<bigint>")


def leaks(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str,
    width: int = WINDOW, coverage: float = COVERAGE,
) -> DataFrame:
    """One row for each document and item that it leaks: key, item, n_windows, item_windows, coverage, verbatim.

    ``n_windows`` counts the item's windows that the document holds consistently; ``verbatim`` says whether all
    slots have the item's own values, also those that clash. Items with fewer than ``width`` words cannot be told
    from chance inside a text, so a document leaks them if they are its whole text; the same holds for other values in an item
    that has fewer than ``width - width // 2`` words beside them. Null texts and rows with a null key take no part. Items or
    documents with a repeated key are judged together under it.
    """
    bank = stage(_template_windows(items, item_key, item_text, width).where("key is not null"))
    # Only windows that the benchmark may hold leave the scan; the bit map has a fixed largest size.
    wanted = key_set(bank.select(F.col("hash").alias("h")).distinct(), each=4096)
    found = _template_windows(docs, key, text, width, wanted).where("key is not null")
    bank = bank.select(F.col("key").alias("item"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"))
    in_text = F.when(F.col("item_place") != WHOLE, F.col("item_place"))
    sizes = bank.groupBy("item").agg(F.greatest(F.countDistinct(in_text), F.lit(1)).alias("item_windows"))
    pairs = found.join(small(bank), "hash").where(F.size("slots") == F.size("item_slots"))
    pairs = pairs.where((F.col("place") == WHOLE) == (F.col("item_place") == WHOLE))
    pairs = stage(pairs.select("key", "item", (F.col("place") - F.col("item_place")).alias("diagonal"), "item_place", "slots", "item_slots"))
    line = ["key", "item", "diagonal"]
    slots = pairs.select(*line, F.explode(F.arrays_zip("item_slots", "slots")).alias("s")).select(*line, "s.*")
    slots = stage(slots.groupBy(*line, "item_slots", "slots").agg(F.count(F.lit(1)).alias("n")))
    values = slots.groupBy(*line).agg(
        F.count(F.lit(1)).alias("pairs"), F.countDistinct("item_slots").alias("asked"), F.countDistinct("slots").alias("given"),
        F.min(F.col("item_slots") == F.col("slots")).alias("same"),
    )
    clashes = values.where("pairs > asked or pairs > given").select(*line)
    asked = Window.partitionBy(*line, "item_slots").orderBy(F.desc("n"), "slots")
    given = Window.partitionBy(*line, "slots").orderBy(F.desc("n"), "item_slots")
    ranked = slots.join(clashes, line, "left_semi").withColumn("a", F.row_number().over(asked)).withColumn("g", F.row_number().over(given))
    minority = ranked.where("a > 1 or g > 1").groupBy(*line).agg(F.collect_set(F.struct("item_slots", "slots")).alias("minority"))
    judged = pairs.join(values.select(*line, "same"), line, "left").join(minority, line, "left")
    clash = F.arrays_overlap(F.arrays_zip("item_slots", "slots"), "minority")
    judged = judged.where(~F.coalesce(clash, F.lit(False)))
    covered = judged.groupBy("key", "item").agg(
        F.countDistinct(in_text).alias("n_windows"), F.min(F.coalesce("same", F.lit(True))).alias("verbatim"),
        F.max(F.col("item_place") == WHOLE).alias("whole"),
    )
    covered = covered.join(sizes, "item").withColumn("n_windows", F.when(F.col("whole"), F.col("item_windows")).otherwise(F.col("n_windows")))
    shared = F.col("n_windows") / F.col("item_windows")
    out = covered.where(shared >= coverage)
    return out.select("key", "item", "n_windows", "item_windows", shared.alias("coverage"), "verbatim")


def clean_texts(
    docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, width: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs`` whose text leaks nothing, with all their columns.

    Only the text decides, so rows without a key, or with the key of a leak, are judged like all others. Texts are told
    apart by a digest of 128 bits; rows with a null text stay.
    """
    mark = own(docs, "_digest")
    marked = docs.withColumn(mark, F.md5(named(docs, text).cast("string").cast("binary")))
    found = leaks(marked, mark, text, items, item_key, item_text, width, coverage)
    bad = small(stage(found.select(F.col("key").alias("_leak")).distinct()))
    return marked.join(bad, named(marked, mark) == bad["_leak"], "left_anti").drop(mark)


def without_leaks(docs: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak nothing, with all their columns."""
    bad = small(stage(found.select(F.col("key").alias("_leak")).distinct()))
    return docs.join(bad, named(docs, key) == bad["_leak"], "left_anti")
