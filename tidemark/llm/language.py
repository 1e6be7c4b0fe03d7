"""Language identification by error-correcting output codes.

Each language has a codeword. For every bit a binary classifier over hashed character n-grams (naive
Bayes: a log-odds weight for each n-gram) says on which side of the bit a text is. The prediction is the
language whose codeword has the least loss, where the loss of a bit is weighted by how well that bit
works for that language. A text whose two best languages are close is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import named, own
from tidemark.llm.memory import release
from tidemark.session import small, stage

# The classifier learns from at most so many labelled rows of each language, those with the smallest hash of the key.
ROWS_PER_LANGUAGE = 1_500
BITS = 14
# Bits of a codeword for more than seven languages, for each doubling of their number.
BITS_PER_DOUBLING = 15
AMBIGUOUS = 0.2
# What an n-gram that was never seen gets of all chances, the same in each language.
SMOOTH = 0.02
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_TABLE: list[np.ndarray] = []


def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """A matrix of -1 and 1: a codeword for each language. Up to seven: every way of parting them in two."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 7:
        columns = [(1, *c) for c in itertools.product((1, -1), repeat=languages - 1) if -1 in c]
    else:
        random, columns = np.random.default_rng(seed), set()
        wanted = math.ceil(BITS_PER_DOUBLING * math.log2(languages))
        while len(columns) < wanted:
            column = random.choice((-1, 1), languages)
            if abs(column.sum()) < languages:
                columns.add(tuple(int(x * column[0]) for x in column))
        columns = sorted(columns)
    return np.array(columns, np.int8).T


def _letters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.array([ord(chr(k).lower()[:1]) if chr(k).isalpha() else 32 for k in range(0x10000)], np.uint32))
    return _TABLE[0]


def features(text: str) -> np.ndarray:
    """How often each hashed n-gram of one to three characters occurs; anything but letters counts as a blank."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")
    points = _letters()[np.minimum(points, 0xFFFF)].astype(np.uint32)
    # Runs of blanks count once.
    points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    shift = np.uint32(32 - BITS)
    grams = [points * np.uint32(0x9E3779B1)]
    grams.append((grams[0][:-1] ^ points[1:]) * np.uint32(0x85EBCA6B))
    grams.append((grams[1][:-1] ^ points[2:]) * np.uint32(0xC2B2AE35))
    return np.bincount(np.concatenate([g >> shift for g in grams]), minlength=1 << BITS)


class Model:
    """Languages (sorted), codewords, bit classifiers and the weight of each bit for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages, self.code = languages, codebook(len(languages))
        # Each language counts alike, however many texts it has.
        rates = (1 - SMOOTH) * counts / np.maximum(counts.sum(1, keepdims=True), 1) + SMOOTH / counts.shape[1]
        sides = [(rates[bit > 0].mean(0), rates[bit < 0].mean(0)) for bit in self.code.T]
        self.weights = np.array([np.log(a) - np.log(b) for a, b in sides]).reshape(-1, 1 << BITS).T.copy()
        self.trust = np.full(self.code.shape, 1.0)

    def margins(self, found: np.ndarray) -> np.ndarray:
        return found @ self.weights / math.sqrt(max(1, found.sum()))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the second best is close."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(features(text)))).sum(1)
        chance = np.exp(loss.min() - loss)
        chance /= chance.sum()
        order = np.argsort(loss, kind="stable")
        return self.languages[order[0]], float(chance[order[0]]), bool(chance[order[0]] - chance[order[1]] < AMBIGUOUS)


def learn(df: DataFrame, key: str, text: str, label: str, allowed: Column, rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Fits the bits on the rows where ``allowed`` holds and label and text are not null.

    The driver gets a count for each language and hashed n-gram, and the share of right bits for each
    language and bit. Both are bounded by the number of languages.
    """
    usable = df.where(allowed & named(df, label).isNotNull() & named(df, text).isNotNull())
    keys = usable.select(named(usable, key).alias("_k"), named(usable, label).cast("string").alias("_l"))
    order = Window.partitionBy("_l").orderBy(F.xxhash64("_k"), "_k")
    keys = keys.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= rows).select("_k", "_l").distinct()
    chosen = small(stage(keys))
    full = usable.select(
        named(usable, key).alias("_key"), named(usable, label).cast("string").alias("lang"), named(usable, text).cast("string").alias("text")
    )
    same = full["_key"].eqNullSafe(chosen["_k"]) & (full["lang"] == chosen["_l"])
    sample = stage(full.join(chosen, same, "left_semi").select("lang", "text"))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # A long text weighs no more than a short one of a thousand n-grams.
                found = features(content)
                found = found * min(1.0, 1000 / max(1, found.sum()))
                total[lang] = total[lang] + found if lang in total else found
        for lang, found in total.items():
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(found[used])], names=["lang", "gram", "n"]
            )

    grams = sample.mapInArrow(count, "lang string, gram int, n double").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows_ = grams.toPandas()
    languages = sorted(rows_["lang"].unique().tolist())
    counts = np.zeros((len(languages), 1 << BITS))
    for k, lang in enumerate(languages):
        part = rows_[rows_["lang"] == lang]
        counts[k, part["gram"].to_numpy()] = part["n"].to_numpy()
    model = Model(languages, counts)
    if model.code.shape[1]:
        shared = df.sparkSession.sparkContext.broadcast(model)

        def judge(batches):
            right, seen = np.zeros(shared.value.code.shape), np.zeros(len(shared.value.languages))
            for batch in batches:
                for lang, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    k = shared.value.languages.index(lang)
                    right[k] += shared.value.code[k] * shared.value.margins(features(content)) > 0
                    seen[k] += 1
            cells = list(np.ndindex(right.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cells]), pa.array([c[1] for c in cells]), pa.array([right[c] for c in cells]),
                 pa.array([seen[c[0]] for c in cells])], names=["k", "bit", "good", "n"],
            )

        judged = sample.mapInArrow(judge, "k bigint, bit bigint, good double, n double").groupBy("k", "bit")
        for r in judged.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect():
            model.trust[r["k"], r["bit"]] = (r["good"] + 1) / (r["n"] + 2)
        model.trust /= model.trust.sum(1, keepdims=True) / model.trust.shape[1]
    return model


def _predictor(df: DataFrame, model: Model):
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for texts in parts:
                yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])
        finally:
            release()

    return predict


def identify(df: DataFrame, text: str, model: Model) -> DataFrame:
    """All rows and columns of ``df``, and ``lang_pred``, ``score`` and ``ambiguous`` (replacing columns of these names).

    Only the text decides. A text that is null or has no letter is ``und`` with score 0, as is every text
    if no language was learned. Nothing is shuffled.
    """
    taken = own(df, "_found")
    kept = [named(df, c) for c in df.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    found = df.select(*kept, _predictor(df, model)(named(df, text).cast("string")).alias(taken))
    return found.select(*[named(found, c) for c in found.columns if c != taken], f"{taken}.*")


def with_language(df: DataFrame, text: str, model: Model) -> DataFrame:
    """The rows whose text has a language, with the columns they came with."""
    return df.where(_predictor(df, model)(named(df, text).cast("string"))["lang_pred"] != UNKNOWN)
