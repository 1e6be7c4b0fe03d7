"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of a page.

Labels are main text or not; emissions come from ancestor tags, class names and the text, and transitions
from one block to the next. The field is fitted by gradient ascent on the conditional likelihood
(forward-backward) and decoded by Viterbi.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named
from tidemark.llm.dom import Block, blocks, features
from tidemark.llm.labelled_pages import PAGES
from tidemark.llm.memory import release

# At most so many pages of the input teach the field, those with the smallest hash of their key.
SAMPLE_PAGES = 100
# Longer pages, in bytes or in blocks, do not teach it; they are labelled as all others are.
SAMPLE_BYTES = 1 << 20
SAMPLE_BLOCKS = 500
STEPS = 300
# Copies of each labelled page of the package in which cues are left out at random, so that every cue is learned.
COPIES = 12
LEFT_OUT = 0.3
_BOILER = frozenset("nav header footer aside form .ad .ads .advert .advertisement .sidebar .comment .comments .cookie .notice .share .related".split())


class Field:
    """Weights of features, of transitions between the labels 0 and 1, and of the first label."""

    def __init__(self, names: list[str]) -> None:
        self.index = {n: k for k, n in enumerate(names)}
        self.emit = np.zeros((len(names), 2))
        self.step, self.start = np.zeros((2, 2)), np.zeros(2)

    def scores(self, page: list[list[str]]) -> np.ndarray:
        return np.array([self.emit[[self.index[f] for f in b if f in self.index]].sum(0) for b in page]).reshape(-1, 2)

    def viterbi(self, page: list[list[str]]) -> list[int]:
        """The most likely labels; a tie goes to label 0."""
        if not page:
            return []
        rows, back = self.scores(page), []
        best = self.start + rows[0]
        for row in rows[1:]:
            ways = best[:, None] + self.step
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        label = [int(best.argmax())]
        for came in reversed(back):
            label.append(int(came[label[-1]]))
        return label[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Maximum conditional likelihood with a small penalty on large weights; the same pages give the same field."""
    pages = [p for p in pages if p[0]]
    field = Field(sorted({f for x, _ in pages for b in x for f in b}))
    longest = max((len(x) for x, _ in pages), default=1)
    # Features of all blocks one after the other: which feature, and at which place of (page, block).
    which, place = [], []
    gold, mask = np.zeros((len(pages), longest), np.int64), np.zeros((len(pages), longest), bool)
    for i, (x, y) in enumerate(pages):
        mask[i, : len(x)], gold[i, : len(y)] = True, y
        for j, b in enumerate(x):
            which += [field.index[f] for f in b]
            place += [i * longest + j] * len(b)
    which, place = np.array(which, np.int64), np.array(place, np.int64)
    hot = np.eye(2)[gold] * mask[..., None]

    def sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, label], size) for label in (0, 1)], axis=1)

    pair = mask[:, 1:, None, None]
    wanted_step = (hot[:, :-1, :, None] * hot[:, 1:, None, :] * pair).sum((0, 1))
    weights = [field.emit, field.step, field.start]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for t in range(1, steps + 1):
        rows = sums(place, field.emit[which], len(pages) * longest).reshape(len(pages), longest, 2)
        fore, back = np.zeros_like(rows), np.zeros_like(rows)
        fore[:, 0] = field.start + rows[:, 0]
        for j in range(1, longest):
            now = np.logaddexp.reduce(fore[:, j - 1, :, None] + field.step, 1) + rows[:, j]
            fore[:, j] = np.where(mask[:, j, None], now, fore[:, j - 1])
        for j in range(longest - 2, -1, -1):
            now = np.logaddexp.reduce(field.step + (rows[:, j + 1] + back[:, j + 1])[:, None, :], 2)
            back[:, j] = np.where(mask[:, j + 1, None], now, 0)
        total = np.logaddexp.reduce(fore[:, -1], 1)[:, None, None]
        single = np.exp(fore + back - total) * mask[..., None]
        joint = fore[:, :-1, :, None] + field.step + (rows[:, 1:] + back[:, 1:])[:, :, None, :] - total[..., None]
        both = (np.exp(np.where(pair, joint, -np.inf))).sum((0, 1))
        off = (hot - single).reshape(-1, 2)
        slopes = [sums(which, off[place], len(field.index)), wanted_step - both, (hot - single)[:, 0].sum(0)]
        for w, slope, (m, v) in zip(weights, slopes, moments, strict=True):
            slope = slope / max(1, len(pages)) - decay * w
            m += 0.1 * (slope - m)
            v += 0.001 * (slope**2 - v)
            w += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return field


def weak_labels(page: list[Block]) -> list[int] | None:
    """Labels of a page that says itself what its main text is (article or main elements), else None."""
    inside = [b for b in page if "article" in b.path or "main" in b.path]
    if not inside:
        return None
    return [int(("article" in b.path or "main" in b.path) and not _BOILER.intersection(b.path)) for b in page]


def train(df: DataFrame, key: str, html: str, pages: int = SAMPLE_PAGES) -> Field:
    """Fits the field on the labelled pages of this package and on a bounded sample of the input that labels itself.

    The sample has at most ``pages`` different pages of at most ``SAMPLE_BYTES`` and ``SAMPLE_BLOCKS``, those with the least hash.
    """
    fits = df.where(F.octet_length(named(df, html).cast("string")) <= SAMPLE_BYTES)
    hashed = fits.select(F.xxhash64(named(fits, key), named(fits, html)).alias("n"), named(fits, html).cast("string").alias("h"))
    chosen = [r["n"] for r in hashed.select("n").distinct().orderBy("n").limit(pages).collect()]
    sample = hashed.where(F.col("n").isin(chosen)).dropDuplicates(["n"]).orderBy("n").collect() if chosen else []
    taught = [blocks(p) for p in PAGES]
    data = [(features(p), [int(b.main) for b in p]) for p in taught]
    for row in sample:
        page = blocks(row["h"])
        labels = weak_labels(page) if len(page) <= SAMPLE_BLOCKS else None
        if labels:
            data.append((features(page), labels))
    random = np.random.default_rng(11)
    for page, labels in data[: len(PAGES)]:
        for _ in range(COPIES):
            # Ancestors and signs go for the whole page; what goes in the main text goes elsewhere too.
            out = {f for b in page for f in b if f != "any" and random.random() < LEFT_OUT}
            data.append(([[f for f in b if f not in out] for b in page], labels))
    return fit(data)


def extract(page: str | None, field: Field) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, label in zip(found, field.viterbi(features(found)), strict=True) if label)


def main_text(df: DataFrame, html: str, field: Field, name: str = "text") -> DataFrame:
    """All rows and columns of ``df``, and ``name`` (replacing a column of that name): the main text of each page.

    Blocks are joined by two line feeds, in page order. A null page, or one without main text, has an empty
    text. Nothing is shuffled, whole pages are read.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for pages in parts:
                yield pages.map(lambda p: extract(p, shared.value))
        finally:
            release()

    return df.withColumn(name, text_of(named(df, html).cast("string")))
