"""Sets of hashed word shingles, a batch of texts at a time."""

from __future__ import annotations

import numpy as np

from tidemark.llm.bytes_of import chunks
from tidemark.llm.pieces import _mix, piece_hash

WIDTH = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words are what stands between blanks and the control characters from tab to carriage return.
_WORD = np.ones(256, bool)
_WORD[[32, *range(9, 14)]] = False


def _join(total: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(total * np.uint64(0x9E3779B97F4A7C15) + word)


def shingle_sets(data: np.ndarray, edges: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Of each text the sorted, distinct 64-bit hashes of its shingles of ``width`` words.

    A-Z are lower-cased. A text with fewer words has its whole sequence as its only shingle; a text
    without a word has none.
    """
    out: list[np.ndarray] = []
    for a, b in chunks(edges, 1_000_000):
        part = _LOWER[data[edges[a] : edges[b] + 8]]
        part[-8:] = 0
        inner = edges[a : b + 1] - edges[a]
        n = int(inner[-1])
        is_word = _WORD[part[:n]]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        first = inner[:-1][inner[:-1] < inner[1:]]
        begins[first] = is_word[first]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:]
        ends[first[1:] - 1] = is_word[first[1:] - 1]
        starts = np.flatnonzero(begins)
        sizes = np.flatnonzero(ends) + 1 - starts
        words = piece_hash(part, starts, sizes) if len(starts) else np.zeros(0, np.uint64)
        places = np.searchsorted(starts, inner)
        grams = np.full(max(0, len(words) - width + 1), width, np.uint64)
        for k in range(width):
            grams = _join(grams, words[k : k + len(grams)])
        for p, q in zip(places[:-1], places[1:], strict=True):
            if q - p >= width:
                out.append(np.unique(grams[p : q - width + 1]))
            elif q > p:
                whole = np.full(1, q - p, np.uint64)
                for k in range(p, q):
                    whole = _join(whole, words[k : k + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out
