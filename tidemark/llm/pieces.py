"""Token ids of whole texts through a table of pre-token pieces that each worker keeps.

Byte-pair encoding treats every pre-token piece on its own, so the ids of a text are the ids of its
pieces in a row. Pieces repeat far more often than texts do. Each piece is encoded by the tokenizer
library once and then found by its hash in numpy arrays, a batch of texts at a time.

Only texts whose characters are all in Latin-1 are cut here. Any other text, any text with the string of
a special token, and any tokenizer of another build goes through the library as it is.
"""

from __future__ import annotations

import json

import numpy as np

# The pre-token patterns of the two public tokenizers that are cut here.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# A worker forgets its pieces when it holds so many (some 70 bytes each); that costs time only.
MOST_PIECES = 600_000
_BATCH_CHARS = 500_000


def _classes() -> np.ndarray:
    import regex

    table = np.full(256, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\p{White_Space}", SPACE)):
        for k in range(256):
            if regex.match(pattern, chr(k)):
                table[k] = kind
    return table


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def piece_hash(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[start : start + size]`` for each piece; ``data`` has 8 spare bytes at its end."""
    words = np.ndarray(len(data) - 7, np.dtype("<u8"), data, 0, (1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    found = _mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, left, rows = start, size, None
    while True:
        part = words[np.minimum(at, len(words) - 1)] & masks[np.minimum(left, 8)]
        if rows is None:
            found = _mix(found ^ part)
        else:
            found[rows] = _mix(found[rows] ^ part)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return found
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8


class PieceTable:
    """An open-addressing hash table in numpy from piece hashes to consecutive numbers."""

    def __init__(self, bits: int = 16) -> None:
        self.bits, self.count = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is not there."""
        mask = np.int64((1 << self.bits) - 1)
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.values[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & mask
            value = self.values[at[open_]]
            found[open_] = value
            open_ = open_[(value >= 0) & (self.keys[at[open_]] != keys[open_])]
        return found

    def add(self, keys: np.ndarray, values: np.ndarray | None = None) -> None:
        """Adds distinct keys that are not there yet, numbered on from the last unless ``values`` says how."""
        if values is None:
            values = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        while (self.count + len(keys)) * 2 > 1 << self.bits:
            used = self.values >= 0
            old = self.keys[used], self.values[used]
            self.bits, self.count = self.bits + 1, 0
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.values = np.full(1 << self.bits, -1, np.int32)
            self.add(*old)
        mask = np.int64((1 << self.bits) - 1)
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.values[at[rest]] < 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.values[at[won]] = keys[won], values[won]
            lost = np.ones(len(keys), bool)
            lost[won] = False
            rest = rest[lost[rest]]
            at[rest] = (at[rest] + 1) & mask
        self.count += len(keys)


def kind_of(spec: dict) -> str:
    """``word`` or ``byte`` for the two builds that are cut here, else an empty string."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    model = spec.get("model") or {}
    if spec.get("truncation") or spec.get("padding") or model.get("type") != "BPE" or model.get("dropout"):
        return ""
    if any(t.get("normalized") or t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in spec["added_tokens"]):
        return ""
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte"
    steps = pre.get("pretokenizers") or []
    names = [n.get("type") for n in (norm or {}).get("normalizers") or []]
    if names == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in steps] == ["Split", "ByteLevel"]:
        split, level = steps
        if split["pattern"].get("Regex") == WORD_PATTERN and split["invert"] and split["behavior"] == "Removed":
            if not level["use_regex"] and not level["add_prefix_space"]:
                return "word"
    return ""


_LIBRARY: dict[str, tuple] = {}


def _library(path: str) -> tuple:
    """The library's tokenizer of a file, its kind and its special strings; one for a worker, as the library never frees one."""
    if path not in _LIBRARY:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _LIBRARY[path] = Tokenizer.from_file(path), kind_of(spec), [t["content"] for t in spec["added_tokens"]]
    return _LIBRARY[path]


class PieceEncoder:
    """Encodes batches of texts with one tokenizer file; lives in a worker and learns pieces as they come."""

    def __init__(self, path: str, most_pieces: int = MOST_PIECES) -> None:
        self.library, self.kind, self.special = _library(path)
        self.classes = _classes()
        self.most_pieces = most_pieces
        self.lengths_only: dict = {}
        self._forget()

    def _forget(self) -> None:
        self.table = PieceTable()
        self.lengths = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def plain(self, texts: list[str]) -> list[list[int]]:
        """By the library alone."""
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes of the pieces of joined texts, whose first places are given."""
        n = len(data)
        kind = self.classes[data]
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        begins = np.zeros(n + 1, bool)
        begins[first] = True
        change |= begins[:-1]
        if self.kind == "word":
            change |= kind == NUMBER
        else:
            # A single blank before a piece belongs to it; the white space before that is a piece of its own.
            space = kind == SPACE
            last = space.copy()
            last[:-1] &= ~space[1:] & ~begins[1:-1]
            last[-1] = False
            change |= last
            joined = np.flatnonzero(last & (data == 32)) + 1
            change[joined] = False
        # "'s" and the like are pieces where the apostrophe begins one.
        quote = np.flatnonzero((data == 39) & change)
        if len(quote):
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            # The two places behind must belong to the same text.
            room1, room2 = ~begins[np.minimum(quote + 1, n)], ~begins[np.minimum(quote + 2, n)]
            for suffix in SUFFIXES:
                hit = padded[quote + 1] == ord(suffix[0])
                hit &= room1
                if len(suffix) == 2:
                    hit &= (padded[quote + 2] == ord(suffix[1])) & room2
                at = quote[hit]
                change[at + 1] = False
                after = at + 1 + len(suffix)
                if len(suffix) == 2:
                    change[at + 2] = False
                inside = after[after < n]
                if self.kind == "word":
                    change[inside] = True
                else:
                    # A blank behind stays with what follows it; places that were merged into a blank stay so.
                    change[inside] = True
        starts = np.flatnonzero(change)
        sizes = np.diff(starts, append=n)
        if self.kind == "word":
            keep = kind[starts] != SPACE
            starts, sizes = starts[keep], sizes[keep]
        return starts, sizes

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of Latin-1 texts, and how many pieces each text has."""
        raw = [t.encode("latin-1") for t in texts]
        sizes = np.array([len(r) for r in raw], np.int64)
        first = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
        n = len(data) - 8
        starts, lengths = self._cut(data[:n], first[sizes > 0])
        keys = piece_hash(data, starts, lengths)
        found = self.table.find(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            at = missing[where]
            blob = data.tobytes()
            self._learn(new, [blob[s : s + k].decode("latin-1") for s, k in zip(starts[at], lengths[at], strict=True)])
            found[missing] = self.table.find(keys[missing])
        edges = np.searchsorted(starts, np.append(first, n))
        return found, np.diff(edges)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids = self.plain(pieces)
        sizes = np.array([len(x) for x in ids], np.int32)
        self.table.add(keys)
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.pool = np.concatenate([self.pool, np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))])

    def known(self, keys: np.ndarray, lengths: np.ndarray) -> None:
        """Takes in pieces of which only the token counts are known; then ``counts`` may be asked, ``encode`` not."""
        self.table.add(keys)
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.starts = np.concatenate([self.starts, np.zeros(len(keys), np.int64)])

    def _sorted_out(self, texts: list[str | None]):
        """Batches of places of texts that are cut here, and the places of those for the library."""
        easy, hard, chars = [], [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if self.kind and _latin1(text) and not any(s in text for s in self.special):
                easy.append(k)
                chars += len(text)
                if chars >= _BATCH_CHARS:
                    yield easy, []
                    easy, chars = [], 0
            else:
                hard.append(k)
        yield easy, hard

    def _lower(self, texts: list[str]) -> list[str]:
        return [t.lower() for t in texts] if self.kind == "word" else texts

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text; null counts as empty."""
        out = np.zeros(len(texts), np.int64)
        for easy, hard in self._sorted_out(texts):
            if easy:
                if self.table.count > self.most_pieces:
                    self._forget()
                found, per = self._pieces(self._lower([texts[k] for k in easy]))
                total = np.concatenate([[0], np.cumsum(self.lengths[found], dtype=np.int64)])
                ends = np.cumsum(per)
                out[easy] = total[ends] - total[ends - per]
            for k in hard:
                out[k] = len(self.plain([texts[k]])[0])
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as an int32 array; null counts as empty."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        for easy, hard in self._sorted_out(texts):
            if easy:
                if self.table.count > self.most_pieces:
                    self._forget()
                found, per = self._pieces(self._lower([texts[k] for k in easy]))
                size = self.lengths[found].astype(np.int64)
                ends = np.cumsum(size)
                ids = self.pool[np.repeat(self.starts[found] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
                edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])]
                for k, a, b in zip(easy, edge[:-1], edge[1:], strict=True):
                    out[k] = ids[a:b]
            for k in hard:
                out[k] = np.array(self.plain([texts[k]])[0], np.int32)
        return out


def _latin1(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
