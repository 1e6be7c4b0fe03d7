"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOW))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(docs):
    """doc_id -> (set size, smallest id of its group), by comparing all that share a shingle."""
    sets, holders, parent = {d: shingles(t) for d, t in docs}, {}, {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        common = Counter(o for g in sets[d] for o in holders.get(g, ()))
        for g in sets[d]:
            holders.setdefault(g, []).append(d)
        for o, k in common.items():
            if 100 * k >= 75 * (len(sets[d]) + len(sets[o]) - k):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(docs, length=100):
    """doc_id -> (bytes, removed, runs, checksum of the rest, the rest); docs in order of their ids."""
    seen, out = set(), {}
    for d, text in docs:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(window)
        rest = bytes(x for x, c in zip(data, covered, strict=True) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out[d] = (len(data), sum(covered), runs, hashlib.sha256(rest).hexdigest(), rest)
    return out


def jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b
