from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import WORD
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import query_runs, runs


def brute(words, least=runs.LEAST):
    """All runs by comparing the words with themselves at every distance."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(least, 2 * q) and i > a:
                out.setdefault((a, i + q), q)
            i += 1
    return sorted((a, e - a, q) for (a, e), q in out.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    """A row of the query, by the plain rules."""
    words = [w.decode() for w in WORD.findall((text or "").encode())]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (doc_id, len(found), *best, exponent, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repeated(rng, n, k):
    words = [rng.randint(0, k) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        end = rng.randint(a, n)
        words = [words[a + (i - a) % p] if a <= i < end else words[i] for i in range(n)]
    return words


def numbered(words):
    return [b"%d" % w for w in words]


@pytest.mark.parametrize("least", [12, 1, 2, 5, 30])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    docs = [repeated(rng, rng.randint(1, 150), rng.choice([1, 2, 5, 40])) for _ in range(150)] + [[], [1] * 300]
    found = runs.runs_of([numbered(d) for d in docs], least)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [brute(d, least) for d in docs]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.lists(st.integers(1, 20), min_size=1, max_size=20), st.sampled_from([12, 3]))
def test_words_may_come_in_pieces_of_any_size(words, sizes, least):
    catchers, at = runs.Catchers(least), 0
    for k in range(len(words)):
        piece = words[at : at + sizes[k % len(sizes)]]
        catchers.append(np.array(piece, np.uint64) + np.uint64(1))
        at += len(piece)
        found = [(int(a), int(b - a), int(q)) for a, b, q in catchers.runs()]
        assert found == brute(words[:at], least)
        if at == len(words):
            break


def test_structured_words():
    thue, fib = [0], [[0], [0, 1]]
    for _ in range(9):
        thue += [1 - x for x in thue]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    for words in (thue, fib[-1], [0, 1] * 200 + [1, 0] * 150, [0] * 500):
        assert [tuple(r) for r in runs.runs_of([numbered(words)], 4)[0].tolist()] == brute(words, 4)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{x}" for x in repeated(rng, rng.randint(1, 120), rng.choice([2, 30, 500])))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (None, "a b " * 10), (None, None), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(300, "\xa0a \x1cb\x0b" * 30), (301, "long words of any kind " * 8000), (302, "\n".join(f"u{x}" for x in range(60_000)))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, key string, runs int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = query_runs.op12_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    plain = []
    for d, t in rows:
        if d in (301, 302):
            continue
        plain.append(expected(d, t))
    cells = [tuple(r[c] for c in names) for r in found.collect()]
    assert sorted((c for c in cells if c[0] not in (301, 302)), key=repr) == sorted(plain, key=repr)
    long = {c[0]: c for c in cells}
    assert long[301][1:5] == (1, 0, 40_000, 5) and long[302][1] == 0


def test_general_output(frame):
    df = frame("k string, t string, collapsed int", ("a", "x " + "p q r " * 5, 1), ("b", None, 2))
    found = {r.key: r for r in runs.periodic_runs(df, "k", "t").collect()}
    assert [tuple(r) for r in found["a"].runs] == [(1, 15, 3)] and found["a"].collapsed == "x p q r" and found["a"].n_words == 16
    assert found["b"].runs == [] and found["b"].collapsed == "" and found["b"].n_words == 0
    assert runs.periodic_runs(frame("k string, t string"), "k", "t").collect() == []
