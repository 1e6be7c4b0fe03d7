from __future__ import annotations

import random

import numpy as np
import pytest
from brute import groups, repeats
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm import repeats as passages
from tidemark.llm import vector_search
from tidemark.llm.components import components
from tidemark.llm.keyset import key_set
from tidemark.llm.shingles import shingle_sets

DDL = "doc_id bigint, text string, node bigint, digit string"
WORDS = [a + b for a in "bcdfgk" for b in ("a", "e", "in", "or", "ul")]


def wrap(docs):
    return [(d, t, 1, "x") for d, t in docs]


def crowd(n=240, seed=9):
    """Groups of near and exact copies, shared passages, short, empty and null texts."""
    pick = random.Random(seed)
    say = lambda k: [pick.choice(WORDS) for _ in range(k)]
    bases, shared, out = [say(pick.randint(20, 120)) for _ in range(12)], say(40), []
    for _ in range(n):
        kind, words = pick.random(), list(pick.choice(bases))
        if kind < 0.5:
            for _ in range(pick.randint(0, 9)):
                words[pick.randrange(len(words))] = pick.choice(WORDS)
        elif kind < 0.7:
            words = say(pick.randint(3, 80)) + shared + say(pick.randint(3, 80))
        elif kind < 0.8:
            words = say(pick.randint(0, 5))
        text = pick.choice((" ", " ", "\n")).join(words)
        out.append(None if kind > 0.97 else text.upper() if kind > 0.9 else text)
    return list(enumerate(out))


def test_shingles_of_odd_texts():
    raw = [b"", b"  \t", b"one", b"A b C d e", b"a b c d e f", b"a b c d e a b c d e", "é É x\x1cy z w".encode()]
    edges = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    sets = shingle_sets(np.frombuffer(b"".join(raw) + bytes(16), np.uint8), edges)
    assert [len(s) for s in sets] == [0, 0, 1, 1, 2, 5, 1]
    assert sets[3][0] in sets[4]


def found_groups(frame, docs):
    rows = jaccard.near_duplicates(frame(DDL, *wrap(docs)), "doc_id", "text").collect()
    assert len(rows) == len(docs)
    return {r.key: (r.n_shingles, r.component_id) for r in rows}


def test_near_duplicates(frame):
    docs = crowd()
    assert found_groups(frame, docs) == groups(docs)


def test_near_duplicates_in_small_blocks(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMN_ROWS", 5)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    monkeypatch.setattr(jaccard, "DENSE_FROM", 3)
    monkeypatch.setattr(jaccard, "_DENSE_COLUMNS", 5)
    docs = crowd(120, 4)
    assert found_groups(frame, docs) == groups(docs)


def test_near_duplicates_at_the_threshold(frame):
    words = [f"w{k}" for k in range(40)]
    # 36 shingles; a set of 27 of them is just alike, one of 26 is not.
    docs = [(5, " ".join(words)), (3, " ".join(words[:31])), (8, " ".join(words[:30] + ["q"])), (9, "a b"), (1, "A  b"), (7, "b a")]
    assert found_groups(frame, docs) == groups(docs)
    assert groups(docs)[5] == (36, 3)


def test_shared_passages_do_not_chain_texts_together(frame, monkeypatch):
    pick, links = random.Random(3), []
    passages_ = [[f"p{k}x{j}" for j in range(16)] for k in range(8)]
    own_words = lambda k: [f"u{pick.randrange(10**9)}" for _ in range(k)]
    docs = []
    for k in range(160):
        # Two passages of twelve shingles each, of about seventy: far from alike, but in the prefix.
        a, b = pick.sample(passages_, 2)
        docs.append((k, " ".join(a + own_words(40) + b)))
    docs += [(200 + k, docs[k][1] + " more") for k in range(5)]
    monkeypatch.setattr(jaccard, "components", lambda df: links.append(df.count()) or components(df))
    assert found_groups(frame, docs) == groups(docs)
    assert links[0] < 40 and links[1] == 5


@pytest.mark.parametrize("percent", [60, 75])
def test_near_duplicates_of_short_texts(frame, percent):
    pick = random.Random(percent)
    docs = []
    for k in range(250):
        words = [pick.choice("abc") for _ in range(pick.randint(1, 24))]
        docs.append((k, " ".join(words)))
    rows = jaccard.near_duplicates(frame(DDL, *wrap(docs)), "doc_id", "text", percent).collect()
    expected = {}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, t in docs for w in [t.split()]}
    for d, one in sets.items():
        expected[d] = d
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if expected[b] < expected[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    expected[a], changed = expected[b], True
    assert {r.key: r.component_id for r in rows} == expected


def test_members_of_a_column_are_connected_as_they_fit(monkeypatch):
    pick = np.random.default_rng(5)
    for few in (64, 1):
        monkeypatch.setattr(jaccard, "_FEW", few)
        n = pick.integers(1, 40, 600)
        left = n - (pick.integers(0, 40, 600) % (n // 4 + 1))
        gram = np.sort(pick.integers(0, 90, 600))
        rows = sorted(set(zip(gram.tolist(), n.tolist(), left.tolist(), strict=True)))
        gram, n, left = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        times = pick.integers(1, 3, len(rows))
        batch = jaccard.pa.RecordBatch.from_arrays(
            [jaccard.pa.array(x) for x in (gram, n, left, np.arange(len(rows)), times)], names=["gram", "n", "left", "node", "times"]
        )
        parts = [batch.slice(k, 7) for k in range(0, len(rows), 7)]
        found = {(g, m, rest): first for out in jaccard._ties(75)(iter(parts)) for g, m, rest, first in zip(*(c.to_pylist() for c in out.columns), strict=True)}
        fits = lambda a, b: 175 * min(rows[a][2], rows[b][2], rows[a][1] - (rows[a][1] == rows[b][1])) >= 75 * (rows[a][1] + rows[b][1])
        first, changed = list(range(len(rows))), True
        while changed:
            changed = False
            for a in range(len(rows)):
                for b in range(a):
                    if rows[a][0] == rows[b][0] and first[a] != first[b] and fits(a, b):
                        first[a] = first[b] = min(first[a], first[b])
                        changed = True
        kept = {a for a in range(len(rows)) if first.count(first[a]) > 1 or times[a] > 1 and fits(a, a)}
        assert found == {rows[a]: first[a] for a in kept}


def test_near_duplicates_with_null_and_repeated_keys(frame):
    text = " ".join(WORDS)
    rows = [(None, text), (4, text), (4, text), (None, "alone in here"), (6, None), (6, None)]
    found = jaccard.near_duplicates(frame(DDL, *wrap(rows)), "doc_id", "text").collect()
    assert sorted((r.key or 0, r.n_shingles, r.component_id or 0) for r in found) == sorted(
        [(0, 26, 4), (4, 26, 4), (4, 26, 4), (0, 1, 0), (6, 0, 6), (6, 0, 6)]
    )
    assert jaccard.near_duplicates(frame(DDL), "doc_id", "text").collect() == []


def test_one_of_each_group(frame):
    docs = crowd(100, 2)
    rows = jaccard.one_of_each_group(frame(DDL, *wrap(docs), *wrap(docs[:3])), "doc_id", "text")
    assert rows.columns == ["doc_id", "text", "node", "digit"]
    assert sorted(r.doc_id for r in rows.collect()) == sorted(d for d, (_, c) in groups(docs).items() if c == d)


def test_one_of_each_group_decides_by_row(frame):
    text, near = " ".join(WORDS), " ".join(WORDS[:-1])
    other = "a text that is like nothing else in this table at all"
    back = WORDS[::-1]
    rows = [(1, text), (4, near), (4, other), (7, " ".join(back)), (7, " ".join(back[:-1])), (None, text), (None, "alone in here"), (None, "alone in here")]
    rows += [(8, None), (8, None), (None, None)]
    kept = jaccard.one_of_each_group(frame(DDL, *wrap(rows)), "doc_id", "text").collect()
    found = [(r.doc_id, r.text) for r in kept]
    assert [x[0] for x in found].count(7) == 1
    assert sorted(map(str, (x for x in found if x[0] != 7))) == sorted(map(str, [(1, text), (4, other), (None, "alone in here"), (8, None), (None, None)]))


def test_components(frame):
    pick = random.Random(3)
    chain = [(k, k + 1) for k in range(40)] + [(100, pick.randint(101, 160)) for _ in range(40)] + [(200, 201), (203, 201), (7, 7)]
    found = dict(components(frame("a bigint, b bigint", *chain)).collect())
    assert all(found[k] == 0 for k in range(41)) and found[203] == 200
    assert all(found[b] == 100 for a, b in chain if a == 100)


def test_key_set(spark):
    held = key_set(spark.range(0, 900, 3).select(F.xxhash64("id").alias("h")))
    hashes = np.array([r.h for r in spark.range(900).select(F.xxhash64("id").alias("h")).collect()])
    may = held.may_hold(hashes)
    assert may[::3].all() and may.sum() < 450


def passage_docs(seed=5, n=160):
    pick = random.Random(seed)
    say = lambda letters, k: "".join(pick.choice(letters) for _ in range(k))
    base, line, out = say("abcd ", 400), say("xyz", 80), []
    for _ in range(n):
        kind = pick.randint(0, 6)
        out.append({
            0: base[pick.randint(0, 100) : pick.randint(150, 400)], 1: say("ab", pick.randint(0, 300)), 2: "a" * pick.randint(0, 500),
            3: say("pqrst", 50) + line + say("pqrst", 50), 4: base[:200] + line + base[200:] + "é" * pick.randint(0, 80), 5: None,
            6: base[:120] + say("pq", 3) + base[120:],
        }[kind])
    return list(enumerate(out))


@pytest.mark.parametrize("rows", [(512, 64), (4, 2)])
def test_repeats(frame, monkeypatch, rows):
    monkeypatch.setattr(passages, "DIGIT_ROWS", rows[0])
    monkeypatch.setattr(passages, "ANCHOR_ROWS", rows[1])
    docs = passage_docs()
    df = frame(DDL, *wrap(docs)).repartition(5)
    found = passages.without_repeats(df, "doc_id", "text").collect()
    expected = repeats(docs)
    assert {r.key: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == {d: e[:4] for d, e in expected.items()}
    texts, kept = dict(docs), passages.trimmed(df, "doc_id", "text")
    assert kept.columns == df.columns and kept.count() == len(docs)
    for r in kept.collect():
        assert r.text == (texts[r.doc_id] if not expected[r.doc_id][1] else expected[r.doc_id][4].decode("utf-8", "ignore")) and r.digit == "x"


def test_repeats_in_other_sizes(frame, monkeypatch):
    monkeypatch.setattr(passages, "_TILE", 300)
    docs = [*passage_docs(8, 40), (40, "".join(random.Random(1).choices("ab", k=6000)))]
    found = passages.without_repeats(frame(DDL, *wrap(docs)), "doc_id", "text", length=24, gram=9).collect()
    assert {r.key: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == {d: e[:4] for d, e in repeats(docs, 24).items()}


def test_repeats_of_repeated_and_null_keys(frame):
    text = "".join(random.Random(2).choices("abcdef", k=300))
    rows = [(None, text), (2, text), (2, text), (2, "q" + text[:150]), (3, ""), (3, None)]
    found = passages.without_repeats(frame(DDL, *wrap(rows)), "doc_id", "text").collect()
    assert sorted((r.key or 0, r.n_bytes, r.n_removed) for r in found) == [(0, 300, 0), (2, 151, 150), (2, 300, 300), (2, 300, 300), (3, 0, 0), (3, 0, 0)]
    assert passages.without_repeats(frame(DDL), "doc_id", "text").collect() == []


def test_repeated_rows_are_one_document(frame):
    text = "".join(random.Random(6).choices("abcdef", k=200))
    found = passages.without_repeats(frame(DDL, *wrap([(1, text), (1, text)])), "doc_id", "text").collect()
    assert [(r.key, r.n_removed) for r in found] == [(1, 0), (1, 0)]


def search(frame, rows, k=5):
    df = frame("vec_id bigint, v array<bigint>, row string", *[(i, v, "r") for i, v in rows])
    return sorted(tuple(r) for r in vector_search.top_k(df, "vec_id", "v", F.col("vec_id") % 10 == 0, k).collect())


def every(rows, k=5):
    out = []
    for i, v in rows:
        if i is None or v is None or i % 10:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in rows if j is not None and w is not None and j != i and len(v) == len(w))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [16, 4096])
def test_top_k(frame, monkeypatch, shard):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(vector_search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(vector_search, "LEAF", 8)
    pick = random.Random(1)
    rows = [(i, [pick.randint(-3, 3) for _ in range(4)]) for i in range(130)]
    rows += [(i, [1, 2, 3, 4]) for i in range(130, 180)] + [(200, None), (None, [1, 1, 1, 1]), (210, [5, 5]), (211, [1, 5]), (220, [7])]
    assert search(frame, rows) == every(rows)
    assert search(frame, []) == []


def test_quantised(frame):
    rows = [(0, [0.5, -0.001]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [])]
    df = frame("id int, e array<float>", *rows).select("id", vector_search.quantised(F.col("e")).alias("v"))
    assert {r.id: r.v for r in df.collect()} == {0: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: None}


def test_bounds_hold_for_every_node():
    points = np.random.default_rng(2).integers(-9, 9, (300, 6)).astype(float)
    tree, queries = vector_search.KDTree(points, 8), np.random.default_rng(3).integers(-9, 9, (5, 6)).astype(float)
    bounds = tree.bounds(queries)
    for node, (a, b) in enumerate(tree.span):
        assert ((tree.sorted[a:b] @ queries.T).max(0) <= bounds[:, node]).all()
