from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root of a list of digests, and for each of them its siblings, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(places):
            run = p - p % 3
            paths[k].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + 3])))
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
        places = [p // 3 for p in places]
    return nodes[0], paths


def plain(rows):
    """(source, doc_id, leaf) -> (subroot, root, path); rows in any order."""
    out, tops = {}, []
    groups = sorted({s for s, *_ in rows}, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        root, paths = tree([r[2] for r in own])
        tops.append((root, own, paths))
    root, above = tree([t[0] for t in tops]) if tops else (None, [])
    for (sub, own, paths), up in zip(tops, above, strict=True):
        for r, path in zip(own, paths, strict=True):
            out[r] = (sub, root, path + up)
    return out


def check(frame, rows, depth):
    df = frame("`group` string, doc_id bigint, leaf string, h string, `more` int", *[(*r, "x", 1) for r in rows])
    found = merkle.manifest(df, "group", ["doc_id"], "leaf", ["doc_id", "h"], depth)
    found = found.withColumn("fold", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    expected = plain(rows)
    assert len(found) == len(rows)
    for r in found:
        sub, root, path = expected[r.group, r.doc_id, r.leaf]
        assert (r.subroot, r.root, r.fold, r.h) == (sub, root, root, "x")
        assert [(s.left, s.right) for s in r.path] == path


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3}, {None: 10, "b": 28, "é": 1, "Z": 9}, {"s": 100, None: 2}])
def test_blocks_of_any_size_give_the_plain_tree(frame, sizes):
    rows = [(s, k, h(str(s), str(k))) for s, n in sizes.items() for k in range(n)]
    random.Random(3).shuffle(rows)
    check(frame, rows, 1)
    check(frame, rows, 2)


def test_many_groups_and_the_wide_blocks_of_production(frame):
    rows = [(f"s{k % 40}" if k % 3 else "hot", k, h(str(k))) for k in range(2400)]
    check(frame, rows, merkle.DEPTH)


def test_nulls_ties_and_empty_tables(frame):
    rows = [("a", None, h("1")), ("a", None, h("2")), (None, 5, h("3")), ("", 5, h("4")), ("a", 7, h("6")), ("a", 7, h("5"))]
    check(frame, rows, 1)
    none = frame("g string, k bigint, leaf string")
    assert merkle.manifest(none, "g", ["k"], "leaf", ["k"]).collect() == []
    equal = frame("g string, k bigint, leaf string", *[("a", 1, h("x"))] * 7)
    found = merkle.manifest(equal, "g", ["k"], "leaf", ["k"], 1).collect()
    assert len(found) == 7 and {r.subroot for r in found} == {tree([h("x")] * 7)[0]}


def test_fields_do_not_run_together(frame):
    df = frame("a string, b string", ("1", "23"), ("12", "3"), (None, "-"), ("-", None), ("é", ""), (None, None))
    found = [r[0] for r in df.select(merkle.digest(F.col("a"), F.col("b"))).collect()]
    assert found == [h("1:12:23"), h("2:121:3"), h("-1:-"), h("1:--"), h("2:é0:"), h("--")]


def test_a_changed_leaf_does_not_lead_to_the_root(frame):
    df = frame("g string, k bigint, leaf string, other string", *[("a", k, h(str(k)), h(str(k // 2 * 2))) for k in range(20)])
    found = merkle.manifest(df, "g", ["k"], "leaf", ["k", "other"], 2)
    cells = found.select("k", (merkle.fold(F.col("other"), F.col("path")) == F.col("root")).alias("same")).collect()
    assert all(c.same == (c.k % 2 == 0) for c in cells)
