from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import vector_packing
from tidemark.llm.vector_packing import LOSS_STEP, Limits

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["one two three", "", None, " ", "it's a dog's life \x1c’œ 漢字", "word " * 700, "x" * 300, "a<|endoftext|>b", "y"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def power(n):
    return n & (n - 1) == 0


def follow(counts, limits, shorten=True):
    """Sequence -> its pieces (offset, tokens, loss), by following every number of every class through the plan."""
    rows = vector_packing.plan(counts, limits, shorten).tolist()
    ranges = defaultdict(list)
    for code, first, n, *where in rows:
        ranges[code].append((first, n, where))
    out = defaultdict(list)
    for code, n in counts.items():
        for number in range(n):
            at = (code, number)
            while at[0] >= 0:
                (hit,) = [(f, w) for f, m, w in ranges[at[0]] if f <= at[1] < f + m]
                past, (sequence, offset, take, rest, first) = at[1] - hit[0], hit[1]
                tokens, loss = (int(x[0]) for x in limits.demand(np.array([at[0]])))
                out[sequence + past].append((offset, take, take if loss == tokens else loss))
                at = (rest, first + past) if rest >= 0 else (-1, 0)
    return out


def check(out, limits, counts):
    for parts in out.values():
        at = 0
        for offset, take, _ in sorted(parts):
            assert offset == at
            at += take
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
    tokens, _ = limits.demand(np.array(sorted(counts)))
    assert sum(p[1] for parts in out.values() for p in parts) == sum(int(t) * counts[c] for t, c in zip(tokens, sorted(counts), strict=True))


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 30), max_size=10), st.integers(2, 9), st.booleans())
def test_uniform_pieces_leave_no_padding(sizes, segments, bearing):
    limits = Limits(32, segments, 32)
    counts = {t + 33 * bearing: n for t, n in sizes.items()}
    out = follow(counts, limits)
    check(out, limits, counts)
    assert all(power(sum(p[1] for p in parts)) for parts in out.values())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 200), st.floats(0, 1)), max_size=60), st.integers(2, 12), st.integers(40, 200))
def test_mixed_pieces_keep_all_limits(pieces, segments, loss):
    limits = Limits(200, segments, loss)
    cells = [(t, min(int(t * part), loss)) for t, part in pieces]
    counts = Counter()
    for t, bears in cells:
        if bears == t:
            counts[201 + t] += 1
        else:
            counts[t if not bears else 402 + t * limits._steps + -(-bears // LOSS_STEP)] += 1
    out = follow(counts, limits)
    check(out, limits, counts)


def test_the_dot_product_pairs_what_complements():
    # Long prompts with little loss and short answers that bear all of it: each sequence takes one of both.
    limits = Limits(100, 10, 40)
    little, all_loss = 202 + 64 * limits._steps + 1, 101 + 20
    out = follow({little: 20, all_loss: 20}, limits, False)
    check(out, limits, {little: 20, all_loss: 20})
    assert len(out) <= 21


def test_plan_is_tight_and_refuses_what_does_not_fit():
    random.seed(6)
    limits = Limits(1024, 64, 1024)
    counts = Counter(1025 + min(1024, int(random.lognormvariate(5.3, 1.2)) + 1) for _ in range(20_000))
    rows = vector_packing.plan(counts, limits)
    held = sum((c - 1025) * n for c, n in counts.items())
    assert (rows[:, 3] + rows[:, 2]).max() <= held // 1024 + 12
    with pytest.raises(ValueError):
        vector_packing.plan({2 * 1025 + 2000 * limits._steps: 1}, limits)
    with pytest.raises(ValueError):
        Limits(0, 1, 1)


def test_documents_round_trip(frame):
    rows = [(k, t, 5, "z") for k, t in enumerate(TEXTS)] + [(3, " ", 5, "z"), (None, "no key", 5, "z")]
    limits = Limits(64, 4, 64)
    df = frame("doc_id bigint, text string, `length` int, ids string", *rows)
    packed = vector_packing.pack(df, "doc_id", [("text", True)], PATH, limits, 1, with_ids=True)
    cells = packed.collect()
    texts = {k: t for k, t, *_ in rows}
    own = defaultdict(list)
    for c in cells:
        own[c.key].append(c)
        values = np.frombuffer(bytes(c.ids), "<u4").tolist()
        whole = [*ids(texts[c.key]), 1]
        assert values == whole[c.start : c.start + c.length] and c.doc_tokens == len(whole) and c.loss == c.length
        assert c.ids_crc32 == zlib.crc32(bytes(c.ids))
    for key, parts in own.items():
        copies = sum(1 for k, *_ in rows if k == key)
        assert sum(p.length for p in parts) == copies * (len(ids(texts[key])) + 1)
    held = defaultdict(list)
    for c in cells:
        held[c.sequence_id].append((c.offset, c.length, c.loss))
    assert all(power(sum(x[1] for x in parts)) and len(parts) <= 4 for parts in held.values())
    for r in vector_packing.sequences(packed).collect():
        assert r.segments == [x[1] for x in sorted(held[r.sequence_id])]
        assert len(r.ids) == 4 * sum(r.segments)
    slim = vector_packing.pack(df, "doc_id", [("text", True)], PATH, limits, 1)
    names = ["key", "start", "length", "ids_crc32"]
    assert Counter(tuple(c[n] for n in names) for c in slim.collect()) == Counter(tuple(c[n] for n in names) for c in cells)
    assert vector_packing.pack(frame("k int, t string"), "k", [("t", True)], PATH, limits, 1).collect() == []


def test_instructions(frame):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(["go", "stop", "left", "right"]) for _ in range(n))
    rows = [(f"c{k}", say(rng.randint(0, 40)), say(rng.randint(1, 20)) if k % 9 else None) for k in range(150)]
    rows += [("long", say(90), say(70)), ("answer", "", say(100))]
    limits = Limits(64, 5, 30)
    df = frame("id string, prompt string, response string", *rows)
    packed = vector_packing.pack(df, "id", [("prompt", False), ("response", True)], PATH, limits, 1, with_ids=True).collect()
    for key, prompt, response in rows:
        whole, bears = [*ids(prompt), *ids(response), 1], [0] * len(ids(prompt)) + [1] * (len(ids(response)) + 1)
        parts = sorted((c for c in packed if c.key == key), key=lambda c: c.start)
        assert sum((np.frombuffer(bytes(c.ids), "<u4").tolist() for c in parts), []) == whole
        assert [c.loss for c in parts] == [sum(bears[c.start : c.start + c.length]) for c in parts]
    for sequence in {c.sequence_id for c in packed}:
        own = [c for c in packed if c.sequence_id == sequence]
        assert sum(c.length for c in own) <= 64 and len(own) <= 5 and sum(c.loss for c in own) <= 30
