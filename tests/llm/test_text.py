from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_text, language
from tidemark.llm.dom import blocks, features
from tidemark.llm.labelled_pages import PAGES
from tidemark.llm.query_text import FOLD, fold

SOUNDS = {"xx": "ka ru mi to lo".split(), "yy": "str pf eng och unt".split(), "zz": "ñe ció ala que dos".split()}


def speech(seed=3, n=120):
    pick = random.Random(seed)
    out = []
    for k in range(n):
        lang = pick.choice(sorted(SOUNDS))
        words = ["".join(pick.choice(SOUNDS[lang]) for _ in range(pick.randint(1, 3))) for _ in range(pick.randint(4, 60))]
        out.append((k, " ".join(words), lang, "s", 0.5))
    return out


DDL = "doc_id bigint, text string, lang string, source string, score double"


def test_codewords_are_apart():
    assert language.codebook(4).shape == (4, 7)
    for k in (2, 3, 7, 12):
        code = language.codebook(k).astype(int)
        assert (np.abs(code.sum(0)) < k).all()
        distance = [(code[a] != code[b]).sum() for a in range(k) for b in range(a)]
        assert min(distance) >= (code.shape[1] // 3 if k > 7 else 2 ** (k - 2))
    assert language.codebook(1).shape == (1, 0)


def test_language_of_held_out_texts(frame):
    df = frame(DDL, *speech())
    model = language.learn(df, "doc_id", "text", "lang", fold("doc_id") != FOLD)
    found = language.identify(df, "text", model).where(fold("doc_id") == FOLD).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(frame):
    df = frame(DDL, *speech())
    model = language.learn(df, "doc_id", "text", "lang", F.lit(True))
    odd = frame(DDL, (1, None, None, "s", 0.1), (2, "", "xx", "s", 0.1), (3, "12 ... 4!", "xx", "s", 0.1), (4, "karumi " * 20_000, None, "s", 0.1))
    found = {r.doc_id: r for r in language.identify(odd, "text", model).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 4)] == ["und", "und", "und", "xx"]
    assert found[4].score > 0.9 and not found[4].ambiguous
    assert [r.doc_id for r in language.with_language(odd, "text", model).collect()] == [4]
    assert language.with_language(odd, "text", model).columns == odd.columns
    none = language.learn(df, "doc_id", "text", "lang", F.lit(False))
    assert {r.lang_pred for r in language.identify(df, "text", none).collect()} == {"und"}
    one = language.learn(df.where("lang = 'xx'"), "doc_id", "text", "lang", F.lit(True))
    assert {r.lang_pred for r in language.identify(df, "text", one).collect()} == {"xx"}
    assert language.identify(df.limit(0), "text", model).collect() == []


def test_a_mixed_text_is_ambiguous_or_one_of_its_languages(frame):
    df = frame(DDL, *speech())
    model = language.learn(df, "doc_id", "text", "lang", F.lit(True))
    assert model.predict("karu pfstr")[0] in ("xx", "yy")
    # Letters that no language has: nothing but the blanks around them can tell.
    assert model.predict("w")[2] and not model.predict("karumi tolo kamiru")[2]


ITEM = "A train leaves Boston at 7 and travels 120 miles in 3 hours. How fast does Maria travel on the train?"
LEAK_DDL = "doc_id bigint, text string, key string, hash int"


def judged(frame, *texts, items=((1, ITEM),)):
    docs = frame(LEAK_DDL, *[(k, t, "k", 1) for k, t in enumerate(texts)])
    found = decontamination.leaks(docs, "doc_id", "text", frame("item_id bigint, text string", *items), "item_id", "text")
    return docs, found, {r.key: r for r in found.collect()}


def test_leaks(frame):
    docs, found, rows = judged(
        frame, "Well. " + ITEM + " Yes.", "So: a train leaves Denver at 9 and travels 450 miles in 5 hours! How fast does Peter travel on the train?",
        ITEM.upper(), None, "", "Nothing at all to see here today, my friend, so go home.", "x " * 5000 + ITEM, ITEM[:30],
        # One value of the question stands for two values here.
        "A train leaves Rome at 7 and travels 120 miles in 3 hours. How fast does Maria travel on the train? " * 1,
    )
    assert sorted(rows) == [0, 1, 2, 6, 8]
    assert rows[0].verbatim and not rows[1].verbatim and rows[0].coverage == 1.0
    assert [r.doc_id for r in decontamination.without_leaks(docs, "doc_id", found).orderBy("doc_id").collect()] == [3, 4, 5, 7]
    assert decontamination.without_leaks(docs, "doc_id", found).columns == docs.columns


def test_inconsistent_slots_are_no_leak(frame):
    item = "take 5 apples and then put 5 apples into one of 5 bags and add 5 more"
    good = item.replace("5", "8")
    bad = "take 1 apples and then put 2 apples into one of 3 bags and add 4 more"
    _, _, rows = judged(frame, good, bad, items=((1, item), (2, "short one"), (3, None), (None, item)))
    assert sorted(rows) == [0] and rows[0].item == 1


def test_one_clash_hides_nothing_but_its_windows(frame):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(60)]
    words[10] = words[50] = "1987"
    passage = " ".join(words)
    altered = " ".join([*words[:50], "1988", *words[51:]])
    # Two values of the question that are one value here.
    equal = ITEM.replace("7", "5").replace("3", "5")
    _, _, rows = judged(frame, altered, equal, passage, items=((1, passage), (2, ITEM)))
    assert sorted((r.key, r.item) for r in rows.values()) == [(0, 1), (1, 2), (2, 1)]
    assert not rows[0].verbatim and rows[0].n_windows < rows[0].item_windows and rows[2].verbatim


def test_dense_and_short_items(frame):
    items = ((1, "Add 3 kg 4 kg 5 kg 6 kg 7 kg then halve it"), (2, "What is 3 times 4?"), (3, "12 13 14 15 16 17 18"), (4, "Who is it?"))
    texts = (
        "Well: add 13 kg 24 kg 35 kg 46 kg 57 kg then halve it, please.", "what is 7 times 9", "Now what is 7 times 9 of all these",
        "1 2 3 4 5 6 7", "look at 12 13 14 15 16 17 18 here", "1 1 1 1 1 1 1", "WHO is it", "1 2 3 4 5 6 7 8", "",
    )
    _, _, rows = judged(frame, *texts, items=items)
    assert {(r.key, r.item, r.coverage) for r in rows.values()} == {(0, 1, 1.0), (1, 2, 1.0), (3, 3, 1.0), (4, 3, 1.0), (6, 4, 1.0)}
    assert rows[4].verbatim and not rows[0].verbatim


def test_leaks_of_empty_tables(frame):
    assert judged(frame)[2] == {}
    assert judged(frame, ITEM, items=())[2] == {}


def test_verbatim_items_are_found_by_brute_force(frame):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 6))) for _ in range(60)]
    say = lambda k: " ".join(pick.choice(words) for _ in range(k))
    items = [(k, say(pick.randint(12, 40))) for k in range(15)]
    texts = [say(pick.randint(0, 60)) + (" " + pick.choice(items)[1] + " " if pick.random() < 0.4 else " ") + say(20) for _ in range(80)]
    docs = frame(LEAK_DDL, *[(k, t, "k", 1) for k, t in enumerate(texts)])
    found = decontamination.leaks(docs, "doc_id", "text", frame("item_id bigint, text string", *items), "item_id", "text").collect()
    assert {(r.key, r.item) for r in found} == {(d, i) for d, t in enumerate(texts) for i, x in items if f" {x} " in t}


PROBLEMS = (
    "{a} has {x} apples. {a} buys {y} more at the market. How many apples does {a} have in the end?",
    "{a} walks {x} miles to school every day. {a} walks back the same way. How far does {a} walk in {y} days?",
    "A train leaves the station at {x} and drives {y} km to the coast. {a} waits there with {b} for it.",
    "{a} and {b} share {x} sweets between them. {b} eats {y} of them before lunch. How many are left for {a}?",
    "Every morning {a} fills {x} bottles with juice. {b} carries {y} of them to the shop down the road.",
)


def test_renamed_and_renumbered_problems_are_found(frame):
    pick = random.Random(3)
    names = ["Tom", "Alice", "Bob", "Maria", "Ahmed", "Yuki", "Olga", "Pedro", "Nina", "Igor"]

    def variant(k):
        a, b = pick.sample(names, 2)
        x, y = pick.sample(range(2, 99), 2)
        return PROBLEMS[k].format(a=a, b=b, x=x, y=y)

    filler = lambda: " ".join(pick.choice(["river", "stone", "green", "walks", "the", "of", "Tom", "miles"]) for _ in range(60)) + ". "
    items = [(k, variant(k)) for k in range(len(PROBLEMS))]
    docs = [(10 * k + j, filler() + variant(k) + " " + filler()) for k in range(len(PROBLEMS)) for j in range(8)]
    docs += [(1000 + j, filler() * 3) for j in range(30)]
    found = decontamination.leaks(
        frame("doc_id bigint, text string", *docs), "doc_id", "text", frame("item_id bigint, text string", *items), "item_id", "text"
    ).collect()
    pairs = {(r.key, r.item) for r in found}
    wanted = {(10 * k + j, k) for k in range(len(PROBLEMS)) for j in range(8)}
    assert len(pairs & wanted) >= 0.9 * len(wanted) and not pairs - wanted


def test_leaks_go_by_text_and_not_by_key(frame):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    rows = [(None, f"so {item} it is", "a"), (1, item, "b"), (1, "clean words of another row with the same key", "c"), (2, None, "d"), (None, "clean", "e")]
    docs = frame("doc_id bigint, text string, `_digest` string", *rows)
    kept = decontamination.clean_texts(docs, "text", frame("item_id bigint, text string", (5, item)), "item_id", "text")
    assert kept.columns == docs.columns and {r["_digest"] for r in kept.collect()} == {"c", "d", "e"}


@pytest.fixture(scope="module")
def field():
    return html_text.fit([(features(blocks(p)), [int(b.main) for b in blocks(p)]) for p in PAGES], steps=150)


def test_viterbi_is_the_best_of_all_paths(field):
    import itertools

    page = features(blocks(PAGES[1]))[:9]
    rows = field.scores(page)

    def value(path):
        return field.start[path[0]] + sum(rows[k][y] for k, y in enumerate(path)) + sum(field.step[a][b] for a, b in zip(path, path[1:], strict=False))

    assert abs(value(field.viterbi(page)) - max(map(value, itertools.product((0, 1), repeat=len(page))))) < 1e-9


def test_field_learns_its_pages(field):
    for page in PAGES:
        found = blocks(page)
        assert field.viterbi(features(found)) == [int(b.main) for b in found]


def test_blocks_of_broken_pages():
    page = "<p>One &amp; <b>two<br>three<p>four</div><!-- no --><script>var t='</p>';</script><ul><li>a<li>b</ul>&am tail &nbsp; x<p unfinished"
    assert [b.text for b in blocks(page)] == ["One & two three", "four", "a", "b", "&am tail x"]
    assert blocks(None) == blocks("") == blocks("<script>x") == []
    assert [b.text for b in blocks("<style>a</style>only text")] == ["only text"]
    assert [b.linked for b in blocks("<p><a href=x>link</a> rest</p>")] == [4]
    assert len(blocks("<div>" * 3000 + "deep")) == 1


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<p>Let <math><mi>x</mi></math> be 3.</p><noscript><p>Fallback.</p></noscript>", ["Let x be 3.", "Fallback."]),
        ("<p>A <object data=f.swf>film</object> here</p>", ["A film here"]),
        ('<p class=x">one</p><p>two</p><p>three "q"</p>', ["one", "two", 'three "q"']),
        ("<p data-x=it's>a</p><p>b</p>", ["a", "b"]),
        ('<p title = "b>c" id=\'d>e\'>w</p>', ["w"]),
        ('<p title=a=">q">r</p>', ['q">r']),
        ("<script src=a.js />var x=1;</script><p>t</p><style>a>b</style foo>s", ["t", "s"]),
        ("<!--><p>x</p><!-- a > b --!>y</ bogus>z", ["x", "yz"]),
        ("<div/>in</div>out<svg/>more<svg><text>s</text></svg>", ["in", "outmore"]),
        ('<p title="never closed', []),
    ],
)
def test_tags_end_where_html_ends_them(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_a_page_that_was_held_out():
    data = [(features(blocks(p)), [int(b.main) for b in blocks(p)]) for p in PAGES]
    right = total = 0
    for k, (page, labels) in enumerate(data):
        found = html_text.fit(data[:k] + data[k + 1 :], steps=100).viterbi(page)
        right += sum(a == b for a, b in zip(found, labels, strict=True))
        total += len(labels)
    assert right >= 0.8 * total


def test_long_pages_do_not_teach_but_are_labelled(frame):
    long = "<article>" + "".join(f"<p>Sentence number {k} has its words.</p>" for k in range(3000)) + "</article>"
    df = frame("page_id bigint, html string", (1, long), (1, PAGES[0]), (1, PAGES[0]), (2, None))
    found = html_text.main_text(df, "html", html_text.train(df, "page_id", "html")).collect()
    assert len(found) == 4 and max(r.text.count("\n\n") for r in found) >= 2950


def test_main_text(frame):
    pages = [(k, "u", PAGES[k % len(PAGES)], "old") for k in range(12)] + [(90, "u", None, "old"), (91, None, "", "old"), (92, "u", "<nav>x</nav>", "old")]
    df = frame("page_id bigint, url string, html string, text string", *pages)
    trained = html_text.train(df, "page_id", "html")
    found = {r.page_id: r for r in html_text.main_text(df, "html", trained).collect()}
    assert len(found) == len(pages) and [found[k].text for k in (90, 91, 92)] == ["", "", ""]
    for k in range(12):
        assert found[k].text == "\n\n".join(b.text for b in blocks(PAGES[k % len(PAGES)]) if b.main)
    assert html_text.main_text(df.limit(0), "html", html_text.train(df.limit(0), "page_id", "html")).collect() == []


def test_references_are_decoded_and_white_space_is_one_blank(field):
    page = "<article><h1>A&nbsp;b</h1><p>Tea &lt;3 caf&eacute;  &#8212;\n end. More words are here.</p></article>"
    assert html_text.extract(page, field) == "A b\n\nTea <3 café — end. More words are here."
