from __future__ import annotations

import random

import numpy as np
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.llm.leakage import SEED, Passages, Shard, blocks, common, find_leaks, leaks, passage_words, suffix_array, without_leaks

RNG = random.Random(5)
VOCABULARY = [f"w{n}" for n in range(3000)]


def words(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def dressed(ws):
    forms = ["{}", "[[{}]]", "[[x (term)|{}]]", "'''{}'''", "{{{{nowrap|{}}}}}", "{}<ref name=\"a\" />", "{}&nbsp;", "<b>{}</b>"]
    return "  ".join(RNG.choice(forms).format(w.upper() if RNG.random() < 0.3 else w) for w in ws) + "."


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, passage string")
    return sorted((r.doc_id, r.item_id) for r in find_leaks(d, i, **kw).collect())


def test_forms_of_leaks(spark):
    items = [(n, words(60)) for n in range(12)]
    noise = lambda: " ".join(words(80))
    docs, want = [], []
    for n, ws in items:
        half, less = ws[20:50], ws[:29]
        changed = [w if k % 7 else "changed" for k, w in enumerate(ws)]
        forms = [
            (dressed(ws), True), (" ".join(half), True), (" ".join(ws[:16]) + noise() + " ".join(ws[40:56]), True), (" ".join(changed), True), (f"<!-- {' '.join(ws)} -->", True),
            (f"{{{{quote|text={' '.join(ws)}}}}}", True), (" ".join(less), False), (" ".join(ws[40:56]) + noise() + " ".join(ws[:12]), False), (" ".join(reversed(ws)), False),
        ]
        for k, (text, leak) in enumerate(forms):
            docs.append((n * 100 + k, f"{noise()}\n{text}\n{noise()}"))
            if leak:
                want.append((n * 100 + k, n))
    assert found(spark, docs, [(n, " ".join(ws)) for n, ws in items]) == sorted(want)
    assert found(spark, docs, [(n, " ".join(ws)) for n, ws in items], block_words=100, shard_words=500) == sorted(want)


def test_edges(spark):
    p = " ".join(words(40))
    docs = [(1, None), (2, ""), (3, "a b"), (4, p), (4, p), (None, p), (5, "x " * 300_000 + p)]
    items = [(1, p), (2, None), (3, ""), (4, "a b c"), (5, p)]
    got = [(1 if a is None else a, b) for a, b in ((r.doc_id, r.item_id) for r in find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string")).collect())]
    assert sorted(got) == sorted([(4, 1), (4, 5)] * 2 + [(1, 1), (1, 5), (5, 1), (5, 5)])
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, passage string")
    assert find_leaks(d.limit(0), i).count() == 0 and find_leaks(d, i.limit(0)).count() == 0
    assert find_leaks(clashing(d), clashing(i)).count() == 8
    assert {r.doc_id for r in without_leaks(d, find_leaks(d, i)).collect()} == {1, 2, 3, None}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_suffix_array_is_in_order(numbers, longest):
    text = np.array([*numbers, 0], np.uint32)
    got = suffix_array(text, 1 << 20).tolist()
    unlike = [x or 10 + i for i, x in enumerate(text.tolist())]  # no two 0 are the same
    assert got == sorted(np.flatnonzero(text).tolist(), key=lambda i: unlike[i:])
    short = [unlike[i : i + longest] for i in suffix_array(text, longest)]
    assert short == sorted(short)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=20), min_size=1, max_size=3))
def test_longest_matches_and_their_locations(numbers, items):
    names = ["", "a", "b", "c"]
    ps = Passages([(n, [names[w] for w in ws]) for n, ws in enumerate(items)])
    text = ps.numbers([names[w] or "other" for w in numbers]).tolist() + [0]
    want = []
    for n, ws in enumerate(ps.words):
        ws = ws.tolist()
        for i in range(len(text)):
            for j in range(len(ws)):
                k = 0
                while j + k < len(ws) and text[i + k] == ws[j + k]:
                    k += 1
                if k >= min(SEED, len(ws)) and (i == 0 or j == 0 or text[i - 1] != ws[j - 1]):
                    want.append((n, j, i, k))
    got = [(int(ps.item[q]), int(ps.at[q]), int(i), int(k)) for part in Shard(np.array(text, np.uint32), ps).matches() for q, i, k in zip(*part, strict=True)]
    assert sorted(got) == sorted(want)


def held_in(doc, passage, share=0.5):
    ps = Passages([(7, passage)])
    return [(n, k) for _, _, n, k in leaks([ps.numbers(words(30)), ps.numbers(doc)], ps, share)]


def test_longest_match_is_reported():
    p = words(50)
    assert held_in([*words(20), *p[:35], *words(20)], p) == [(35, 35)]


def test_many_changed_words():
    p = [f"p{n}" for n in range(80)]
    every = lambda m, *spared: [w if n % m or n in spared else f"other{n}" for n, w in enumerate(p, 1)]
    assert held_in(every(4), p) == [(79, 3)] and held_in(every(4, 40), p) == [(79, 7)]
    assert held_in(every(5), p) == [(79, 4)]
    assert held_in(every(3), p) == [] and held_in(p[:39], p) == [] and held_in([*p[:20], *words(40), *p[60:]], p) == [(40, 20)]
    # a changed word next to the passage's last, or with two behind it that agree
    assert held_in([*words(9), *p[40:78], "x", p[79], *words(9)], p) == [(40, 38)]
    assert held_in([*words(9), *p[10:47], "x", *p[48:50], *words(9)], p) == [(40, 37)]


def test_a_repeated_phrase_doesnt_take_a_match_apart():
    p = [*(f"p{n}" for n in range(41)), "p2", "p3", "p4", *(f"q{n}" for n in range(12))]
    assert held_in([*words(9), *p[:40], *words(30)], p) == [(40, 40)]


def test_short_passages_must_stand_whole():
    assert held_in(["a", "b", "c"], ["b", "c"]) == [(2, 2)] and held_in(["b", "x", "c"], ["b", "c"]) == [] and held_in(["q"], ["q"]) == [(1, 1)]


def test_many_items_are_one_block():
    block = list(blocks(iter([(n, " ".join(f"w{n}x{k}" for k in range(300))) for n in range(400)]), 4_000_000))
    ps = Passages(block[0])
    assert len(block) == 1 and len(ps.number) == 120_000
    doc = [f"w399x{k}" for k in range(100, 260)]
    assert [r[1:] for r in leaks([ps.numbers(doc)], ps, 0.5)] == [(399, 160, 160)]
    assert [len(b) for b in blocks(iter([(1, "a b c"), (2, "a b"), (3, None), (4, "a b c d e f"), (5, "a")]), 5)] == [3, 1, 1]


def test_words_without_markup():
    assert passage_words("''It''s&nbsp;[[Foo (x)|bar]]s{{dubious}} <!-- c --> thea\xadtre A1") == ["its", "bars", "c", "theatre", "a1"]
    assert passage_words(None) == [] and common([1, 2, 3], [1, 3]) == 2


def test_repeated_phrases(spark):
    rep, other = " ".join(["no"] * 40), " ".join(words(50))
    docs = [(1, "no " * 100_000), (2, "no " * 19), (3, "no no no yes " * 20_000), (4, other)]
    # the third has all the words in order, with others put in between
    assert found(spark, docs, [(1, rep), (2, other), (3, " ".join(["a", "b"] * 20))]) == [(1, 1), (3, 1), (4, 2)]
