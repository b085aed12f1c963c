from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import clashing

from pricequarry.llm.prose import outside_braces, prose, sentences
from pricequarry.llm.reading import Page, cut_points, graded, pages, reading_levels, train

DDL = "doc_id long, text string, lang string"


def page(band, rng):
    own = [f"{'abcd'[band - 1]}word{n}" .replace("0", "o").replace("1", "l") for n in range(40)]
    names = "".join(rng.choice("aeioubdgklmnrst") for _ in range(8))
    out = []
    for _ in range(14):
        n = 4 + 4 * band + rng.randrange(3)
        out.append(" ".join([rng.choice(own) if rng.random() < 0.6 else rng.choice(["the", "of", "and", "in"]) for _ in range(n)] + [names]) + ".")
    return "{{Infobox|name=x}}\n" + " ".join(out) + "\n{| class=x\n| cell\n|}\n[[Category:X]]"


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    return [(i, page(1 + i % 4, rng), "en") for i in range(n)]


def test_held_out_levels(spark):
    docs = corpus()
    labels = [(i, 1 + i % 4, "r") for i in range(0, 40)] + [(3, 3, "r2"), (None, 1, "r"), (5, None, "r"), (999, 2, "r")]
    d = spark.createDataFrame(docs, DDL)
    lab = spark.createDataFrame(labels, "doc_id long, band int, rater string")
    found = pages(d)
    got = {r.doc_id: r.band for r in reading_levels(found, train(found, lab)).collect()}
    assert len(got) == len(docs) and np.mean([got[i] == 1 + i % 4 for i in range(40, 120)]) > 0.95
    assert {r.doc_id: r.band for r in reading_levels(pages(clashing(d)), train(pages(clashing(d)), clashing(lab))).collect()} == got


def test_which_pages_have_a_level(spark):
    docs = corpus(40)
    d = spark.createDataFrame(docs, DDL)
    model = train(pages(d), spark.createDataFrame([(i, 1 + i % 4) for i in range(40)], "doc_id long, band int"))
    text = docs[1][1]
    odd = [(1, None, "en"), (2, "", "en"), (3, text, "de"), (4, text, None), (5, "{{x|" + text.replace("\n", " ") + "}}", "en"), (6, "one two. " * 29, "en"), (7, text, "en"), (7, text, "en"), (8, text * 300, "en")]
    got = sorted(r.doc_id for r in reading_levels(pages(spark.createDataFrame(odd, DDL)), model).collect())
    assert got == [7, 7, 8]
    assert reading_levels(pages(d.limit(0)), model).collect() == []
    none = spark.createDataFrame([(999, 2)], "doc_id long, band int")
    for empty in (train(pages(d), none), train(pages(d), none.limit(0)), train(pages(d.limit(0)), none)):
        assert reading_levels(pages(d), empty).collect() == []


def test_prose():
    text = "{{a|{{b}}|c}}'''Bold''' [[x|label]] text<ref>note {{c}}</ref> more.<!-- no -->\n== Head ==\n* item\n{|\n| t\n{|\n| u\n|}\n|}\nEnd&nbsp;here. [[File:a.jpg|thumb|cap [[b]]]]"
    assert [w for s in sentences(prose(text)) for w in s] == ["Bold", "label", "text", "more", "End", "here"]
    assert prose("#REDIRECT [[x]]") == "" and prose(None) == ""
    assert outside_braces("a {{ b") == "a " and outside_braces("a }} b") == "a }} b"
    assert outside_braces("{{" * 5000 + "x") == ""
    assert [len(s) for s in sentences("One two. Three! Four\n\nfive")] == [2, 1, 1, 1]


def test_grading_and_cuts():
    size = np.array([100.0, 100, 100, 100])
    df = {"the": np.array([90.0, 90, 90, 90]), "cat": np.array([50.0, 2, 0, 0]), "moot": np.array([0.0, 1, 60, 2]), "rare": np.array([0.0, 0, 0, 2])}
    assert graded(df, size) == {"the": 1, "cat": 1, "moot": 3}
    assert cut_points(np.array([1.0, 1.2, 1.9, 2.1, 3.0]), np.array([1, 1, 2, 2, 3]))[0] == pytest.approx(1.55)
    assert cut_points(np.array([1.0]), np.array([1])) == (1.5, 2.5, 3.5)
    assert Page.of(None).words == []
