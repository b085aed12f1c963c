from __future__ import annotations

import itertools

import pytest
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricequarry.llm import linkage as L
from pricequarry.llm.names import PLAIN, Vocabulary, abbreviates, alike_core, monge_elkan, osa, same_core, word_counts

parse, same_owner = PLAIN.parse, PLAIN.same_owner

VARIANTS = {
    "a": ["DROTHOMAWA PSYCHIATRY ASSOCIATES CORP", "Psych Assocs - Drothomawa Corp.", "DROTHOMAAW  PSYCHIATRY ASSOCIATES, CORPORATION", "DrothomawaPsychiatry Associates (TX)"],
    "b": ["DROTHOMAWA CARDIOLOGY NETWORK LP", "Drothomawa Cardio Ntwk", "CARDIOLOGY NETWORK OF DROTHOMAWA LP SITE 04"],
    "c": ["SAINT RAMAGALRI AUTISM THERAPY ASSOCIATES PA", "St. Ramagalri Autism Thrpy Assoc P.A. dba Ramagalri"],
    "d": ["LAWRENCE S LORSTAKAGA PMHNP", "DR LARRY LORSTAKAGA", "LORSTAKGAA, LAWRENCE", "L. Lorstakaga, P.M.H.N.P."],
    "e": ["SUSAN LORSTAKAGA LPC", "Lorstakaga Sue P L L C"],
}


def test_variants_agree_and_others_dont():
    names = [(k, parse(n)) for k, ns in VARIANTS.items() for n in ns]
    for (k, x), (m, y) in itertools.combinations(names, 2):
        assert same_owner(x, y) == (k == m), (x, y)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_edits_are_symmetric_and_bounded(a, b):
    assert osa(a, b, 3) == osa(b, a, 3) <= 4
    assert (osa(a, b, 3) == 0) == (a == b)


def test_words():
    assert abbreviates("MEDCN", "MEDICINE") and abbreviates("PEDS", "PEDIATRIC") and not abbreviates("X", "XY") and not abbreviates("MEDICINE", "MED")
    assert monge_elkan((), ("A",), alike_core) == 0 and monge_elkan(("AB", "CD"), ("CD", "AB"), alike_core) == 1
    assert parse("") is None and parse("LLC, P.A.") is None and parse("...") is None
    assert parse("x" * 50_000) is not None


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("HOUSTON DENTAL GROUP", "HOUSTON MENTAL HEALTH GROUP", False), ("ALAMO RADIOLOGY ASSOCIATES", "ALAMO CARDIOLOGY ASSOCIATES", False),
        ("EAST HOUSTON PSYCHIATRY", "WEST HOUSTON PSYCHIATRY", False), ("BRAZOSLAND HOSPITAL", "BRAZOSLND HOSPITAL", True), ("BRAZOSLAND ONCOLOGY CLINIC", "BRAZOSLAND ONCOLGY CLINC", True),
        ("MORNINGSTAR CLINIC", "MORNINGSTR CLINIC", True), ("MORNINGSTAR CLINIC", "MORNINGSTAR INC", False), ("MORNINGSTAR DIALYSIS CLINIC", "MORNINGSTAR HOSPICE CLINIC", False),
        ("GARCIA ROSALINDA", "ROSALINDA GARCYA", True), ("GARCIA ROSALINDA", "GARCIA ESTEBAN", False),
    ],
)
def test_pairs_of_names(a, b, same):
    assert same_owner(parse(a), parse(b)) == same_owner(parse(b), parse(a)) == same


def test_common_words_are_learned():
    trades, forms = ["FALCONRY", "BASKETRY", "GLAZING", "TANNING"], ["GUILD", "WORKSHOP"]
    names = [f"OWNER{chr(65 + n % 26)}{chr(65 + n // 26)}X {trades[n % 4]} {forms[n % 2]}" for n in range(600)]
    names += ["OWNERZZX FLCNRY GUILD"] * 3
    v = Vocabulary.learned(word_counts(names), len(names))
    assert {*trades, *forms} <= v.share.keys() and v.share["GUILD"] > v.share["FALCONRY"] and v.weight("FALCONRY") > v.weight("GUILD")
    one, short, other = v.parse("OWNERZZX FALCONRY GUILD"), v.parse("Ownerzzx Flcnry"), v.parse("OWNERZZX TANNING GUILD")
    assert one.core == short.core == ("OWNERZZX",) and v.same_owner(one, short) and not v.same_owner(one, other)
    many = Vocabulary.learned({"DENTAL": 40, "FALCONRY": 900, "FALCONRYS": 300, "RARE": 5}, 9000)
    assert many.share.keys() == {"DENTAL", "FALCONRY"}


def test_bands_reach_the_recall():
    for s, recall in ((0.4, 0.95), (0.5, 0.99)):
        b = L.bands_for(s, recall, 4)
        assert 1 - (1 - s**4) ** b >= recall > 1 - (1 - s**4) ** (b - 1)


def linked(spark, names, people=()):
    n = spark.createDataFrame(list(names), "key string, name string")
    p = spark.createDataFrame(list(people), "last_name string, first_name string")
    return n, p


def pairs(n, p):
    return sorted(tuple(r) for r in L.key_pairs(L.linked_keys(n, p)).collect())


def test_keys_of_one_owner(spark):
    names = [(f"{k}{i}", x) for k, xs in VARIANTS.items() for i, x in enumerate(xs)]
    names += [("a0", VARIANTS["a"][1])] * 3 + [(None, VARIANTS["a"][0]), ("z", None), ("y", "LLC")]
    n, p = linked(spark, names)
    want = [(f"{k}{i}", f"{k}{j}") for k, xs in VARIANTS.items() for i, j in itertools.combinations(range(len(xs)), 2)]
    assert pairs(n, p) == sorted(want)
    assert pairs(clashing(n), clashing(p)) == sorted(want)
    assert pairs(n.limit(0), p) == []


def test_stand_ins_link_nothing(spark):
    names = [("t1", "KELVARO SLEEP MEDICINE GROUP"), ("t1", "MIYAMIDRO RICHARD"), ("t2", "ZOLVARA PAIN MANAGEMENT"), ("t2", "Miyamidro, R."), ("t3", "MIYAMIDRO RICK"), ("t4", "MIYAMIDRO RICHARD")]
    n, p = linked(spark, names, [("MIYAMIDRO", "RICHARD"), (None, "X")])
    assert pairs(n, p) == []


def test_large_bucket_has_no_all_pairs(spark):
    cores = spark.range(600).selectExpr("'PRAQUELVORNA' || chr(int(65 + id % 26)) || chr(int(65 + id div 26)) as core")
    n = L.band_pairs(cores, chunk=8).count()
    assert 0 < n < 600 * 599 / 2 * 0.6


def test_star_clusters(spark):
    nodes = spark.createDataFrame([(x, 1) for x in "abcdefg"], "core string, weight long")
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("c", "d"), ("e", "f")], "a string, b string")
    got = {r.core: r.center for r in L.stars(nodes, edges).collect()}
    # a and c tie in degree, the lot decides: the neighbour that has only the loser is left to itself
    assert got.pop("e") == got.pop("f") in ("e", "f") and got.pop("g") == "g"
    assert got in ({"c": "c", "a": "c", "d": "c", "b": "b"}, {"a": "a", "b": "a", "c": "a", "d": "d"})


def test_a_long_path_of_cores_is_clustered_in_few_rounds(spark):
    edges = spark.range(3000).selectExpr("lpad(id, 5, '0') as a", "lpad(id + 1, 5, '0') as b")
    got = {r.core: r.center for r in L.stars(spark.range(3001).selectExpr("lpad(id, 5, '0') as core"), edges).collect()}
    assert len(got) == 3001 and all(abs(int(k) - int(v)) <= 1 for k, v in got.items())
    assert all(got[v] == v for v in got.values())


def test_large_stars_are_taken_in_parts(spark):
    names = spark.createDataFrame([(f"org|KELVAROMI|{' '.join(sorted(w))}|", "KELVAROMI", n) for n, w in enumerate(itertools.combinations(["SLEEP", "SPINE", "SKIN", "PAIN", "RENAL", "HAND"], 2))], "node string, core string, weight long")
    def classes(part_of):
        found = L.owners(names, part_of=part_of)
        linked = L.components(found.toDF("key", "owner").unionByName(found.select(F.col("owner").alias("key"), "owner")))
        return {frozenset(r.keys) for r in linked.groupBy("component").agg(F.collect_set("key").alias("keys")).collect()}

    assert classes(5000) == classes(4)


def test_components(spark):
    links = spark.createDataFrame([(f"k{i}", f"o{i}") for i in range(9)] + [(f"k{i}", f"o{i + 1}") for i in range(8) if i != 4], "key string, owner string")
    got = {r.key: r.component for r in L.components(links).collect()}
    assert {got[f"k{i}"] for i in range(5)} == {"k0"} and {got[f"k{i}"] for i in range(5, 9)} == {"k5"}
    assert L.components(links.limit(0)).collect() == []


def test_long_chains_settle(spark):
    n = 10_000
    links = spark.range(n).selectExpr("explode(array(struct('k' || lpad(id * 7919 % 10000, 5, '0') as key, 'o' || id as owner), struct('k' || lpad((id + 1) * 7919 % 10000, 5, '0') as key, 'o' || id as owner))) as x").select("x.*")
    got = L.components(links).groupBy("component").count().collect()
    assert [(r.component, r["count"]) for r in got] == [("k00000", n)]


@pytest.mark.parametrize("text", ["Ångström Clinic PA", "O'BRIEN, D'AREL M.D.", "  ", "1 2 3"])
def test_odd_names_parse(text):
    parse(text)


def test_no_link_is_lost_to_the_choice_of_centres(spark):
    # KELVAROMI is one edit from each of the others, which are two apart; the heaviest isn't the one in the middle
    names = [("a", "KELVAROMI PSYCHIATRY GROUP"), *[("b", "KELVARRMI PSYCHIATRY GROUP")] * 9, ("c", "KELVAOOMI PSYCHIATRY GROUP"), ("d", "KELVAROMI CARDIOLOGY GROUP"), ("e", "KELVARO1I CARDIOLOGY")]
    n, p = linked(spark, names)
    assert pairs(n, p) == [("a", "b"), ("a", "c"), ("b", "c"), ("d", "e")]


def test_a_large_bucket_loses_no_pair(spark):
    stems = [f"PRAQUELVORNA{x}{y}" for x in "ABCDEFGHIJ" for y in "KLMNOPQR"]
    cores = [*stems, *[f"{w[1:]}" for w in stems[:9]], *[f"ZEBULON {w}" for w in stems[::7]], *[f"{w} ZEBULONE" for w in stems[::5]], "PRAQUELVORNA", "PRAQUE"]
    want = {tuple(sorted(p)) for p in itertools.combinations(cores, 2) if same_core(*(tuple(c.split()) for c in p))}
    got = {tuple(r) for r in L.similar_cores(L.candidates(spark.createDataFrame([(c,) for c in cores], "core string"), chunk=8)).collect()}
    near = {tuple(r) for r in L.similar_cores(L.near_pairs(spark.createDataFrame([(c,) for c in cores], "core string"), block=16)).collect()}
    assert near == want
    # PRAQUE and ZEBULON ... share no band value with the others by chance; of those that do none is lost
    assert got <= want and {p for p in want if set(p) <= set(stems)} <= got


EDITS = st.lists(st.tuples(st.sampled_from("ixrs"), st.integers(0, 60), st.sampled_from("AB")), max_size=2)


@settings(max_examples=400, deadline=None)
@given(st.text("AB", min_size=1, max_size=9) | st.text("ABCD", min_size=10, max_size=60), EDITS, st.integers(0, 60))
def test_similar_words_have_a_spelling_in_common(a, edits, cut_at):
    b = a
    for kind, i, c in edits:
        i %= len(b) + 1
        b = {"i": b[:i] + c + b[i:], "x": b[:i] + b[i + 1 :], "r": b[:i] + c + b[i + 1 :], "s": b[:i] + b[i + 1 : i + 2] + b[i : i + 1] + b[i + 2 :]}[kind]
    for other in (b, a[: cut_at + 1]):
        if other and alike_core(a, other):
            x, y = L.spellings(a), L.spellings(other)
            assert {k for k, _ in x} & {k for k, whole in y if whole} or {k for k, whole in x if whole} & {k for k, _ in y}


def test_no_link_is_lost_to_the_choice_of_owners(spark):
    # the second agrees with the first and the third, which differ; the first, the heaviest, becomes its only owner
    names = [*[("a", "KELVAROMI PSYCHIATRY GROUP")] * 9, *[("b", "KELVAROMI PSYCHIATRY CARDIOLOGY GROUP")] * 5, ("c", "KELVAROMI CARDIOLOGY GROUP"), ("d", "KELVAROMI SLEEP GROUP")]
    n, p = linked(spark, names)
    assert pairs(n, p) == [("a", "b"), ("a", "c"), ("b", "c")]
