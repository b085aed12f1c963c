from __future__ import annotations

import json
import pickle

import pytest
from pyspark.sql import functions as F

from pricequarry.functions import scalar as X
from pricequarry.plans import analytics as A
from pricequarry.plans import build as B
from pricequarry.plans import extract as E
from pricequarry.plans import star as S
from pricequarry.plans.filters import Filters, core_subset, drilled
from pricequarry.plans.trace import path_steps, resolve, verified


@pytest.fixture(scope="module")
def fact(spark, sf):
    return S.fact(spark, sf).cache()


def rounded(v):
    """Sums of floats depend on their order in the last digits."""
    return round(v, 9) if isinstance(v, float) else [rounded(x) for x in v] if isinstance(v, (list, tuple)) else v


def rows(df):
    return sorted(str([rounded(v) for v in r]) for r in df.collect())


def test_filters_are_values():
    f = Filters(codes=["b", "a"], states="TX", networks={"n"})
    assert f == Filters(codes=("a", "b"), states=("TX",), networks=("n",)) and hash(f) == hash(Filters.from_mapping({"codes": ["a", "b"], "states": "TX", "networks": "n", "zz": 1}))
    for bad in ({"counting_unit": "x"}, {"min_tag_confidence": "x"}, {"tag_types": ("x",)}):
        with pytest.raises(ValueError):
            Filters(**bad)
    with pytest.raises(TypeError):
        Filters(zz=1)
    with pytest.raises(AttributeError):
        f.codes = ()
    assert pickle.loads(pickle.dumps(f)) == f and dict(f)["states"] == ("TX",) and f.but(states=()) != f and "TX" in repr(f)


def test_which_filters_narrow_which():
    wide = Filters(codes=("a", "b"), search="heal", exclude_zero=False)
    assert wide.but(codes="a", search=" Health ").narrows(wide) and wide.narrows(wide)
    for other in ({"codes": ()}, {"codes": ("a", "c")}, {"search": "h"}, {"in_state_only": False}):
        assert not wide.but(**other).narrows(wide)
    assert not wide.narrows(wide, {"codes"}) and wide.narrows(wide, {"states"})


def test_narrower_filters_keep_fewer_rows(fact):
    n = lambda f: f.apply(fact).count()
    base = n(Filters())
    for change in ({"exclude_zero": False}, {"dollar_rates_only": False}, {"expected_scope_only": False}, {"billing_classes": ()}, {"exclude_expired": False}):
        assert n(Filters(**change)) >= base
    for change in ({"codes": ("90837",)}, {"search": "health"}, {"tag_types": ("platform",)}, {"places_of_service": ("11",)}):
        assert n(Filters(**change)) <= base


def test_core_gives_what_the_fact_gives(fact):
    core = core_subset(fact).cache()
    for f in (Filters(), Filters(codes=("90837",)), Filters(dollar_rates_only=False), Filters(tag_types=("none",)), Filters(counting_unit="npi")):
        assert f.within_core()
        for call in (lambda d, f=f: A.code_summary(d, f, "tag"), lambda d, f=f: A.histogram(d, f), lambda d, f=f: A.benchmarks(d, f), lambda d, f=f: A.entity_list(d, f, "tin"), lambda d, f=f: A.summarize(d, f, "network_code")):
            assert rows(call(core)) == rows(call(fact))
    assert not Filters(exclude_zero=False).within_core() and not Filters(billing_classes=()).within_core() and not Filters().within_core({"exclude_expired"})


def test_group_totals(fact):
    f = Filters()
    total = f.apply(fact).count()
    for by in ("code", "provider_type_code", "pos_group_code", "tag_code", "tin_code"):
        assert A.summarize(fact, f, by).agg(F.sum("n_rows")).first()[0] == total
    h = A.histogram(fact, f).groupBy("billing_code").agg(F.sum("n").alias("n"))
    u = A.unit_values(fact, f, ["billing_code"]).groupBy("billing_code").agg(F.count("v").alias("n"))
    assert rows(h) == rows(u)


def test_the_rows_behind_a_group(fact):
    for by in ("tin_code", "provider_type_code", "network_code", "tag_code"):
        group = A.summarize(fact, Filters(), by).orderBy(F.desc("n_rows"), *A.GROUPINGS[by]).filter(F.col(A.GROUPINGS[by][0]).isNotNull()).first().asDict()
        assert drilled(Filters(), group).apply(fact).count() == group["n_rows"]


def test_pages_and_totals(fact):
    n = A.total(fact, Filters()).first().n_total
    pages = [A.rate_explorer(fact, Filters(), k, 5000, "provider_name", "desc").count() for k in range(1, n // 5000 + 3)]
    assert sum(pages) == n and pages[-1] == 0
    pts = A.marker_radius(A.map_points(fact, Filters(), "90837")).orderBy("n_providers").collect()
    assert pts[-1].radius == 16.0 and pts[0].radius >= 4 and A.capped(A.map_points(fact, Filters(), "90837", 2), 2).first().capped


def test_unknown_options_raise(fact):
    for call in (lambda: A.code_summary(fact, Filters(), "x"), lambda: A.summarize(fact, Filters(), "x"), lambda: A.sort_key("x", "asc", ["y"]), lambda: A.suggest(fact, "x", "y")):
        with pytest.raises(ValueError):
            call()


def test_ranks_against_counting(spark):
    market = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 3, 10)] + [("b", 5.0), ("b", None)], "billing_code string, v double")
    pts = spark.createDataFrame([("a", 2.0), ("a", 0.0), ("a", 11.0), ("b", None), ("c", 1.0), ("a", 2.0)], "billing_code string, x double")
    got = sorted((r.billing_code, r.x if r.x is not None else -1.0, r.n_market, r.pct_below, r.pct_at_or_below, r.market_median) for r in A.ranked(pts, market, ["billing_code"], "x").collect())
    assert got == [("a", 0.0, 5, 0.0, 0.0, 2.0), ("a", 2.0, 5, 20.0, 60.0, 2.0), ("a", 2.0, 5, 20.0, 60.0, 2.0), ("a", 11.0, 5, 100.0, 100.0, 2.0), ("b", -1.0, 1, None, None, 5.0), ("c", 1.0, 0, None, None, None)]


def test_histogram_of_equal_values(spark, fact):
    one = fact.limit(0).unionByName(fact.filter("billing_code = '90837'").limit(5).withColumn("negotiated_rate", F.lit(7.0)))
    f = Filters(billing_classes=(), exclude_zero=False, dollar_rates_only=False, expected_scope_only=False, exclude_expired=False, counting_unit="row", exclude_invalid_npi=False, in_state_only=False)
    assert [(r.bucket, r.n) for r in A.histogram(one, f).collect()] == [(0, 5)]
    assert A.histogram(fact.limit(0), f).collect() == [] and A.code_summary(fact.limit(0), f).collect() == []


def test_numbers_are_gap_free(spark):
    df = spark.range(5000).selectExpr("id % 7 as a", "id as b")
    got = S.numbered(df, [F.col("a"), F.col("b")], "n", 6).orderBy("a", "b").select("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))


def test_dedup_merges_only_what_agrees(spark, sf):
    base = spark.read.parquet(f"{sf}/rates_npi.parquet").limit(1).withColumn("service_code", F.array(F.lit("11"), F.lit("02")))
    same = base.withColumn("service_code", F.array(F.lit("02"), F.lit("11"))).withColumn("network_name", F.array(F.lit("N2"))).withColumn("file_id", F.lit("other"))
    other = base.withColumn("negotiated_rate_raw", F.lit("9.990"))
    got = B.deduplicated(base.withColumn("network_name", F.array(F.lit("N1"), F.lit(None))).unionByName(same).unionByName(other.withColumn("network_name", F.lit(None).cast("array<string>")))).orderBy("n_sources").collect()
    assert [(r.n_sources, r.networks) for r in got] == [(1, None), (2, ["N1", "N2"])]
    lin = B.lineage(base.unionByName(same).unionByName(other))
    assert sorted(len(r.sources) for r in B.sources_list(lin).collect()) == [1, 2]


def test_small_builders(spark):
    with pytest.raises(ValueError, match="duplicate"):
        B.require_no_duplicates(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    g = spark.createDataFrame([("00601", 1.0, 2.0), ("00603", 3.0, 4.0)], "area string, lat double, lon double")
    x = spark.createDataFrame([("00601", "00603"), ("00700", "00603"), ("00700", "00601"), (None, "00601"), ("00800", None)], "zip string, area string")
    pts = B.zip_points(g, x)
    assert sorted(map(tuple, pts.collect())) == [("00601", 1.0, 2.0, "direct"), ("00603", 3.0, 4.0, "direct"), ("00700", 1.0, 2.0, "crosswalk")]
    p = spark.createDataFrame([("1", "00700", "00603"), ("2", "99999", "00603"), ("3", None, None)], "npi string, practice_zip5 string, mailing_zip5 string")
    assert sorted((r.npi, r.lat, r.point_source) for r in B.provider_points(p, pts).collect()) == [("1", 1.0, "first_crosswalk"), ("2", 3.0, "second_direct"), ("3", None, None)]
    a, b = spark.createDataFrame([("x",)] * 10 + [("y",)] * 10, "k string"), spark.createDataFrame([("x",)] * 11, "k string")
    assert sorted((r.k, r.n_now, r.breaks) for r in B.drift(a, b, "k").collect()) == [("x", 11, False), ("y", 0, True)]


def test_scalar_functions(spark):
    df = spark.createDataFrame([("1234567890\n", "2026", None, 15.0), ("1234567890", "2026-1-2", ["11", None, "19"], 95.0), (None, "12/31/2031", [], None)], "a string, d string, c array<string>, p double")
    got = df.select(X.valid_npi(F.col("a")).alias("v"), X.iso_date(F.col("d")).cast("string").alias("d"), X.place_group(F.col("c")).alias("g"), X.percentile_band(F.col("p")).alias("b"), X.zero_padded(F.lit("1234567"), 5).alias("z")).collect()
    assert [tuple(r) for r in got] == [(False, None, "unspecified", 0, "1234567"), (True, "2026-01-02", "all_settings", 5, "1234567"), (False, None, "unspecified", None, "1234567")]
    codes = spark.createDataFrame([(["a", "b"], ["N", "Y"]), (["a"], ["N"]), (["a", "b"], ["Y", "Y"]), (["", None], ["Y", "Y"]), (["a", "b"], [None, None])], "c array<string>, s array<string>")
    assert [tuple(r.x) for r in codes.select(X.primary_code(F.col("c"), F.col("s")).alias("x")).collect()] == [("b", "switch_Y"), ("a", "only_code"), (None, "ambiguous"), (None, "none"), (None, "ambiguous")]


ITEM = {
    "rates": [
        {"provider_references": [1, 99], "negotiated_prices": [{"negotiated_type": "negotiated", "negotiated_rate": "125.00", "service_code": "11"}, {"negotiated_type": "odd", "negotiated_rate": True, "x": 1}]},
        {"provider_groups": [{"npi": [1234567890, 5], "tin": {}}, {"npi": [], "tin": {"type": "ein"}}], "negotiated_prices": [{"negotiated_type": "percentage", "negotiated_rate": 0}]},
        {"negotiated_prices": []},
        7,
    ]
}


def test_extraction_and_trace(spark):
    text = json.dumps(ITEM["rates"]).replace('"125.00"', "125.00")
    items = spark.createDataFrame([("f", 4, "ffs", text), ("f", 5, "capitation", text), ("f", 6, None, None)], "file_id string, i long, negotiation_arrangement string, negotiated_rates string")
    r = E.rate_rows(items)
    got = sorted((x.j, x.k, x.r if x.r is not None else -1, x.provider_group_id, x.negotiated_rate_raw, x.negotiated_rate, x.rate_unit, x.is_zero_rate) for x in r.collect())
    assert got == [
        (0, 0, 0, "1", "125.00", 125.0, "dollars", False), (0, 0, 1, "99", "125.00", 125.0, "dollars", False), (0, 1, 0, "1", "true", None, "unknown", None), (0, 1, 1, "99", "true", None, "unknown", None),
        (1, 0, -1, "inline:4:1:0", "0", 0.0, "percent_of_billed_charges", True), (1, 0, -1, "inline:4:1:1", "0", 0.0, "percent_of_billed_charges", True),
    ]
    kinds = sorted(x.type for x in E.oddities(items.limit(1)).collect())
    assert kinds == ["missing_npi", "missing_tin", "not_a_list", "not_an_object", "npi_not_10_digits", "rate_not_a_number", "rate_without_prices", "rate_without_providers", "unknown_key", "unknown_negotiated_type"]
    v = verified(r, items.withColumnRenamed("negotiated_rates", "raw"), {"negotiated_rate_raw": "negotiated_rate"})
    assert {x.matches for x in v.collect()} == {True} and v.count() == 3
    wrong = verified(r.withColumn("negotiated_rate_raw", F.lit("1")), items.withColumnRenamed("negotiated_rates", "raw").limit(0), {"negotiated_rate_raw": "negotiated_rate"})
    assert {(x.matches, x.found) for x in wrong.collect()} == {(False, None)}


def test_capitation(spark):
    services = json.dumps([{"billing_code": "1", "billing_code_type": "CPT"}, {"billing_code": 2, "billing_code_type": "CPT"}, {"billing_code": "1", "billing_code_type": "X"}, 5])
    items = spark.createDataFrame([("f", 0, "capitation", services), ("f", 1, "ffs", services), ("f", 2, "capitation", None)], "file_id string, i long, negotiation_arrangement string, covered_services string")
    got = [(r.i, r.covered_target_codes, r.n_covered_services) for r in E.capitation_items(items, ["1", "2"], "CPT").orderBy("i").collect()]
    assert got == [(0, ["1", "2"], 4), (2, [], 0)]
    rows = [(r.i, r.c, r.billing_code, r.is_target_code) for r in E.covered_services(items, ["1"], "CPT").orderBy("c").collect()]
    assert rows == [(0, 0, "1", True), (0, 1, "2", False), (0, 2, "1", False)]


def test_paths():
    assert path_steps("a[1].b.c[2]") == ["a", 1, "b", "c", 2]
    for bad in ("", "[1]", "a..b", "a[x]", ".a", "a[1]b c"):
        with pytest.raises(ValueError):
            path_steps(bad)
    assert resolve({"a": [{"b": 5}]}, ["a", 0, "b"]) == 5 and resolve({"a": {"b": 5}}, ["a", 0, "b"]) == 5
    with pytest.raises(KeyError):
        resolve({"a": []}, ["a", 0])
    assert E.canonical_json('{"b": 1.50, "a": [true, null]}') == '{"a":[true,null],"b":1.50}' and E.canonical_json(None) is None
