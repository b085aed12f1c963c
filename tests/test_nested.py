from __future__ import annotations

import json

from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.sources.nested import RATES, SERVICES, Number, as_text, child_rows, children, flatten, group_npis, group_table, npi_table, parse, price_table, reference_table, service_table

IN_DDL = "file_id string, i long, negotiated_rates string, covered_services string"
PR_DDL = "file_id string, m long, provider_group_id string, provider_groups array<struct<npi:array<string>,tin:struct<type:string,value:string,business_name:string>>>"


def found(spark, items, references=()):
    a = spark.createDataFrame(items, IN_DDL)
    b = spark.createDataFrame(list(references), PR_DDL)
    return sorted(tuple(r) for r in children(a, b).collect())


def test_positions_lone_values_and_wrong_shapes(spark):
    rates = [None, 5, {"negotiated_prices": {"negotiated_rate": 1}, "provider_references": 7, "provider_groups": {"npi": 11}}]
    rates += [{"negotiated_prices": [None, "x", {"x_note": [{"negotiated_prices": [1]}]}], "provider_references": [None, "", 1.50, [2], {}], "previous": {"provider_references": [9]}}]
    got = found(spark, [("f", 3, json.dumps(rates), json.dumps({"billing_code": 9})), ("f", 3, json.dumps(rates), "[null, {}]")])
    p = "in_network[3].negotiated_rates"
    assert got == sorted([
        ("f", "price", f"{p}[2].negotiated_prices[0]", ""), ("f", "reference", f"{p}[2].provider_references[0]", "7"), ("f", "inline_npi", f"{p}[2].provider_groups[0].npi[0]", "11"),
        ("f", "price", f"{p}[3].negotiated_prices[2]", ""), ("f", "reference", f"{p}[3].provider_references[1]", ""), ("f", "reference", f"{p}[3].provider_references[2]", "1.5"),
        ("f", "covered_service", "in_network[3].covered_services[0]", "9"), ("f", "covered_service", "in_network[3].covered_services[1]", ""),
    ])


def test_number_text_is_kept():
    rows = child_rows('[{"provider_references": [1e2, 1.50, 100000000000000000001]}]', RATES, "negotiated_rates")
    assert [r[3] for r in rows if r[1] == "reference"] == ["1e2", "1.50", "100000000000000000001"]


def test_npis_of_references(spark):
    refs = [("f", 0, "1", [None, {"npi": ["a", None, "b"], "tin": None}, {"npi": None, "tin": None}]), ("f", 1, None, None), ("f", 2, "2", [])]
    got = found(spark, [("f", None, None, None)], [*refs, refs[0]])
    assert got == [("f", "npi", "provider_references[0].provider_groups[1].npi[0]", "a"), ("f", "npi", "provider_references[0].provider_groups[1].npi[2]", "b")]


def test_malformed_empty_long_and_clashing(spark):
    long = json.dumps([{"negotiated_prices": [{"additional_information": "x" * 300_000}]}])
    items = [("f", 0, "", ""), ("f", 1, "{", "nope"), (None, 2, long, None), ("f", 3, "[" * 3000, None)]
    a, b = spark.createDataFrame(items, IN_DDL), spark.createDataFrame([], PR_DDL)
    assert [tuple(r) for r in children(a, b).collect()] == [(None, "price", "in_network[2].negotiated_rates[0].negotiated_prices[0]", "")]
    assert children(a.limit(0), b).collect() == []
    assert children(clashing(a), clashing(b)).count() == 1
    assert len(price_table(a).collect()[0].additional_information) == 300_000


LEAF = st.none() | st.booleans() | st.integers(0, 99).map(str) | st.text(max_size=3)


@settings(max_examples=60, deadline=None)
@given(st.recursive(LEAF, lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["negotiated_prices", "provider_references", "provider_groups", "npi", "billing_code"]), x, max_size=3), max_leaves=12))
def test_against_plain_walk(root):
    listed = lambda v: v if isinstance(v, list) else [] if v is None else [v]
    scalar = lambda v: v is not None and not isinstance(v, (dict, list))
    want = []
    for j, rate in enumerate(listed(root)):
        if isinstance(rate, dict):
            want += [("price", (j, k)) for k, x in enumerate(listed(rate.get("negotiated_prices"))) if isinstance(x, dict)]
            want += [("reference", (j, k)) for k, x in enumerate(listed(rate.get("provider_references"))) if scalar(x)]
            for n, g in enumerate(listed(rate.get("provider_groups"))):
                if isinstance(g, dict):
                    want += [("inline_npi", (j, n, p)) for p, x in enumerate(listed(g.get("npi"))) if scalar(x)]
    rows = child_rows(json.dumps(root), RATES, "negotiated_rates")
    assert sorted((r[1], tuple(r[2])) for r in rows if r[1] not in ("rate", "inline_group")) == sorted(want)
    services = child_rows(json.dumps(root, indent=1), SERVICES, "covered_services")
    assert len(services) == sum(isinstance(x, dict) for x in listed(root))


def test_groups_of_references_are_rows_with_attributes(spark):
    refs = [("f", 0, "1", [None, {"npi": ["a", None, ""], "tin": {"type": "ein", "value": "9", "business_name": None}}]), ("f", None, None, [{"npi": ["b"], "tin": None}])]
    got = sorted((r.kind, r.child_path, r.parent_path, r.key, r.attributes.get("tin")) for r in group_npis(spark.createDataFrame(refs, PR_DDL)).collect())
    p, q = "provider_references[0].provider_groups[1]", "provider_references[].provider_groups[0]"
    assert got == [
        ("group", p, "provider_references[0]", "", '{"type":"ein","value":"9"}'), ("group", q, "provider_references[]", "", None),
        ("npi", f"{p}.npi[0]", p, "a", None), ("npi", f"{p}.npi[2]", p, "", None), ("npi", f"{q}.npi[0]", q, "b", None),
    ]


def test_numbers_in_lists_stay_numbers(spark):
    items = [("f", 0, '[{"negotiated_prices": {"service_code": [11, 1.50, "x", [2e1]], "billing_code_modifier": {"b": [1], "a": null}}}]', None)]
    (row,) = price_table(spark.createDataFrame(items, IN_DDL)).collect()
    assert (row.service_code, row.billing_code_modifier) == ('[11,1.50,"x",[2e1]]', '{"a":null,"b":[1]}')
    deep: list = []
    for _ in range(100_000):
        deep = [deep]
    assert as_text(deep) is None


def test_records_are_read_as_streams():
    deep = "[" * 50_000 + '"]"' + "]" * 50_000
    text = f'[{{"negotiated_prices": [{{"additional_information": {deep}, "setting": "x"}}]}}]'
    (_, price) = child_rows(text, RATES, "negotiated_rates")
    assert price[4] == {"additional_information": deep, "setting": "x"}
    twice = '[{"negotiated_prices": [{"a": 1}, {"a": 2}], "provider_references": [1], "negotiated_prices": [{"a": 3, "a": 4}]}, {"negotiated_prices": {"a": 5}}]'
    assert [(r[1], r[2], r[4].get("a")) for r in child_rows(twice, RATES, "negotiated_rates")] == [("rate", [0], None), ("reference", [0, 0], None), ("price", [0, 0], "4"), ("rate", [1], None), ("price", [1, 0], "5")]
    assert child_rows('{"negotiated\\u005fprices": {"\\"a\\\\": NaN}}', RATES, "negotiated_rates")[1][4] == {'"a\\': "NaN"}


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from('[]{},:"\\ na1'), max_size=12) | st.recursive(LEAF, lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["negotiated_prices", "x"]), x, max_size=2)).map(lambda v: json.dumps(v)[:-1]))
def test_what_is_no_json_is_told(text):
    rows = child_rows(text, RATES, "negotiated_rates")
    try:
        json.loads(text)
    except ValueError:
        assert not text.strip() or [r[1] for r in rows] == ["unreadable"]
    else:
        assert "unreadable" not in [r[1] for r in rows]


def test_each_kind_is_a_table(spark):
    rates = [{"provider_references": ["7", None], "provider_groups": [{"npi": [1], "tin": {"type": "ein", "value": 12}}]}]
    items = spark.createDataFrame([("f", 0, json.dumps(rates), json.dumps([{"billing_code": "A", "x": 1}, 5])), ("g", 0, "{", "[1")], IN_DDL)
    refs = spark.createDataFrame([("f", 2, "7", [{"npi": ["b"], "tin": None}])], PR_DDL)
    p = "in_network[0].negotiated_rates[0]"
    assert [tuple(r) for r in reference_table(items).collect()] == [("f", f"{p}.provider_references[0]", p, "7")]
    assert [tuple(r) for r in service_table(items).collect()] == [("f", "in_network[0].covered_services[0]", "in_network[0]", None, None, "A", None)]
    q = "provider_references[2].provider_groups[0]"
    assert sorted(tuple(r) for r in npi_table(items, refs).collect()) == [("f", f"{p}.provider_groups[0].npi[0]", f"{p}.provider_groups[0]", "inline_npi", "1"), ("f", f"{q}.npi[0]", q, "npi", "b")]
    assert sorted((r.child_path, r.kind, r.tin_type, r.tin_value) for r in group_table(items, refs).collect()) == [(f"{p}.provider_groups[0]", "inline_group", "ein", "12"), (q, "group", None, None)]
    told = flatten(items, ["file_id"], "negotiated_rates", "negotiated_rates", RATES).filter("kind = 'unreadable'").collect()
    assert [(r.file_id, bool(r.key)) for r in told] == [("g", True)] and isinstance(parse("1.0"), Number)
