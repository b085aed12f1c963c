"""Table of contents, settings and the serving edge."""

from __future__ import annotations

import datetime as dt

import pytest

from pricequarry.plans import analytics as A
from pricequarry.plans import index as I
from pricequarry.plans import star as S
from pricequarry.plans.filters import Filters
from pricequarry.plans.service import Service, plain, provenance
from pricequarry.settings import Settings
from pricequarry.sources import json_items

# Three structures: one with two plans and a list of files, one whose only list is empty, one with odd shapes.
CONTENTS = """
{"version": "2.1", "reporting_entity_name": "Lakeside Mutual",
 "reporting_structure": [
  {"reporting_plans": [{"plan_name": "Silver Choice", "plan_id": "A-77", "plan_market_type": "individual"}, {"plan_name": "Bronze", "plan_id": 9001, "colour": "red"}],
   "in_network_files": [
     {"description": "Lake PPO (1 of 3)", "location": "https://files.lakeside.example/q3/LM_ppo_part1.json"},
     {"description": "Lake PPO (2 of 3)", "location": "https://files.lakeside.example/q3/LM_ppo_part2.json"},
     {"description": "Dental", "location": "https://mirror.example/dental.json?sig=first"}]},
  {"reporting_plans": [], "in_network_files": []},
  {"reporting_plans": {"plan_name": "Silver Choice Plus", "plan_id": "A-78"},
   "in_network_files": [null, {"description": "Dental network", "location": "https://mirror.example/dental.json?sig=second"}, {"description": "gone", "location": "  "}],
   "allowed_amount_file": [{"description": "out of network", "location": "https://mirror.example/oon.json"}, {"description": "again", "location": "https://mirror.example/dental.json"}],
   "remarks": []}],
 "last_updated_on": "2031-07-04", "signature": {"by": "x"}}
"""


def test_table_of_contents(spark, tmp_path):
    (tmp_path / "contents.json").write_text(CONTENTS)
    json_items.register(spark)
    rows = spark.read.format("json_items").option("lists", "reporting_structure").load(str(tmp_path)).cache()
    p = I.parts(rows).cache()
    refs = I.references(p).cache()
    found = I.files(refs, "LM_").cache()
    assert sorted((r.s, r.q, r.plan_id, r.plan_name) for r in I.plans(p).collect()) == [(0, 0, "A-77", "Silver Choice"), (0, 1, "9001", "Bronze"), (2, 0, "A-78", "Silver Choice Plus")]
    assert sorted((r.s, r.file_kind, r.f) for r in refs.collect()) == [(0, "in_network", 0), (0, "in_network", 1), (0, "in_network", 2), (2, "allowed_amount", 0), (2, "allowed_amount", 1), (2, "in_network", 1)]
    by_name = {r.file_name: (r.n_references, r.is_in_state_file, r.kind_conflict, r.host, list(r.descriptions)) for r in found.collect()}
    assert by_name == {
        "LM_ppo_part1.json": (1, True, False, "files.lakeside.example", ["Lake PPO (1 of 3)"]),
        "LM_ppo_part2.json": (1, True, False, "files.lakeside.example", ["Lake PPO (2 of 3)"]),
        "dental.json": (3, False, True, "mirror.example", ["Dental", "Dental network", "again"]),
        "oon.json": (1, False, False, "mirror.example", ["out of network"]),
    }
    assert found.filter("file_name = 'dental.json'").first().url.endswith("sig=first")
    counted = I.counters(p, refs, found).first()
    assert (counted.n_structures, counted.n_plans, counted.n_references, counted.n_files, counted.n_many_descriptions, counted.n_in_state) == (3, 3, 6, 4, 1, 2)
    odd = {(r.type, r.key): r.json_path for r in I.oddities(rows, p, found).collect()}
    assert odd == {
        ("unknown_key", "colour"): "reporting_structure[0].reporting_plans[1].colour", ("unknown_key", "remarks"): "reporting_structure[2].remarks", ("unknown_key", "signature"): "signature",
        ("blank_location", "location"): "reporting_structure[2].in_network_files[2]", ("file_kind_conflict", "https://mirror.example/dental.json"): None,
    }


@pytest.mark.parametrize(("asked", "plans", "rows"), [("silver", {"A-77", "A-78"}, 6), ("9001", {"9001"}, 3), ("bronze ", {"9001"}, 3), ("no such", set(), 0)])
def test_plans_are_found_by_name_or_id(spark, tmp_path, asked, plans, rows):
    (tmp_path / "contents.json").write_text(CONTENTS)
    json_items.register(spark)
    p = I.parts(spark.read.format("json_items").option("lists", "reporting_structure").load(str(tmp_path)))
    hits = I.find_plans(p, I.references(p), asked).collect()
    assert {r.plan_id for r in hits} == plans and len(hits) == rows


def test_files_are_counted_per_network(spark):
    refs = spark.createDataFrame([("Lake PPO (1 of 3)", "a"), ("Lake PPO 2 of 3", "b"), ("Lake PPO - 03 OF 3", "c"), ("Lake PPO", "a"), ("Top 5 of Ohio", "d")], "description string, file_key string")
    assert {r.network: r.n_files for r in I.files_per_network(refs).collect()} == {"Lake PPO": 3, "Top 5 of Ohio": 1}


def test_flat_export(spark):
    r = spark.createDataFrame([("f", "1", ["11", "02"], None), ("f", "9", None, ["GT"])], "file_id string, provider_group_id string, service_code array<string>, billing_code_modifier array<string>")
    g = spark.createDataFrame([("f", "1", "ein", "t", "n1"), ("f", "1", "ein", "t", "n2")], "file_id string, provider_group_id string, tin_type string, tin_value string, npi string")
    assert sorted((x.npi or "", x.service_code) for x in I.flat_export(r, g).collect()) == [("", None), ("n1", "11|02"), ("n2", "11|02")]


def test_settings(tmp_path):
    env = tmp_path / ".env"
    env.write_text("# c\nPRICEQUARRY_DATA_DIR='x'\nPRICEQUARRY_STORE_SECRET=abc\nPRICEQUARRY_KEEP_DATES=3\nOTHER=1\n")
    s = Settings.load(str(env), {"PRICEQUARRY_DATA_DIR": "y"})
    assert (s.data_dir, s.store_secret, s.keep_dates) == ("y", "abc", 3) and "abc" not in repr(s) and "***" in repr(s)
    for bad in ({"nope": 1}, {}):
        with pytest.raises(ValueError, match="unknown or missing"):
            Settings.from_mapping(bad, required=("state",))


def test_service(spark, sf):
    fact = S.fact(spark, sf)
    s = Service(fact, most=2)
    s.warm_up()
    a = s.call("code_summary", Filters())
    exact = lambda rows: sorted((r["billing_code"], r["n_rows"], r["n_units"], round(r["mean_rate"], 6)) for r in rows)
    assert s.hits == 1 and exact(a) == exact(map(plain, A.code_summary(fact, Filters()).collect()))
    s.call("summarize", Filters(), "code")
    s.call("histogram", Filters(), bins=5)
    s.call("code_summary", Filters())
    assert s.hits == 1  # the oldest answer had to go
    assert s.source("code_summary", Filters(exclude_zero=False)) is s.fact and s.source("histogram", Filters()) is s.core
    assert s.health()["ok"] and s.meta()["n_rates"] == fact.count() and not Service(fact.filter("assert_true(false) is null")).health()["ok"]
    with pytest.raises(ValueError, match="rows"):
        Service(fact, most_rows=1).call("summarize", Filters(), "npi_code")


def test_plain_values():
    assert plain({"a": [dt.date(2030, 1, 2), float("nan"), (1, float("inf"))]}) == {"a": ["2030-01-02", None, [1, None]]}
    assert set(provenance("/")) == {"commit", "dirty"}
