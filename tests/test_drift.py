from __future__ import annotations

import json

from conftest import clashing

from pricequarry.sources.drift import field_types, promote, schema_changes, unified

DDL = "feed string, file_id string, file_date string, record_kind string, body string"


def feed(spark, files, kind="anomalies", name="f", extra=()):
    rows = [(name, fid, day, kind, b if isinstance(b, (str, type(None))) else json.dumps(b)) for fid, day, bodies in files for b in bodies]
    return spark.createDataFrame([*rows, *extra], DDL)


def log(df):
    return sorted((r.file_id, r.change, r.old_field, r.new_field) for r in schema_changes(df).collect())


def rec(row, **kw):
    return {"row": row, **kw}


def test_all_changes(spark):
    one = [rec(n, a=f"t{n}", b=n, gone=1, o={"x": n}) for n in range(6)]
    two = [rec(n, a2=f"t{n}", b=str(n), new=None, o={"x": [n]}) for n in range(6)]
    three = [rec(n, a2=f"t{n}", b=None, o={"y": [n]}) for n in range(6)]
    four = [rec(n, a2=f"t{n}", b=True, o={"y": [n]}) for n in range(6)]
    files = [("f4", "2030-04-01", four), ("f1", "2030-01-01", one), ("f2", "2030-02-01", [*two, two[0]]), ("f3", "2030-03-01", three)]
    assert log(feed(spark, files)) == [
        ("f2", "added", "", "new"), ("f2", "removed", "gone", ""), ("f2", "renamed", "a", "a2"), ("f2", "type_changed", "b", ""), ("f2", "type_changed", "o.x", ""),
        ("f3", "removed", "new", ""), ("f3", "renamed", "o.x", "o.y"), ("f4", "type_changed", "b", ""),
    ]


def test_chance_agreement_is_no_rename(spark):
    one = [rec(n, flag=n % 2 == 0) for n in range(20)]
    two = [rec(n, other=n % 3 == 0) for n in range(20)]
    assert log(feed(spark, [("f1", "2030-01-01", one), ("f2", "2030-02-01", two)])) == [("f2", "added", "", "other"), ("f2", "removed", "flag", "")]


def test_rename_of_sparse_field(spark):
    one = [rec(n, a=n) if n % 3 else rec(n) for n in range(30)]
    two = [rec(n, b=n) if n % 2 else rec(n) for n in range(30)]
    assert log(feed(spark, [("f1", "2030-01-01", one), ("f2", "2030-02-01", two)])) == [("f2", "renamed", "a", "b")]


def test_bad_bodies_nulls_and_empty(spark):
    files = [("f1", "2030-01-01", [rec(1, a=1), None, "{broken", "[1]", "", rec(2, a="x" * 200_000)]), ("f2", "2030-02-01", [None, "null"])]
    df = feed(spark, files, extra=[(None, None, None, None, None)])
    assert log(df) == [("f2", "removed", "a", ""), ("f2", "removed", "row", "")]
    assert log(df.limit(0)) == []
    assert log(clashing(df)) == log(df)


def test_feeds_and_kinds_are_apart(spark):
    a = feed(spark, [("f1", "2030-01-01", [rec(1, a=1)])], name="g")
    b = feed(spark, [("f2", "2030-02-01", [rec(1, b=1)])], name="h")
    c = feed(spark, [("f3", "2030-02-01", [{"i": 1, "j": 1, "c": 1}])], kind="rates", name="g")
    assert log(a.union(b).union(c)) == []


def test_unified_table(spark):
    files = [("f1", "2030-01-01", [rec(1, a="x", m=[1, 2], z=1.5, file_id=7)]), ("f2", "2030-02-01", [rec(2, b="y", m="s", z=None), rec(2, b="y", m="s", z=None), None])]
    df = feed(spark, files)
    renames = spark.createDataFrame([("anomalies", "renamed", "a", "b")], "record_kind string, change string, old_field string, new_field string")
    t = unified(df, "anomalies", renames=renames)
    assert t.count() == 4 and dict(t.dtypes)["m"] == "array<string>" and dict(t.dtypes)["z"] == "double" and dict(t.dtypes)["file_id_field"] == "double"
    rows = sorted((r for r in t.collect() if r.row is not None), key=lambda r: r.row)
    assert [(r.b, r.m, r.z) for r in rows] == [("x", ["1", "2"], 1.5), ("y", ["s"], None), ("y", ["s"], None)]
    assert {r.field: r.types for r in field_types(df).collect()}["m"] == ["array", "string"]


def test_types_of_long_numbers(spark):
    files = [("f1", "2030-01-01", ['{"row": 1, "a": ' + "9" * 3000 + "}", '{"row": 2, "a": NaN, "b": 1.5e3}']), ("f2", "2030-02-01", [rec(1, a="9", b=False)])]
    assert log(feed(spark, files)) == [("f2", "type_changed", "a", ""), ("f2", "type_changed", "b", "")]


def test_lattice():
    assert [promote(frozenset(x)) for x in ((), ("number",), ("boolean",), ("number", "string"), ("boolean", "number"), ("array", "number"))] == [
        "string", "double", "boolean", "string", "string", "array<string>"
    ]


def test_lists_of_numbers_in_a_list(spark):
    (row,) = unified(feed(spark, [("f1", "2030-01-01", ['{"row": 1, "m": [[11, 1.50], 2]}'])]), "anomalies").collect()
    assert row.m == ["[11,1.50]", "2"]


def test_losers_of_a_rename_are_matched_too(spark):
    one = [rec(n, a=1, b=1, c=1, d=n) for n in range(6)]
    two = [rec(n, x=1, y=1, z=1, e=n, w=-n) for n in range(6)]
    got = log(feed(spark, [("f1", "2030-01-01", one), ("f2", "2030-02-01", two)]))
    assert got == [("f2", "added", "", "w"), *[("f2", "renamed", o, n) for o, n in zip("abcd", "xyze", strict=True)]]


def test_any_number_of_renames_is_taken(spark):
    df = feed(spark, [(f"f{n}", f"2030-01-0{n}", [rec(n, **{f"a{n}": f"t{n}"})]) for n in range(1, 6)])
    pairs = [(f"a{n}", f"a{n + 1}") for n in range(1, 5)] + [(f"p{n}", f"q{n}") for n in range(200)]
    renames = spark.createDataFrame([("anomalies", "renamed", a, b) for a, b in pairs], "record_kind string, change string, old_field string, new_field string")
    t = unified(df, "anomalies", renames=renames, max_fields=6)
    assert [c for c in t.columns if c.startswith("a")] == ["a5"] and sorted(r.a5 for r in t.collect()) == [f"t{n}" for n in range(1, 6)]
