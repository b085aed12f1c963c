from __future__ import annotations

import csv
import datetime as dt
import io

from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.sources.dirty_csv import ANOMALIES, loaded, rejected

DDL = "line_id long, record_kind string, line string"
GOOD = '1234567890,1,,Doe,Jo,MD,"1 ""A"" St, 2",Town,TX,12345,01/31/2020,'


def reasons(spark, lines, kind="nppes"):
    df = spark.createDataFrame([(n, kind, x) for n, x in enumerate(lines)], DDL)
    return {r.line_id: r.reason for r in rejected(df).collect()}


def test_reasons_in_order(spark):
    bad = {
        "broken_quoting": ['"1234567890,1', 'a"b,c', '"a" ,b', '"a"b"', '"""'],
        "wrong_column_count": ["", None, "a,b", GOOD + ",", '"a,b\nc"'],
        "bad_value:npi": [GOOD.replace("1234567890", x) for x in ("123", "１２３４５６７８９０", "12345678901", "", "1234567890\n")[:4]],
        "bad_value:entity_type_code": [GOOD.replace(",1,", ",3,", 1)],
        "bad_value:practice_zip": [GOOD.replace("12345,", "1234,")],
        "bad_value:enumeration_date": [GOOD.replace("01/31/2020", x) for x in ("02/30/2020", "1/31/2020", "", "2020-01-31", "13/01/2020")],
        "bad_value:last_update_date": [GOOD + "00/01/2020"],
    }
    lines = [x for xs in bad.values() for x in xs]
    want = [r for r, xs in bad.items() for _ in xs]
    got = reasons(spark, lines)
    assert [got.get(n) for n in range(len(lines))] == want
    assert reasons(spark, [GOOD, GOOD + "\r", GOOD.replace("1234567890", '" 1234567890 "'), GOOD + "02/29/2024"]) == {}


def test_anomalies(spark):
    ok = 'index,0123456789ab,t,k,p,"two\nlines, ""x"""'
    lines = [ok, ok.replace("index", "Index"), ok.replace("9ab", "9AB"), ok.replace("two", "t\x00wo"), ok.replace("two", "t\x1bwo"), ok.replace("two", "t�wo")]
    assert reasons(spark, lines, "anomalies") == {1: "bad_value:step", 2: "bad_value:file_id", 3: "bad_value:detail", 4: "bad_value:detail", 5: "bad_value:detail"}
    df = spark.createDataFrame([(1, "anomalies", ok)], DDL)
    assert loaded(df, "anomalies").collect()[0].detail == 'two\nlines, "x"'


def test_one_line_doesnt_change_how_the_next_is_read(spark):
    ok = "index,0123456789ab,t,k,p,{}"
    details = ["na\x00me", "x", '"open', "y", "\uffff", "z", "\x00", "w", "\x01", '"a""', '"v"']
    df = spark.createDataFrame([(n, "anomalies", ok.format(d)) for n, d in enumerate(details)], DDL).coalesce(1)
    got = {r.line_id: r.reason for r in rejected(df).collect()}
    assert got == {0: "bad_value:detail", 2: "broken_quoting", 6: "bad_value:detail", 8: "bad_value:detail", 9: "broken_quoting"}
    assert [r.detail for r in loaded(df, "anomalies").orderBy("line_id").collect()] == ["x", "y", "\uffff", "z", "w", "v"]


def test_edges(spark):
    long = GOOD.replace("Town", "x" * 500_000).replace('"1 ""A"" St, 2"', '"' + '""' * 50_000 + '"')
    df = spark.createDataFrame([(1, "nppes", GOOD), (1, "nppes", GOOD), (2, None, GOOD), (3, "other", None), (None, "nppes", "x"), (4, "nppes", long)], DDL)
    assert sorted((r.line_id or 0, r.reason) for r in rejected(df).collect()) == [(0, "wrong_column_count"), (2, "unknown_kind"), (3, "unknown_kind")]
    assert loaded(df, "nppes").count() == 3
    assert rejected(df.limit(0)).collect() == [] and loaded(df.limit(0), "nppes").collect() == []
    assert rejected(clashing(df)).count() == 3 and loaded(clashing(df), "nppes").count() == 3


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.text(st.sampled_from('ab",\n é '), max_size=5), min_size=6, max_size=6), min_size=1, max_size=8))
def test_round_trip(spark, rows):
    lines = []
    for r in rows:
        f = io.StringIO()
        csv.writer(f, lineterminator="", quoting=csv.QUOTE_ALL).writerow(["index", "0123456789ab", *r[:3], "d" + r[3].replace(" ", "")])
        lines.append(f.getvalue())
    df = spark.createDataFrame([(n, "anomalies", x) for n, x in enumerate(lines)], DDL)
    got = {r.line_id: r for r in loaded(df, "anomalies").collect()}
    assert len(got) == len(rows)
    for n, r in enumerate(rows):
        assert [got[n][f.name] or "" for f in ANOMALIES][2:5] == r[:3]


def test_loaded_values_have_types(spark):
    plain = "0234567890,2,Org,,,,Street,Town,TX,,01/31/2020,02/29/2024"
    lines = [plain, plain.replace("0234567890", " 0234567890\t"), GOOD, plain.replace("01/31/2020", '"01/31/2020"').replace("02/29/2024", '""'), plain.replace("2020", "12020")]
    df = spark.createDataFrame([(n, "nppes", x) for n, x in enumerate(lines)], DDL)
    got = loaded(df, "nppes").orderBy("line_id").collect()
    assert dict(loaded(df, "nppes").dtypes)["enumeration_date"] == "date"
    day, leap = dt.date(2020, 1, 31), dt.date(2024, 2, 29)
    assert [(r.line_id, r.npi, r.enumeration_date, r.last_update_date) for r in got] == [(0, "0234567890", day, leap), (1, "0234567890", day, leap), (2, "1234567890", day, None), (3, "0234567890", day, None)]
    assert (got[0].last_name, got[0].practice_zip) == (None, None) and got[2].practice_address_1 == '1 "A" St, 2'
