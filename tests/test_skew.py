from __future__ import annotations

import statistics
from collections import Counter

import pytest
from conftest import clashing

from pricequarry.operators.skew import heavy_keys, skewed_key_stats

DDL = "a string, b string, v double, d string"


def rows():
    out = [("hot", "x", float(n % 7), str(n % 5)) for n in range(400)]
    out += [(f"k{n % 150}", None if n % 3 else "y", None if n % 4 == 0 else n * 0.5, None if n % 6 == 0 else str(n)) for n in range(600)]
    out += [(None, "x", 1.0, "n"), ("nan", "z", float("nan"), "n"), ("", "z", 2.0, "n")]
    return out


def stats(df, **kw):
    return {(r.key_field, r.key_value): r for r in skewed_key_stats(df, ["a", "b"], "v", "d", heavy_share=0.05, salts=8, **kw).collect()}


def test_same_as_plain_aggregation(spark):
    data = rows()
    got = stats(spark.createDataFrame(data, DDL))
    for at, field in ((0, "a"), (1, "b")):
        for key, n in Counter(r[at] for r in data if r[at] is not None).items():
            mine = [r for r in data if r[at] == key]
            vs = [r[2] for r in mine if r[2] is not None and r[2] == r[2]]
            g = got.pop((field, key))
            assert (g.n_rows, g.n_values, g.n_distinct) == (n, len(vs), len({r[3] for r in mine if r[3] is not None}))
            if vs:
                assert g.avg_value == pytest.approx(sum(vs) / len(vs)) and (g.min_value, g.max_value) == (min(vs), max(vs))
            else:
                assert g.avg_value is None and g.std_value is None
    assert not got
    assert {k[1] for k, r in stats(spark.createDataFrame(data, DDL)).items() if r.is_heavy and k[0] == "a"} == {"hot"}


def test_share_is_exact_and_ties_stay(spark):
    data = [("p",)] * 30 + [("q",)] * 30 + [("r",)] * 29 + [(None,)] * 911
    found = heavy_keys(spark.createDataFrame([(a, 1.0) for (a,) in data], "a string, v double"), ["a"], "v", 0.03).collect()
    assert sorted((r.key_value, r.n_rows) for r in found) == [("p", 30), ("q", 30)]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame(rows(), DDL)
    assert stats(df.limit(0)) == {}
    assert heavy_keys(df.limit(0), ["a"], "v", 0.1).collect() == []
    assert stats(clashing(df)).keys() == stats(df).keys()


def test_long_and_repeated_keys(spark):
    data = [("x" * 100_000, 1.0)] * 5 + [("y", 2.0)]
    found = heavy_keys(spark.createDataFrame(data, "a string, v double"), ["a"], "v", 0.5).collect()
    assert [(len(r.key_value), r.n_rows) for r in found] == [(100_000, 5)]


def test_share_must_be_resolvable(spark):
    with pytest.raises(ValueError, match="resolve"):
        heavy_keys(spark.createDataFrame([("a", 1.0)], "a string, v double"), ["a"], "v", 0.0001)


def test_moments_dont_cancel_or_overflow(spark):
    small = [("s", 1e-8 * n, str(n)) for n in range(1, 101)]
    far = [("f", 1e9 + n % 3, str(n)) for n in range(300)]
    big = [("b", 1e22 * (1 + n % 2), str(n)) for n in range(100)]
    df = spark.createDataFrame(small + far + big, "a string, v double, d string")
    for distinct in ("d", None):
        got = {r.key_value: r for r in skewed_key_stats(df, ["a"], "v", distinct, heavy_share=0.1, salts=8).collect()}
        for key, rows_ in (("s", small), ("f", far), ("b", big)):
            vs = [r[1] for r in rows_]
            assert got[key].is_heavy and got[key].avg_value == pytest.approx(statistics.fmean(vs), rel=1e-12) and got[key].std_value == pytest.approx(statistics.stdev(vs), rel=1e-6)
