from __future__ import annotations

import numpy as np
import pytest
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.llm import quantiles as Q

RANKS = (0.01, 0.25, 0.5, 0.9, 0.99, 0.999)


def errors(sketch, values, ranks=RANKS):
    s = np.sort(values)
    out = []
    for r, v in zip(ranks, sketch.quantiles(ranks), strict=True):
        lo, hi = np.searchsorted(s, v, "left") / len(s), np.searchsorted(s, v, "right") / len(s)
        out.append(max(0.0, lo - r, r - hi) / (sketch.deviation(r) + 1 / len(s)))
    return out


@pytest.mark.parametrize("high", [True, False])
def test_rank_error_over_many_merges(high):
    rng = np.random.default_rng(3)
    worst = []
    for trial in range(15):
        x = rng.choice([rng.lognormal(3, 1, 60_000), np.round(rng.gamma(2, 50, 60_000))])
        parts = [Q.RelativeSketch(32, high, seed=trial * 99 + n) for n in range(13)]
        for p, chunk in zip(parts, np.array_split(x, 13), strict=True):
            for batch in np.array_split(chunk, 5):
                p.update(batch)
        whole = Q.merged([p.dump() for p in parts])
        assert whole.n == len(x) == whole.weighted()[1][-1]
        worst.append(errors(whole, x))
    assert np.max(worst) < 4 and np.sqrt(np.mean(np.square(worst))) < 1.3


def test_protected_tail_is_exact_enough():
    x = np.random.default_rng(0).permutation(1_000_000).astype(float)
    s = Q.RelativeSketch(32)
    for b in np.array_split(x, 50):
        s.update(b)
    for r in (0.999, 0.9999, 0.99999):
        assert abs(s.quantiles([r])[0] - r * 1e6) <= 4 * s.deviation(r) * 1e6 + 2
    assert len(s.dump()) < 60_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6) | st.just(float("nan")), max_size=80))
def test_small_sets_are_exact(values):
    s = Q.RelativeSketch(16)
    s.update(np.array(values, float))
    real = sorted(v for v in values if v == v)
    t = Q.RelativeSketch.load(s.dump())
    assert t.n == len(real)
    if real:
        assert t.quantiles([0, 0.5, 1]) == [real[0], real[(len(real) + 1) // 2 - 1], real[-1]]


DDL = "day string, code string, rate double"


def test_groups_nulls_and_merging(spark):
    data = [("d1", "a", float(n)) for n in range(100)] + [("d2", "a", float(n)) for n in range(100, 200)] + [(None, "b", 1.0), ("d1", None, None), ("d1", "n", float("nan")), ("d2", "b", 3.0)]
    df = spark.createDataFrame(data, DDL).repartition(4)
    made = Q.sketches(df, ["day", "code"], "rate")
    both = made.unionByName(Q.combine(made, ["day", "code"], ["day"]))
    got = {(r.day, r.code): (r.n, r.value) for r in Q.percentiles(both, ["day", "code"], [0.5]).collect()}
    assert got == {("d1", "a"): (100, 49.0), ("d2", "a"): (100, 149.0), (None, "b"): (1, 1.0), ("d2", "b"): (1, 3.0), ("*", "a"): (200, 99.0), ("*", "b"): (2, 1.0)}
    assert Q.percentiles(Q.sketches(df.limit(0), ["day", "code"], "rate"), ["day", "code"], [0.5]).collect() == []
    assert Q.sketches(clashing(df), ["day", "code"], "rate").count() == 4


def test_hot_group_over_many_tasks(spark):
    df = spark.range(0, 200_000, numPartitions=150).selectExpr("'hot' k", "double(id) v")
    (r,) = Q.percentiles(Q.sketches(df, ["k"], "v"), ["k"], [0.99]).collect()
    assert r.n == 200_000 and abs(r.value - 198_000) < 4 * 0.00041 * 200_000 and r.low <= 198_000 <= r.high


def test_tasks_with_many_groups_and_many_days_to_merge(spark):
    df = spark.range(20_000).selectExpr("cast(id % 50 as string) as day", "cast(id % 7 as string) as code", "cast(id as double) as v").repartition(3)
    few = Q.sketches(df, ["day", "code"], "v", most_groups=5)
    rows = few.groupBy("day", "code").count().collect()
    assert len(rows) == 350 and {r["count"] for r in rows} == {1}
    n = {(r.day, r.code): r.n for r in Q.percentiles(few, ["day", "code"], [0.5]).collect()}
    assert sum(n.values()) == 20_000
    merged = {r.code: (r.n, r.min, r.max) for r in Q.percentiles(Q.combine(few, ["day", "code"], ["day"]), ["day", "code"], [0.5]).collect()}
    assert merged == {str(c): (len(range(c, 20_000, 7)), float(c), float(range(c, 20_000, 7)[-1])) for c in range(7)}
