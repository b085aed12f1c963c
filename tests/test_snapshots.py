from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from pricequarry.operators.snapshots import Bitmap, SnapshotState, snapshot_changes

DDL = "day date, a string, b string, v double, at timestamp"
D = [dt.date(2031, m, 20) for m in (3, 4, 5)]


def changes(df, **kw):
    return sorted(tuple(r) for r in snapshot_changes(df, "day", ["a", "b"], "v", "at", **kw).collect())


def brute(data):
    last = {}
    for day, a, b, v, at in data:
        if day is not None:
            k = (day, a, b)
            rank = (at is not None, at or dt.datetime.min, v is not None, v or 0.0)
            if k not in last or rank > last[k][0]:
                last[k] = (rank, v)
    out = []
    days = sorted({k[0] for k in last})
    for p, d in zip(days, days[1:], strict=False):
        old, new = ({k[1:]: x[1] for k, x in last.items() if k[0] == y} for y in (p, d))
        for k in old.keys() | new.keys():
            if k not in old or k not in new:
                out.append((d, *k, "removed" if k in old else "added"))
            elif (old[k] is None) != (new[k] is None) or (old[k] is not None and abs(old[k] - new[k]) >= 0.005 - 1e-10):
                out.append((d, *k, "changed"))
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    data = []
    for n in range(3000):
        day = [*D, None][rng.choice(4, p=[0.33, 0.33, 0.33, 0.01])]
        v = None if rng.random() < 0.1 else round(float(rng.choice([1, 1.001, 1.006, 2])), 3)
        data.append((day, [None, "x", "", f"k{n % 400}"][rng.choice(4, p=[0.05, 0.05, 0.05, 0.85])], str(n % 3), v, dt.datetime(2031, 1, 1) + dt.timedelta(seconds=int(rng.integers(0, 10_000)))))
    data += data[:50]
    key = lambda r: tuple(str(x) for x in r)
    df = spark.createDataFrame(data, DDL)
    assert sorted(map(key, [tuple(r) for r in snapshot_changes(df, "day", ["a", "b"], "v", "at").collect()])) == sorted(map(key, brute(data)))


def test_edges(spark):
    at = dt.datetime(2031, 1, 1)
    one = spark.createDataFrame([(D[0], "a", "b", 1.0, at)], DDL)
    assert changes(one) == [] and changes(one.limit(0)) == []
    data = [(D[0], "a", "b", 1.0, at), (D[2], "a", "b", 1.005, at), (D[2], "a", "b", 1.0, at), (D[2], "long" * 30_000, "b", None, at)]
    got = changes(clashing(spark.createDataFrame(data, DDL)))
    assert [(len(r[1]), r[3]) for r in got] == [(1, "changed"), (120_000, "added")]


def test_many_containers(spark):
    n = 150_000
    df = spark.range(n).selectExpr("date'2031-03-20' day", "cast(id as string) a", "'' b", "1.0D v", "timestamp'2031-01-01' at")
    new = spark.range(n).filter("id % 10 <> 0").selectExpr("date'2031-04-20' day", "cast(id as string) a", "'' b", "if(id % 7 = 0, 2.0D, 1.0D) v", "timestamp'2031-01-01' at")
    got = snapshot_changes(df.union(new), "day", ["a", "b"], "v", "at", shards=1).groupBy("change").count().collect()
    assert {r["change"]: r["count"] for r in got} == {"removed": n // 10, "changed": len([i for i in range(0, n, 7) if i % 10])}


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 65_535), max_size=200), st.sets(st.integers(0, 65_535), max_size=200), st.booleans(), st.booleans())
def test_bitmap_is_a_set(a, b, dense_a, dense_b):
    a = a | set(range(5000)) if dense_a else a
    b = b | set(range(3000, 9000)) if dense_b else b
    x, y = Bitmap.of(np.array(sorted(a), np.int64)), Bitmap.of(np.array(sorted(b), np.int64))
    assert set(x.numbers().tolist()) == a
    assert set(x.and_not(y).tolist()) == a - b and set(x.both(y).tolist()) == a & b


def ordinals(state):
    return {r.k0: (r.shard, r.ordinal) for r in state._read("keys").collect()}


def test_a_state_takes_further_snapshots_and_late_ones(spark, tmp_path):
    at = dt.datetime(2031, 1, 1)
    rng = np.random.default_rng(2)
    data = [(D[n % 3], f"k{rng.integers(0, 200)}", "", float(rng.integers(0, 3)), at + dt.timedelta(seconds=n)) for n in range(900)]
    day = lambda *ds: spark.createDataFrame([r for r in data if r[0] in ds], DDL)
    want = sorted(tuple(r) for r in brute(data))
    whole = SnapshotState(spark, str(tmp_path / "whole"), ["a", "b"], shards=3)
    snapshot_changes(day(D[0], D[1]), "day", ["a", "b"], "v", "at", state=whole)
    before = ordinals(whole)
    # a new process: the number of shards comes from the state; only the third snapshot is given
    again = SnapshotState(spark, str(tmp_path / "whole"), ["a", "b"])
    third = sorted(tuple(r) for r in snapshot_changes(day(D[2]), "day", ["a", "b"], "v", "at", state=again).collect())
    assert third == [r for r in want if r[0] == D[2]] and again.shards == 3 and again.dates() == D
    assert before.items() <= ordinals(again).items() and len(ordinals(again)) > len(before)
    assert sorted(tuple(r) for r in again.changes().collect()) == want
    # the one in the middle comes last: no key is numbered anew, and both pairs it belongs to come out
    late = SnapshotState(spark, str(tmp_path / "late"), ["a", "b"], shards=3)
    snapshot_changes(day(D[0], D[2]), "day", ["a", "b"], "v", "at", state=late)
    before = ordinals(late)
    got = sorted(tuple(r) for r in snapshot_changes(day(D[1]), "day", ["a", "b"], "v", "at", state=late).collect())
    assert got == want and before.items() <= ordinals(late).items()
    assert len(set(ordinals(late).values())) == len(ordinals(late))
    # a snapshot that is delivered again takes the place of the first delivery
    snapshot_changes(day(D[1]).filter("a <> 'k1'"), "day", ["a", "b"], "v", "at", state=late)
    assert sorted(tuple(r) for r in late.changes().collect()) == sorted(tuple(r) for r in brute([r for r in data if r[0] != D[1] or r[1] != "k1"]))
    with pytest.raises(ValueError, match="other keys"):
        SnapshotState(spark, str(tmp_path / "late"), ["b"])


def test_history_in_parts(spark):
    at = dt.datetime(2031, 1, 1)
    data = [(D[0] + dt.timedelta(days=n // 20), f"k{n * 7 % 30}", "", float(n % 3), at) for n in range(200)]
    df = spark.createDataFrame(data, DDL)
    assert changes(df, at_once=3) == changes(df) == sorted(brute(data))


@settings(max_examples=20, deadline=None)
@given(st.sets(st.integers(0, 65_535), max_size=50), st.booleans())
def test_bitmaps_are_stored(a, dense):
    a = a | set(range(5000)) if dense else a
    x = Bitmap.load(Bitmap.of(np.array(sorted(a), np.int64)).dump())
    assert set(x.numbers().tolist()) == a and (x.bits is not None) == (len(a) > 4096)
