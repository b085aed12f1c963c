from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pricequarry.plans import publish as P
from pricequarry.streaming import arrivals


def test_all_tables_or_none(spark, tmp_path):
    final = str(tmp_path / "db")
    a = spark.range(3)
    P.write_tables({"a": a, "empty": spark.createDataFrame([], "x string, y array<int>")}, final)
    assert spark.read.parquet(f"{final}/empty").columns == ["x", "y"]
    with pytest.raises(Exception, match="no_such"):
        P.write_tables({"a": spark.range(9), "b": spark.range(1).filter("no_such = 1")}, final)
    assert spark.read.parquet(f"{final}/a").count() == 3 and os.listdir(tmp_path) == ["db"]
    P.write_tables({"a": spark.range(9)}, final)
    assert spark.read.parquet(f"{final}/a").count() == 9 and not os.path.exists(f"{final}/empty")


def test_csv(spark, tmp_path):
    df = spark.sql("select 1 as a, array('x','y') as b, named_struct('c', 2) as d union all select null, null, null")
    assert P.export_csv(df, str(tmp_path / "out"), single=True) == 2
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).orderBy("a").collect()
    assert [tuple(r) for r in back] == [(None, None, None), ("1", "x|y", '{"c":2}')]


def test_report(spark):
    text = P.report({"t": spark.range(2).selectExpr("id", "'x' as long_name").orderBy("id"), "u": spark.range(3000)})
    assert text.splitlines()[:5] == ["== t", "id  long_name", "0   x", "1   x", ""] and len(text.splitlines()) == 3007


def test_what_cant_be_put_in_place_leaves_the_old(tmp_path, monkeypatch):
    final = str(tmp_path / "db")
    with P.committed(final) as folder:
        open(f"{folder}/a", "w").close()
    real, calls = os.rename, []

    def failing(a, b):
        calls.append(b)
        if len(calls) == 2:
            raise OSError("no room")
        real(a, b)

    monkeypatch.setattr(os, "rename", failing)
    with pytest.raises(OSError, match="room"), P.committed(final) as folder:
        open(f"{folder}/b", "w").close()
    assert sorted(os.listdir(final)) == ["_SUCCESS", "a"] and os.listdir(tmp_path) == ["db"]


def test_publish_and_load(spark, tmp_path):
    db, store = str(tmp_path / "db"), P.FolderStore(str(tmp_path / "store"))
    P.write_tables({"a": spark.range(3)}, db)
    told = []
    assert P.publish(db, store, "2030-01-01", dry_run=True)["files"] and store.keys() == []
    for day in ("2030-01-01", "2030-02-01", "2030-03-01"):
        P.publish(db, store, day, notify=told.append)
    assert {k.split("/")[0] for k in store.keys()} == {"2030-02-01", "2030-03-01", P.MANIFEST} and len(told) == 3
    cache = str(tmp_path / "cache")
    folder = P.load(store, cache)
    assert spark.read.parquet(f"{folder}/a").count() == 3
    name = next(k for k in P.manifest_of(store, cache)["files"] if k.endswith(".parquet"))
    with open(os.path.join(folder, name), "ab") as f:
        f.write(b"x")
    assert spark.read.parquet(f"{P.load(store, cache)}/a").count() == 3  # fetched again
    with open(os.path.join(store.root, "2030-03-01", name), "ab") as f:
        f.write(b"x")
    os.remove(os.path.join(folder, name))
    with pytest.raises(OSError, match="manifest"):
        P.load(store, cache)
    assert not os.path.exists(os.path.join(folder, name))
    with pytest.raises(ValueError, match="version"):
        P.load(store, cache, schema_version=2)
    with pytest.raises(ValueError, match="outside"):
        store.put(__file__, "../x")
    with pytest.raises(ValueError, match="committed"):
        P.publish(str(tmp_path), store, "2030-01-01")


def test_arriving_files(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    row = lambda day, n: spark.range(n).select(F.lit(day).alias("file_date"), F.lit(dt.datetime(2030, 1, 1)).alias("at"), "id")
    row("2030-01-01", 3).write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema

    def run():
        q = arrivals.take_new(arrivals.new_files(spark, src, schema), check, arrivals.into_table(out, "file_date"))
        q.awaitTermination(120)

    run()
    row("2030-01-02", 2).write.parquet(f"{src}/b")
    run()
    run()
    assert sorted((str(r.file_date), r["count"]) for r in spark.read.parquet(out).groupBy("file_date").count().collect()) == [("2030-01-01", 3), ("2030-01-02", 2)]
    w = arrivals.arrivals_per_window(arrivals.new_files(spark, src, schema), "at", "file_date")
    q = w.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.file_date, r.n) for r in spark.table("windows").collect()) == [("2030-01-01", 3), ("2030-01-02", 2)]
