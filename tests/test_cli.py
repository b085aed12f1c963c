from __future__ import annotations

import json
import os

import pytest

from pricequarry import cli
from pricequarry.plans import build, star
from pricequarry.session import local_path, retried, shared_folder


def test_index(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"reporting_structure": [{"reporting_plans": [{"plan_name": "p"}], "in_network_files": [{"description": "d", "location": "https://h/AB_x.json"}]}]}))
    assert cli.main(["index", str(tmp_path / "*.json"), str(tmp_path / "out"), "--marker", "AB_"]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "files")).first().is_in_state_file
    assert {"plans", "references", "files", "anomalies", "counters", "_SUCCESS"} == set(os.listdir(tmp_path / "out"))


def test_extract_and_profile(spark, sf, tmp_path, capsys):
    assert cli.main(["extract", sf, str(tmp_path / "out")]) == 0
    back = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in ("rates", "capitation", "covered_services", "provider_groups", "anomalies", "file_counts")}
    assert back["rates"].count() and back["file_counts"].agg({"n_anomalies": "sum"}).first()[0]
    named = back["rates"].select("file_id", "provider_group_id").union(back["capitation"].select("file_id", "provider_group_id"))
    # groups that stand inside rates are in the table of groups, so that only undefined references dangle
    loose = named.filter("provider_group_id like 'inline:%'").join(back["provider_groups"], ["file_id", "provider_group_id"], "left_anti")
    assert loose.filter("provider_group_id is not null").distinct().count() <= back["anomalies"].filter("type in ('undefined_provider_group', 'missing_npi')").count()
    assert cli.main(["profile", sf]) == 0
    assert "== prices by setting" in capsys.readouterr().out


def test_build_site_and_drift(spark, sf, tmp_path):
    out = str(tmp_path / "site")
    assert cli.main(["build-site", sf, out]) == 0
    n = star.stored(spark, out, "fact").count()
    assert n == star.fact(spark, sf).count()
    half = str(tmp_path / "half")
    star.stored(spark, out, "fact").filter("rate_id % 2 = 0").write.parquet(f"{half}/fact")
    with pytest.raises(FileNotFoundError):
        star.stored(spark, half, "fact")
    os.makedirs(f"{half}/complete")
    with pytest.raises(build.DriftError, match="->"):
        cli.main(["build-site", sf, str(tmp_path / "next"), "--before", half])
    assert not os.path.exists(tmp_path / "next")
    assert cli.main(["build-site", sf, str(tmp_path / "next"), "--before", half, "--force"]) == 0
    assert star.stored(spark, str(tmp_path / "next"), "fact").count() == n


def test_drift_names_what_is_missing(spark):
    a = spark.createDataFrame([("x",)] * 10, "k string")
    assert build.check_drift(a, a, "k").first().breaks is False
    with pytest.raises(build.DriftError, match="y: none"):
        build.check_drift(a, a, "k", wanted=["x", "y"])
    assert build.check_drift(a, a, "k", wanted=["y"], force=True).count() == 1


def test_tries_again():
    calls = []

    def f():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("away")
        return 7

    assert retried(f, wait=0) == 7 and len(calls) == 3
    with pytest.raises(OSError):
        retried(lambda: (_ for _ in ()).throw(OSError()), wait=0)
    with pytest.raises(ValueError):
        retried(lambda: int("x"), wait=0)


def test_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == shared_folder(spark) and local_path("file:///a/b") == local_path("file:/a/b") == "/a/b" and local_path("/c") == "/c"
    with pytest.raises(ValueError):
        local_path("hdfs://x/y")
