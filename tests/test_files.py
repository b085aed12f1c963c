from __future__ import annotations

import zipfile

import pytest

from pricequarry.sources import files as S


def test_finished_folders_and_stacking(spark, tmp_path):
    for name, cols in (("b", "1 as x, 'n' as y"), ("a", "2 as x"), ("c.tmp", "3 as x"), ("d", "4 as x")):
        spark.sql(f"select {cols}").write.parquet(str(tmp_path / name / "rates"))
        if name != "d":
            (tmp_path / name / "_SUCCESS").touch()
    folders = S.finished(str(tmp_path))
    assert [f[-1] for f in folders] == ["a", "b"]
    assert sorted(map(tuple, S.stacked_parquet(spark, folders, "rates").select("x", "y").collect()), key=str) == [(1, "n"), (2, None)]
    with pytest.raises(FileNotFoundError):
        S.stacked_parquet(spark, folders, "groups")
    assert S.finished(str(tmp_path / "none")) == []


def test_text_dialects(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('﻿Code,Grouping,Classification,Specialization,Definition,Notes,Display Name,Section\n1A,G,"C ""x""",  ,"two\nlines",,N,S\n,,,,,,,\n')
    assert [tuple(r) for r in S.taxonomy(spark, str(p)).collect()] == [("1A", "G", 'C "x"', None, "N")]
    p.write_text("Code,Grouping\n1,2\n")
    with pytest.raises(ValueError, match="Classification"):
        S.taxonomy(spark, str(p))
    g = tmp_path / "g.txt"
    g.write_text("GEOID|ALAND|INTPTLAT|INTPTLONG  \n00601|1| 18.18 |-66.7 \n00602|1|x|\n")
    assert [tuple(r) for r in S.gazetteer(spark, str(g)).collect()] == [("00601", 18.18, -66.7), ("00602", None, None)]


def sheet(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cells = lambda r, xs: f'<row r="{r}">' + "".join(f'<c r="{c}{r}" t="{t}"><v>{v}</v></c>' for c, t, v in xs) + "</row>"
    body = cells(1, [("A", "s", 0), ("C", "s", 1)]) + cells(2, [("A", "n", 601), ("C", "s", 2)]) + cells(3, [("A", "n", 77001)])
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>ZIP_CODE</t></si><si><t>zcta</t></si><si><t>602</t></si></sst>")


def test_sheet(spark, tmp_path):
    sheet(tmp_path / "x.xlsx")
    assert [tuple(r) for r in S.crosswalk(spark, str(tmp_path / "x.xlsx")).collect()] == [("00601", "00602")]


def test_registry_archive(spark, tmp_path):
    p = tmp_path / "r.zip"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("npidata_pfile_20310101-20310131_fileheader.csv", "NPI\n")
        z.writestr("other.csv", "x")
        z.writestr("d/npidata_pfile_20310101-20310131.csv", '"NPI","Name"\n"1","a, b"\n"2","c"\n"3"\n"4","d","e"\n"1","again"\n')
    path = S.unpack_registry(str(p), str(tmp_path), ["NPI"])
    good, bad = S.registry_rows(spark, path, spark.createDataFrame([("1",), ("9",), ("1",)], "npi string"))
    assert sorted(r.Name for r in good.collect()) == ["a, b", "again"] and bad.count() == 2
    with pytest.raises(ValueError, match="Phone"):
        S.unpack_registry(str(p), str(tmp_path), ["Phone"])


def test_newest_and_selection(spark, tmp_path):
    assert S.newest(["x_May_2030.zip", "x_December_2029.zip", "y"], r"x_([A-Z][a-z]+)_(\d{4})") == "x_May_2030.zip"
    assert S.newest(["v9_1", "v10_0"], r"v(\d+)_(\d+)") == "v10_0" and S.newest([], "x") is None
    for d in ("2030-01-01", "2030-02-01", "junk"):
        (tmp_path / d / "index").mkdir(parents=True)
    (tmp_path / "2030-01-01" / "index" / "_SUCCESS").touch()
    assert S.latest_run(str(tmp_path)) == "2030-01-01" and S.latest_run(str(tmp_path / "none")) is None
    f = spark.createDataFrame([("1", "b", True), ("2", "a", False)], "file_id string, file_name string, is_in_state_file boolean")
    ids = lambda **k: [r.file_id for r in S.selected(f, **k).collect()]
    assert ids() == ["2", "1"] and ids(in_state=True) == ["1"] and ids(ids=["2"]) == ["2"]
    with pytest.raises(ValueError, match="unknown"):
        S.selected(f, ids=["2", "3"])


def test_downloads_are_whole_or_not_there(tmp_path):
    (tmp_path / "src").write_bytes(b"abc" * 1000)
    url = (tmp_path / "src").as_uri()
    path = S.downloaded(url, str(tmp_path / "cache" / "x"))
    (tmp_path / "src").write_bytes(b"other")
    assert S.downloaded(url, path) == path and open(path, "rb").read() == b"abc" * 1000
    with pytest.raises(OSError):
        S.downloaded((tmp_path / "none").as_uri(), str(tmp_path / "cache" / "y"))
    assert [p.name for p in (tmp_path / "cache").iterdir()] == ["x"]


def test_attached_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "b"))
    assert S.attach(spark, str(tmp_path), "t") == ["t_a", "t_b"] and spark.table("t_a").count() == 3
    S.require_tables(spark, ["t_a"])
    with pytest.raises(ValueError, match="t_c"):
        S.require_tables(spark, ["t_a", "t_c"])
