"""Other inputs: finished folders, CSV in several dialects, members of zip archives, sheets, and which files to take."""

from __future__ import annotations

import csv
import io
import os
import re
import shutil
import urllib.request
import zipfile
from collections.abc import Iterable, Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricequarry.functions.scalar import zero_padded
from pricequarry.sources.dirty_csv import quoting


def finished(root: str) -> list[str]:
    """Folders of a run that are complete, by name: those with a _SUCCESS file that aren't temporary."""
    names = sorted(os.listdir(root)) if os.path.isdir(root) else []
    return [os.path.join(root, n) for n in names if not n.endswith(".tmp") and os.path.exists(os.path.join(root, n, "_SUCCESS"))]


def stacked_parquet(spark: SparkSession, folders: Sequence[str], name: str) -> DataFrame:
    """One table of many finished folders, columns matched by name. A finished folder without the table is an error."""
    paths = [os.path.join(f, name) for f in folders]
    gone = [p for p in paths if not os.path.exists(p)]
    if gone or not paths:
        raise FileNotFoundError(f"no table {name} in {gone or 'any folder'}")
    return spark.read.option("mergeSchema", True).parquet(*paths)


def text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV with header, every column text, quotes doubled inside quotes, empty fields null."""
    return spark.read.options(header=True, inferSchema=False, sep=sep, quote='"', escape='"', multiLine=True).csv(path)


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Areas with coordinates from pipe-separated text: (area, lat, lon)."""
    t = spark.read.options(header=True, sep="|").csv(path)
    t = t.toDF(*[c.strip() for c in t.columns])
    return t.select(F.trim("GEOID").alias("area"), F.trim("INTPTLAT").try_cast("double").alias("lat"), F.trim("INTPTLONG").try_cast("double").alias("lon"))


def sheet_rows(path: str) -> list[dict[str, str | None]]:
    """The first sheet of a workbook, by its header row. A workbook is a zip of XML; it is read on the driver, as it is one
    small file."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        first = min((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
        rows = []
        for row in ElementTree.fromstring(z.read(first)).iter(f"{ns}row"):
            cells: dict[int, str | None] = {}
            for n, c in enumerate(row.iter(f"{ns}c")):
                letters = re.match(r"[A-Z]*", c.get("r") or "").group()
                at = sum((ord(x) - 64) * 26**p for p, x in enumerate(reversed(letters))) - 1 if letters else n
                v = c.find(f"{ns}v")
                text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                cells[at] = shared[int(text)] if c.get("t") == "s" and text else text
            rows.append(cells)
    if not rows:
        return []
    head = {at: (name or "").strip().lower() for at, name in rows[0].items()}
    return [{name: cells.get(at) for at, name in head.items()} for cells in rows[1:]]


def crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """(zip, area) of a workbook with columns zip_code and zcta, in any case; padded to five digits, rows without either left out."""
    rows = [(r.get("zip_code"), r.get("zcta")) for r in sheet_rows(path)]
    t = spark.createDataFrame(rows, "zip string, area string")
    return t.select(zero_padded(F.col("zip"), 5).alias("zip"), zero_padded(F.col("area"), 5).alias("area")).filter("zip is not null and area is not null")


REGISTRY_MEMBER = re.compile(r"npidata_pfile_\d{8}-\d{8}\.csv\Z")


def registry_member(path: str) -> str:
    """The data member of a registry archive: not its header sample, nor anything else."""
    with zipfile.ZipFile(path) as z:
        found = [n for n in z.namelist() if REGISTRY_MEMBER.search(os.path.basename(n))]
    if len(found) != 1:
        raise ValueError(f"{path}: {len(found)} data members")
    return found[0]


def unpack_registry(path: str, folder: str, required: Iterable[str]) -> str:
    """Writes the data member, in pieces, to the shared folder, where Spark reads it in parallel; its header must have the
    required columns."""
    member = registry_member(path)
    out = os.path.join(folder, os.path.basename(member))
    with zipfile.ZipFile(path) as z, z.open(member) as src:
        head = next(csv.reader(io.StringIO(src.readline().decode("utf-8-sig"))))
    if lacking := set(required) - set(head):
        raise ValueError(f"{member}: no columns {sorted(lacking)}")
    with zipfile.ZipFile(path) as z, z.open(member) as src, open(f"{out}.part", "wb") as dst:
        while piece := src.read(1 << 20):
            dst.write(piece)
    os.replace(f"{out}.part", out)
    return out


def registry_rows(spark: SparkSession, csv_path: str, wanted: DataFrame, key: str = "NPI") -> tuple[DataFrame, DataFrame]:
    """(rows of the wanted ids, lines of a wrong field count or broken quoting). Lines are split in parallel; they hold no breaks."""
    with open(csv_path, encoding="utf-8-sig") as f:
        header = f.readline().rstrip("\r\n")
    names = next(csv.reader([header]))
    lines = spark.read.text(csv_path).filter(F.ltrim(F.lit("\ufeff"), "value") != header)
    whole, columns = quoting(F.col("value"))
    lines = lines.withColumn("ok", whole & (columns == len(names)))
    schema = ", ".join(f"`{n}` string" for n in names)
    good = lines.filter("ok").select(F.from_csv("value", schema, {"quote": '"', "escape": '"', "emptyValue": ""}).alias("r")).select("r.*")
    return good.join(wanted.select(F.col("npi").alias(key)).distinct(), key, "left_semi"), lines.filter("not ok").select("value")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(code, grouping, classification, specialization, display_name); a byte order mark is no part of the first name, rows
    without a code are left out, blank texts are null."""
    t = text_csv(spark, path)
    t = t.toDF(*[c.lstrip("﻿").strip() for c in t.columns])
    need = {"Code": "code", "Grouping": "grouping", "Classification": "classification", "Specialization": "specialization", "Display Name": "display_name"}
    if lacking := set(need) - set(t.columns):
        raise ValueError(f"no columns {sorted(lacking)}")
    return t.select(*[F.nullif(F.trim(F.col(f"`{a}`")), F.lit("")).alias(b) for a, b in need.items()]).filter("code is not null")


def newest(names: Iterable[str], pattern: str) -> str | None:
    """The name whose numbers, as captured by the pattern, are greatest, years before all others; months by name count
    as numbers."""
    months = {m: n for n, m in enumerate("January February March April May June July August September October November December".split(), 1)}
    numbers = lambda m: [months.get(g, int(g) if g.isdigit() else 0) for g in m.groups()]
    found = [(sorted(numbers(m), key=lambda n: n < 1900), x) for x in names if (m := re.search(pattern, x))]
    return max(found)[1] if found else None


def latest_run(root: str) -> str | None:
    """The last dated folder whose index is complete."""
    dated = [n for n in (os.listdir(root) if os.path.isdir(root) else []) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n)]
    return max((n for n in dated if os.path.exists(os.path.join(root, n, "index", "_SUCCESS"))), default=None)


def selected(files: DataFrame, ids: Sequence[str] = (), in_state: bool = False) -> DataFrame:
    """Files by id, or those of the state, or all, by name. An id that isn't there is an error."""
    if ids:
        out = files.filter(F.col("file_id").isin(list(ids)))
        if gone := set(ids) - {r.file_id for r in out.select("file_id").distinct().collect()}:
            raise ValueError(f"unknown files: {sorted(gone)}")
    else:
        out = files.filter("is_in_state_file") if in_state else files
    return out.orderBy("file_name", "file_id")


def downloaded(url: str, path: str) -> str:
    """``path`` with what the URL serves; one that is there already is taken as it is. What arrives is written beside it and renamed
    when it is whole, so that a broken download leaves nothing that looks complete."""
    if not os.path.exists(path):
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with urllib.request.urlopen(url) as src, open(f"{path}.part", "wb") as dst:  # noqa: S310
            shutil.copyfileobj(src, dst, 1 << 20)
            told = src.headers.get("Content-Length")
        if told is not None and int(told) != os.path.getsize(f"{path}.part"):
            os.remove(f"{path}.part")
            raise OSError(f"{url}: not all of it arrived")
        os.replace(f"{path}.part", path)
    return path


def attach(spark: SparkSession, folder: str, prefix: str, endings: Sequence[str] = ("", ".parquet")) -> list[str]:
    """Makes the Parquet tables of a folder known as views ``prefix_name``, for reading only; gives the views' names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p))
    out = []
    for n in names:
        ending = next((e for e in sorted(endings, key=len, reverse=True) if n.endswith(e)), None)
        if ending is not None and not n.startswith(("_", ".")):
            view = f"{prefix}_{n.removesuffix(ending)}"
            spark.read.parquet(f"{folder}/{n}").createOrReplaceTempView(view)
            out.append(view)
    return out


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """An error that names the tables and views that aren't there."""
    if gone := [n for n in names if not spark.catalog.tableExists(n)]:
        raise ValueError(f"no tables {gone}")
