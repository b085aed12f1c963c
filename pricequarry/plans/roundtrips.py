"""Registered queries of sources and sinks: tables are written in the form that a source reads, or by a sink, to the shared folder,
read back, and compared with SQL over the tables themselves."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterable, Sequence
from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricequarry.functions import scalar as X
from pricequarry.plans import build as B
from pricequarry.plans import extract as E
from pricequarry.plans import index as I
from pricequarry.plans import publish as P
from pricequarry.plans import star as S
from pricequarry.plans.catalogue import QUERIES as CALLS
from pricequarry.plans.catalogue import SQL as CALLS_SQL
from pricequarry.plans.service import Service
from pricequarry.plans.trace import verified
from pricequarry.session import fresh_folder, local_path, table
from pricequarry.settings import CODE_TYPE, CODES
from pricequarry.sources import files, json_items
from pricequarry.streaming import arrivals

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def scratch(spark: SparkSession, name: str) -> str:
    folder = local_path(fresh_folder(spark, name))
    os.makedirs(folder)
    return folder


def one_file(df: DataFrame, folder: str, **options) -> str:
    """Writes a small table as one CSV file and gives its path."""
    df.coalesce(1).write.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"', **options).mode("overwrite").csv(folder)
    return next(os.path.join(folder, n) for n in sorted(os.listdir(folder)) if n.startswith("part-"))


# ---- JSON objects with long lists ---------------------------------------------------------------------------------------------


def item_files(spark: SparkSession, sf: str) -> str:
    """The items of in_network as gzip files, one JSON object per source file."""
    folder = scratch(spark, "items")
    raw = F.to_json(F.struct("negotiation_arrangement", "billing_code", "billing_code_type", "description"))
    lists = table(spark, sf, "in_network").groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("i", raw.alias("raw")))).alias("x"))
    text = F.concat(F.lit('{"version": 2.10, "in_network": ['), F.array_join(F.transform("x", lambda v: v["raw"]), ", "), F.lit('], "last": {"in_network": [1]}}'))
    lists.select("file_id", text.alias("value")).write.partitionBy("file_id").option("compression", "gzip").mode("overwrite").text(folder)
    json_items.register(spark)
    return f"{folder}/file_id=*/part-*"


def _items(spark: SparkSession, sf: str, **options: str) -> DataFrame:
    rows = spark.read.format("json_items").options(lists="in_network", **options).load(item_files(spark, sf))
    return rows.withColumn("file_id", F.regexp_extract("file", "file_id=([^/]*)/", 1))


@query("select file_id, billing_code, negotiation_arrangement, count(*) as n from in_network group by all")
def src_json_items(spark: SparkSession, sf: str) -> DataFrame:
    """Elements of a list, whatever stands around it."""
    get = lambda c: F.get_json_object("raw", f"$.{c}").alias(c)
    rows = _items(spark, sf).filter("top_key = 'in_network' and idx is not null").select("file_id", get("billing_code"), get("negotiation_arrangement"))
    return rows.groupBy("file_id", "billing_code", "negotiation_arrangement").agg(F.count(F.lit(1)).alias("n"))


@query("select file_id, 'version' as top_key, '2.10' as raw, 1 as n from in_network group by 1 union all select file_id, 'last', '{\"in_network\": [1]}', 1 from in_network group by 1")
def src_json_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values beside the list, number text as it stands."""
    return _items(spark, sf).filter("idx is null and top_key <> '_file'").groupBy("file_id", "top_key", "raw").agg(F.count(F.lit(1)).alias("n"))


@query("select file_id, least(count(*), 3) as n from in_network group by 1")
def src_json_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Only the first three elements of each list: the others are passed over in the source."""
    return _items(spark, sf, keys="in_network", positions="0,1,2").groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))


@query("select file_id, true as same from in_network group by 1")
def src_json_hash(spark: SparkSession, sf: str) -> DataFrame:
    """The hash and size of the bytes as stored, against those of the whole file."""
    path = item_files(spark, sf)
    mine = spark.read.format("json_items").option("lists", "in_network").load(path).filter("top_key = '_file'").select("file", "sha256", "n_bytes")
    whole = spark.read.format("binaryFile").load(path).select(F.regexp_replace("path", "^file:/*", "/").alias("file"), F.sha2("content", 256).alias("h"), "length")
    both = mine.join(whole, "file", "left")
    return both.select(F.regexp_extract("file", "file_id=([^/]*)/", 1).alias("file_id"), ((F.col("sha256") == F.col("h")) & (F.col("n_bytes") == F.col("length"))).alias("same"))


# ---- text, sheets, archives, folders --------------------------------------------------------------------------------------------

_NPPES = ("npi", "org_name", "last_name", "practice_address_1", "practice_city", "practice_zip")


@query(f"select {', '.join(f'nullif({c}, chr(0)) as {c}' for c in _NPPES)} from nppes".replace("chr(0)", "''"))
def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV with header, all columns text."""
    folder = scratch(spark, "csv")
    table(spark, sf, "nppes").select(*_NPPES).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).mode("overwrite").csv(folder)
    return files.text_csv(spark, folder).select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in _NPPES])


@query(f"{S.PREFIX} select distinct practice_zip5 as area, lat, lon from providers where lat is not null")
def src_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe-separated text with padded headers."""
    places = S.providers(spark, sf).filter("lat is not null").select(F.col("practice_zip5").alias("GEOID "), F.lit("x").alias("ALAND"), F.format_string(" %s", "lat").alias("INTPTLAT"), F.col("lon").alias(" INTPTLONG"))
    return files.gazetteer(spark, one_file(places.distinct(), scratch(spark, "gazetteer"), header=True, sep="|"))


def workbook(path: str, rows: Iterable[Sequence[str | None]]) -> None:
    """A workbook of one sheet with text cells; nulls have no cell."""
    with zipfile.ZipFile(path, "w") as z, z.open("xl/worksheets/sheet1.xml", "w") as out:
        out.write(b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
        for n, row in enumerate(rows, 1):
            cells = "".join(f'<c r="{chr(65 + k)}{n}" t="inlineStr"><is><t>{escape(v)}</t></is></c>' for k, v in enumerate(row) if v is not None)
            out.write(f'<row r="{n}">{cells}</row>'.encode())
        out.write(b"</sheetData></worksheet>")


_ZIPS = "select distinct left(practice_zip, 5) as zip from nppes where regexp_full_match(left(practice_zip, 5), '[0-9]{5}')"


@query(f"select lpad(ltrim(zip, '0'), 5, '0') as zip, left(zip, 4) || '0' as area from ({_ZIPS}) where zip[5:5] <> '9'")
def src_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The first sheet of a workbook: numbers without leading zeros are padded, rows without an area left out."""
    zips = table(spark, sf, "nppes").select(F.left("practice_zip", F.lit(5)).alias("zip")).filter(F.col("zip").rlike(r"\A[0-9]{5}\z")).distinct()
    path = os.path.join(scratch(spark, "sheet"), "zips.xlsx")
    workbook(path, [("ZIP_CODE", "PO_NAME", "ZCTA"), *((r.zip.lstrip("0"), "x", None if r.zip[4] == "9" else r.zip[:4] + "0") for r in zips.toLocalIterator())])
    return files.crosswalk(spark, path)


@query("select npi, practice_city, last_name from nppes semi join rates_npi using (npi)")
def src_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The data member of an archive, of which the ids that rates name are kept."""
    folder = scratch(spark, "registry")
    rows = table(spark, sf, "nppes").select(F.col("npi").alias("NPI"), F.col("practice_city").alias("City"), F.col("last_name").alias("Last"))
    with zipfile.ZipFile(f"{folder}/r.zip", "w") as z:
        z.write(one_file(rows, f"{folder}/csv", header=True, quoteAll=True), "npidata_pfile_20300101-20300131.csv")
        z.writestr("npidata_pfile_20300101-20300131_fileheader.csv", "NPI")
    path = files.unpack_registry(f"{folder}/r.zip", folder, ["NPI", "City"])
    good, _ = files.registry_rows(spark, path, table(spark, sf, "rates_npi").select("npi"))
    return good.select(F.col("NPI").alias("npi"), F.nullif(F.col("City"), F.lit("")).alias("practice_city"), F.nullif(F.col("Last"), F.lit("")).alias("last_name"))


@query("select distinct primary_taxonomy_code as code, 'G' as grouping, null as specialization, primary_taxonomy_code || ', \"x\"' as display_name from nppes where primary_taxonomy_code is not null")
def src_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV that begins with a byte order mark; blank texts are null, rows without a code are left out."""
    path = os.path.join(scratch(spark, "taxonomy"), "t.csv")
    codes = table(spark, sf, "nppes").select("primary_taxonomy_code").distinct()
    with open(path, "w", encoding="utf-8") as f:
        f.write("\ufeffCode,Grouping,Classification,Specialization,Definition,Notes,Display Name,Section\n")
        for r in codes.toLocalIterator():
            code = r[0] or ""
            f.write(f'{code},G,C,  ,"two\nlines",,"{code}, ""x""",S\n')
    return files.taxonomy(spark, path).select("code", "grouping", "specialization", "display_name")


@query("select step, type, count(case when step = 'extract' then detail end) as n_details, count(*) as n from anomalies where step in ('index', 'extract') group by 1, 2")
def src_finished(spark: SparkSession, sf: str) -> DataFrame:
    """Finished folders only, columns matched by name: one lacks a column, two are no finished ones."""
    root, rows = scratch(spark, "runs"), table(spark, sf, "anomalies")
    for name, step, gone in (("a", "index", ["detail"]), ("b", "extract", []), ("c", "nppes", []), ("d.tmp", "index", [])):
        rows.filter(F.col("step") == step).drop(*gone).write.parquet(f"{root}/{name}/anomalies")
        if name != "c":
            open(f"{root}/{name}/_SUCCESS", "w").close()
    back = files.stacked_parquet(spark, files.finished(root), "anomalies")
    return back.groupBy("step", "type").agg(F.count("detail").alias("n_details"), F.count(F.lit(1)).alias("n"))


@query("select strftime(max(snapshot_date), '%Y-%m-%d') as run from rates_npi_dedup")
def src_latest_run(spark: SparkSession, sf: str) -> DataFrame:
    """The last dated folder that is complete."""
    root = scratch(spark, "dated")
    days = [str(r[0]) for r in table(spark, sf, "rates_npi_dedup").select("snapshot_date").distinct().collect()]
    for day in [*days, "2999-01-01"]:
        os.makedirs(f"{root}/{day}/index")
        if day in days:
            open(f"{root}/{day}/index/_SUCCESS", "w").close()
    return spark.createDataFrame([(files.latest_run(root),)], "run string")


@query("select 'NPPES_Data_Dissemination_March_2031.zip' as registry, 'nucc_taxonomy_310.csv' as taxonomy")
def src_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest of files by the numbers in their names."""
    registry = [f"NPPES_Data_Dissemination_{m}.zip" for m in ("December_2030", "March_2031", "February_2031")]
    newest = files.newest(registry, r"_([A-Z][a-z]+)_(\d{4})\.zip"), files.newest(["nucc_taxonomy_91.csv", "nucc_taxonomy_310.csv"], r"taxonomy_(\d+)")
    return spark.createDataFrame([newest], "registry string, taxonomy string")


@query("select distinct file_id, file_name from rates_npi where is_in_state_file")
def src_selected(spark: SparkSession, sf: str) -> DataFrame:
    return files.selected(B.files_of(table(spark, sf, "rates_npi")), in_state=True).select("file_id", "file_name")


@query("select 'rates' as name, count(*) as n from rates union all select 'nppes', count(*) from nppes")
def src_attached(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a folder attached under a prefix, read only, and asked for by name."""
    files.attach(spark, sf, "old", (".parquet",))
    files.require_tables(spark, ["old_rates", "old_nppes"])
    return spark.sql("select 'rates' as name, count(*) as n from old_rates union all select 'nppes', count(*) from old_nppes")


# ---- sinks ------------------------------------------------------------------------------------------------------------------------


@query("select negotiated_type, count(*) as n, count(service_code) as n_places, 0 as n_empty from rates group by 1")
def snk_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A set of tables committed as a whole; one without rows keeps its columns."""
    folder = f"{scratch(spark, 'set')}/final"
    rates = table(spark, sf, "rates")
    P.write_tables({"rates": rates, "none": rates.limit(0)}, folder)
    empty = spark.read.parquet(f"{folder}/none").select(*rates.columns).count()
    back = spark.read.parquet(f"{folder}/rates").groupBy("negotiated_type").agg(F.count(F.lit(1)).alias("n"), F.count("service_code").alias("n_places"))
    return back.withColumn("n_empty", F.lit(empty))


@query("select count(*) as n, true as in_order from rates")
def snk_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Stored in the order of codes and rates: no two files' ranges overlap."""
    folder = scratch(spark, "ordered")
    B.clustered(table(spark, sf, "rates").filter("billing_code is not null"), ["billing_code", "negotiated_rate"], 8).write.mode("overwrite").parquet(folder)
    per = spark.read.parquet(folder).groupBy(F.input_file_name().alias("f")).agg(F.min("billing_code").alias("lo"), F.max("billing_code").alias("hi"), F.count(F.lit(1)).alias("n"))
    rows = per.orderBy("lo", "hi").collect()
    gone = table(spark, sf, "rates").filter("billing_code is null").count()
    return spark.createDataFrame([(sum(r.n for r in rows) + gone, all(a.hi <= b.lo for a, b in zip(rows, rows[1:], strict=False)))], "n long, in_order boolean")


@query("select coalesce(array_to_string(billing_code_modifier, '|'), '') as modifiers, count(*) as n, (select count(*) from rates) as n_written from rates group by 1")
def snk_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Lists as text; the number of rows is counted while they are written."""
    folder = scratch(spark, "export")
    n = P.export_csv(table(spark, sf, "rates").select("file_id", "i", "billing_code_modifier", "service_code"), folder)
    back = spark.read.option("header", True).csv(folder).groupBy(F.coalesce("billing_code_modifier", F.lit("")).alias("modifiers")).agg(F.count(F.lit(1)).alias("n"))
    return back.withColumn("n_written", F.lit(n).cast("long"))


@query("select snapshot_date, count(*) as n from rates_npi_dedup group by 1")
def snk_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions by date, a further date appended."""
    folder, rows = scratch(spark, "partitions"), table(spark, sf, "rates_npi_dedup")
    last = rows.agg(F.max("snapshot_date")).first()[0]
    for part in (rows.filter(F.col("snapshot_date") < F.lit(last)), rows.filter(F.col("snapshot_date") == F.lit(last))):
        part.write.mode("append").partitionBy("snapshot_date").parquet(folder)
    return spark.read.parquet(folder).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@query("select step, count(*) as n from anomalies group by 1")
def snk_published(spark: SparkSession, sf: str) -> DataFrame:
    """Published with a manifest and loaded again, twice, the second time from the cache."""
    folder = scratch(spark, "store")
    P.write_tables({"anomalies": table(spark, sf, "anomalies")}, f"{folder}/db")
    store = P.FolderStore(f"{folder}/objects")
    for day in ("2030-01-01", "2030-02-01", "2030-03-01"):
        P.publish(f"{folder}/db", store, day)
    P.load(store, f"{folder}/cache")
    return spark.read.parquet(f"{P.load(store, f'{folder}/cache')}/anomalies").groupBy("step").agg(F.count(F.lit(1)).alias("n"))


@query(f"select section, count(*) as n from ({CALLS_SQL['profile_report']}) group by 1")
def snk_report(spark: SparkSession, sf: str) -> DataFrame:
    """The text report has every row of every section."""
    sections = CALLS["profile_report"](spark, sf)
    titles = [r[0] for r in sections.select("section").distinct().orderBy("section").collect()]
    text = P.report({t: sections.filter(F.col("section") == t).select("cells") for t in titles})
    parts = [p.splitlines() for p in text.rstrip("\n").split("\n\n")]
    return spark.createDataFrame([(p[0][3:], len(p) - 2) for p in parts], "section string, n long")


@query("select file_date, count(*) as n from feed_rows group by 1")
def snk_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Files that keep arriving, each taken once, in two runs of a stream."""
    folder, rows = scratch(spark, "arrivals"), table(spark, sf, "feed_rows").select("file_date", "row_no", "received_at")
    for part in (0, 1):
        rows.filter(F.pmod(F.xxhash64("file_date"), F.lit(2)) == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = arrivals.new_files(spark, f"{folder}/in", rows.schema)
        arrivals.take_new(stream, f"{folder}/check", arrivals.into_table(f"{folder}/out", "file_date")).awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy(F.col("file_date").cast("date").alias("file_date")).agg(F.count(F.lit(1)).alias("n"))


# ---- table of contents ---------------------------------------------------------------------------------------------------------------

_NETS = "nets as (select distinct file_name, is_in_state_file, v as network from (select file_name, is_in_state_file, unnest(network_name) as v from rates_npi) where v is not null)"
_URL = "https://files.example.org/in/"


def contents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(rows of a table of contents, its parts): a structure per network, with a plan and the network's files."""
    nets = table(spark, sf, "rates_npi").select("file_name", F.explode("network_name").alias("network")).filter("network is not null").distinct()
    entry = F.struct(F.concat("network", F.lit(" (1 of 2)")).alias("description"), F.concat(F.lit(_URL), "file_name", F.lit("?sig="), F.length("network").cast("string")).alias("location"))
    plan = F.array(F.struct(F.col("network").alias("plan_name"), F.length("network").alias("plan_id"), F.lit(1).alias("odd")))
    one = nets.groupBy("network").agg(F.array_sort(F.collect_list(entry)).alias("in_network_files")).select(F.to_json(F.struct(plan.alias("reporting_plans"), "in_network_files")).alias("s"))
    text = F.concat(F.lit('{"reporting_structure": ['), F.array_join(F.array_sort(F.collect_list("s")), ","), F.lit('], "version": "1.0", "extra": 1}'))
    folder = scratch(spark, "contents")
    one.agg(text.alias("value")).write.mode("overwrite").text(folder)
    json_items.register(spark)
    rows = spark.read.format("json_items").option("lists", "reporting_structure").load(f"{folder}/part-*")
    return rows, I.parts(rows)


@query(f"with {_NETS} select file_name, 'files.example.org' as host, count(*) as n_references, contains(file_name, 'TX') as is_in_state_file, array_to_string(list_sort(list(network || ' (1 of 2)')), ',') as descriptions from nets group by file_name")
def index_files(spark: SparkSession, sf: str) -> DataFrame:
    f = I.files(I.references(contents(spark, sf)[1]), "TX")
    return f.select("file_name", "host", "n_references", "is_in_state_file", F.array_join("descriptions", ",").alias("descriptions"))


@query(f"with {_NETS} select distinct network as plan_name, len(network)::varchar as plan_id from nets")
def index_plans(spark: SparkSession, sf: str) -> DataFrame:
    return I.plans(contents(spark, sf)[1]).select("plan_name", "plan_id")


@query(f"with {_NETS} select network, count(*) as n_files from nets group by 1")
def index_networks(spark: SparkSession, sf: str) -> DataFrame:
    return I.files_per_network(I.references(contents(spark, sf)[1]))


@query(f"""with {_NETS}, f as (select file_name, count(*) as n from nets group by 1)
select (select count(distinct network) from nets) as n_structures, (select count(distinct network) from nets) as n_plans, (select count(*) from nets) as n_references, count(*) as n_files,
count_if(n > 1) as n_many_descriptions, count_if(contains(file_name, 'TX')) as n_in_state from f""")
def index_counters(spark: SparkSession, sf: str) -> DataFrame:
    p = contents(spark, sf)[1]
    refs = I.references(p)
    return I.counters(p, refs, I.files(refs, "TX"))


@query(f"with {_NETS} select 'unknown_key' as type, 'odd' as key, count(distinct network) as n from nets union all select 'unknown_key', 'extra', 1")
def index_oddities(spark: SparkSession, sf: str) -> DataFrame:
    rows, p = contents(spark, sf)
    return I.oddities(rows, p, I.files(I.references(p), "TX")).groupBy("type", "key").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_NETS} select network as plan_name, file_name from nets where contains(lower(network), 'value')")
def index_find_plans(spark: SparkSession, sf: str) -> DataFrame:
    """The files of plans whose name contains a text."""
    p = contents(spark, sf)[1]
    return I.find_plans(p, I.references(p), "Value").select("plan_name", X.base_name(F.col("url")).alias("file_name"))


# ---- places, keys, tracing, serving ----------------------------------------------------------------------------------------------------


@query(f"""{S.PREFIX}, gaz as (select distinct practice_zip5 as area, lat, lon from providers where lat is not null), cross_ as (select zip, min(left(zip, 4) || '0') as area from ({_ZIPS}) group by 1),
pts as (select area as zip5, lat, lon, 'direct' as how from gaz union all select zip, lat, lon, 'crosswalk' from cross_ c join gaz on gaz.area = c.area where zip not in (select area from gaz)),
who as (select npi, practice_zip5, left(practice_zip5, 4) || '1' as mailing_zip5 from providers)
select npi, coalesce(a.lat, b.lat) as lat, case when a.lat is not null then 'first_' || a.how when b.lat is not null then 'second_' || b.how end as point_source
from who left join pts a on a.zip5 = practice_zip5 left join pts b on b.zip5 = mailing_zip5""")
def provider_points(spark: SparkSession, sf: str) -> DataFrame:
    """The point of a provider's first ZIP, itself or through a crosswalk, else of its second."""
    who = S.providers(spark, sf).select("npi", "practice_zip5", F.concat(F.left("practice_zip5", F.lit(4)), F.lit("1")).alias("mailing_zip5"), "lat", "lon")
    places = who.filter("lat is not null").select(F.col("practice_zip5").alias("area"), "lat", "lon").distinct()
    zips = who.select(F.col("practice_zip5").alias("zip")).filter(F.col("zip").rlike(r"\A[0-9]{5}\z")).distinct().withColumn("area", F.concat(F.left("zip", F.lit(4)), F.lit("0")))
    return B.provider_points(who.drop("lat", "lon"), B.zip_points(places, zips)).select("npi", "lat", "point_source")


@query("select file_id, i, j, k, r, count(*) as n from rates group by 1, 2, 3, 4, 5 having count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return B.duplicates(table(spark, sf, "rates"), ["file_id", "i", "j", "k", "r"])


@query("select 'negotiated_rate_raw' as field, true as matches union all select 'expiration_date', true")
def trace_verified(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored price against the text of its source: which fields agree everywhere."""
    items = table(spark, sf, "in_network").dropDuplicates(["file_id", "i"])
    checks = {"negotiated_rate_raw": "negotiated_rate", "expiration_date": "expiration_date"}
    found = verified(E.rate_rows(items), items.select("file_id", "i", F.col("negotiated_rates").alias("raw")), checks)
    return found.filter("stored is not null or found is not null").select("field", "matches").distinct()


@query(f"{S.PREFIX} select strftime(max(snapshot_date), '%Y-%m-%d') as snapshot_date, count(*) as n_rates, count(distinct npi) as n_npis, true as ok from fact")
def service_meta(spark: SparkSession, sf: str) -> DataFrame:
    """What the serving edge says of its tables, as plain values."""
    s = Service(S.fact(spark, sf))
    m = s.meta()
    return spark.createDataFrame([(m["snapshot_date"], m["n_rates"], m["n_npis"], s.health()["ok"])], "snapshot_date string, n_rates long, n_npis long, ok boolean")


@query("select negotiated_type, count_if(negotiated_rate <> 0) as n_finite, count(*) as n from rates group by 1")
def finite_values(spark: SparkSession, sf: str) -> DataFrame:
    """Infinite values, here those of zero rates, are null at the edge."""
    v = X.finite(F.when(F.col("negotiated_rate") == 0, F.lit(float("inf"))).otherwise(F.col("negotiated_rate")))
    return table(spark, sf, "rates").groupBy("negotiated_type").agg(F.count(v).alias("n_finite"), F.count(F.lit(1)).alias("n"))


@query(f"select file_id, i, billing_code from in_network where billing_code in {CODES} and billing_code_type = '{CODE_TYPE}'")
def items_of_codes(spark: SparkSession, sf: str) -> DataFrame:
    return E.of_codes(table(spark, sf, "in_network"), CODES, CODE_TYPE).select("file_id", "i", "billing_code")
