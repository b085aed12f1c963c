"""A payer's table of contents as tables: plans, file references, unique files, oddities, counters.

Input is what the JSON source gives for it with the list ``reporting_structure``; its elements go through the nested
flattener, the rest is built-in expressions, so a table of contents of any size is spread over tasks after its one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricequarry.functions import scalar as X
from pricequarry.sources.nested import Repeated, flatten

# What a table of contents holds.
TOP = "reporting_entity_name reporting_entity_type last_updated_on version reporting_structure".split()
STRUCTURE = "reporting_plans in_network_files allowed_amount_file".split()
PLAN = "plan_name issuer_name plan_id_type plan_id plan_market_type plan_sponsor_name".split()
FILE = "description location".split()
LISTS = {"in_network_files": "in_network", "allowed_amount_file": "allowed_amount"}
SHAPE = {
    "structure": Repeated("structure", True),
    "structure.reporting_plans": Repeated("plan", True),
    "structure.in_network_files": Repeated("in_network", True),
    "structure.allowed_amount_file": Repeated("allowed_amount", True),
}
KNOWN = {"structure": STRUCTURE, "plan": PLAN, "in_network": FILE, "allowed_amount": FILE}


def parts(rows: DataFrame) -> DataFrame:
    """Structures, plans and file entries with their position s and place n in the list."""
    items = rows.filter((F.col("top_key") == "reporting_structure") & F.col("idx").isNotNull())
    flat = flatten(items, ["file", "idx"], "raw", "structure", SHAPE)
    return flat.select(F.col("file").alias("source"), F.col("idx").cast("long").alias("s"), F.try_element_at("ordinals", F.lit(2)).alias("n"), "kind", "attributes")


def _get(name: str) -> Column:
    return F.col("attributes")[name].alias(name)


def plans(p: DataFrame) -> DataFrame:
    return p.filter("kind = 'plan'").select("source", "s", F.col("n").alias("q"), *[_get(c) for c in PLAN])


def references(p: DataFrame) -> DataFrame:
    """(source, s, f, file_kind, file_id, file_key, description, url) of every entry with a location."""
    r = p.filter(F.col("kind").isin(list(LISTS.values())) & (F.trim(F.coalesce(F.col("attributes")["location"], F.lit(""))) != ""))
    url = F.col("attributes")["location"]
    return r.select("source", "s", F.col("n").alias("f"), F.col("kind").alias("file_kind"), X.file_id(url).alias("file_id"), X.file_key(url).alias("file_key"), _get("description"), url.alias("url"))


def files(refs: DataFrame, marker: str) -> DataFrame:
    """One row per file, whatever the signature of its URL: the first URL and kind in document order, all descriptions."""
    at = F.struct("source", "s", F.when(F.col("file_kind") == "in_network", 0).otherwise(1).alias("o"), "f")
    out = refs.groupBy("file_key", "file_id").agg(
        F.min_by("url", at).alias("url"), F.min_by("file_kind", at).alias("file_kind"), F.array_sort(F.collect_set("description")).alias("descriptions"), F.count(F.lit(1)).alias("n_references"),
        (F.count_distinct("file_kind") > 1).alias("kind_conflict"),
    )
    name = X.base_name(F.col("file_key"))
    return out.withColumn("file_name", name).withColumn("host", X.host(F.col("file_key"))).withColumn("is_in_state_file", name.contains(marker))


def oddities(rows: DataFrame, p: DataFrame, found: DataFrame) -> DataFrame:
    """(type, key, json_path): unknown keys at every level, blank locations, files of two kinds."""
    base = F.format_string("reporting_structure[%d]", "s")
    place = F.when(F.col("kind") == "structure", base)
    for kind, name in (("plan", "reporting_plans"), ("in_network", "in_network_files"), ("allowed_amount", "allowed_amount_file")):
        place = place.when(F.col("kind") == kind, F.concat(base, F.lit(f".{name}["), F.col("n").cast("string"), F.lit("]")))
    known = F.lit(None).cast("array<string>")
    for kind, names in KNOWN.items():
        known = F.when(F.col("kind") == kind, F.array(*map(F.lit, names))).otherwise(known)
    keys = p.select(place.alias("at"), F.explode(F.array_except(F.map_keys("attributes"), known)).alias("key"))
    unknown = keys.select(F.lit("unknown_key").alias("type"), "key", F.concat_ws(".", "at", "key").alias("json_path"))
    top = rows.filter(F.col("idx").isNull() & ~F.col("top_key").isin([*TOP, "_file"])).select(F.lit("unknown_key").alias("type"), F.col("top_key").alias("key"), F.col("top_key").alias("json_path"))
    blank = p.filter(F.col("kind").isin(list(LISTS.values())) & (F.trim(F.coalesce(F.col("attributes")["location"], F.lit(""))) == ""))
    blank = blank.select(F.lit("blank_location").alias("type"), F.lit("location").alias("key"), place.alias("json_path"))
    conflict = found.filter("kind_conflict").select(F.lit("file_kind_conflict").alias("type"), F.col("file_key").alias("key"), F.lit(None).cast("string").alias("json_path"))
    return unknown.unionByName(top).unionByName(blank).unionByName(conflict)


def counters(p: DataFrame, refs: DataFrame, found: DataFrame) -> DataFrame:
    """One row: structures, plans, references, unique files, files with several descriptions, by kind."""
    a = p.agg(F.count_if(F.col("kind") == "structure").alias("n_structures"), F.count_if(F.col("kind") == "plan").alias("n_plans"))
    b = refs.agg(F.count(F.lit(1)).alias("n_references"))
    c = found.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.size("descriptions") > 1).alias("n_many_descriptions"), F.count_if("is_in_state_file").alias("n_in_state"))
    one = a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k").join(c.withColumn("k", F.lit(1)), "k")
    return one.drop("k")


def find_plans(p: DataFrame, refs: DataFrame, text: str) -> DataFrame:
    """Plans whose name contains the text, or whose id is it, with the files of their structure."""
    t = text.strip().lower()
    hit = plans(p).filter(F.lower("plan_name").contains(t) | (F.lower("plan_id") == t)).select("source", "s", "plan_name", "plan_id")
    return hit.join(refs.select("source", "s", "file_kind", "description", "url"), ["source", "s"], "left")


def files_per_network(refs: DataFrame) -> DataFrame:
    """(network, n_files): descriptions without a trailing 'N of M'."""
    name = F.trim(F.regexp_replace("description", r"(?i)\s*[-(]?\s*\d+\s+of\s+\d+\s*\)?\s*$", ""))
    return refs.select(name.alias("network"), "file_key").distinct().groupBy("network").agg(F.count(F.lit(1)).alias("n_files"))


def flat_export(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """Prices with the NPIs and TINs of the groups they name, lists joined, a row also for a price whose group isn't defined."""
    g = groups.select("file_id", "provider_group_id", "tin_type", "tin_value", "npi")
    lists = {c: F.array_join(c, "|") for c in ("service_code", "billing_code_modifier")}
    return rates.join(g, ["file_id", "provider_group_id"], "left").withColumns(lists)
