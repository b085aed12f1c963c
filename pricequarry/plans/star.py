"""Fact and dimensions of the analytic calls, from the project's tables.

They are built once, by ``write_site``, and stored: the fact numbered, partitioned by snapshot date and in the order of codes, so
that scans of a code skip the other files. Calls read what is stored; what they join was joined when it was built.

The test data has no tags and no coordinates: two small rules stand in for these inputs (``tag_columns`` by digits of the TIN,
``point`` by digits of the ZIP). Everything else is read from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricequarry.functions.scalar import expired, first_match, place_group
from pricequarry.session import cut, exists, fresh_folder, table

# columns that order the rows of a code before they are numbered; together they are all columns of the fact that vary
ORDER = (
    "billing_code", "tin", "npi", "negotiated_rate", "negotiated_type", "billing_class", "service_text", "expiration_date", "negotiated_rate_raw", "rate_unit",
    "setting", "network_text", "negotiation_arrangement", "n_sources",
)


def build_providers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per registered provider, with type by kind and leading characters of the primary code, and a map point."""
    n = table(spark, sf, "nppes")
    code = F.col("primary_taxonomy_code")
    kind = first_match(
        [(F.col("entity_type_code") == "2", "Organization"), (code.startswith("9A"), "Therapist"), (code.startswith("9B"), "Counselor"), (code.startswith("9C"), "Physician")],
        "Other",
    )
    zip5 = F.left("practice_zip", F.lit(5))
    return n.select("npi", "provider_name", "entity_type_code", "org_name", "primary_taxonomy_code", kind.alias("provider_type"), prescriber(code).alias("is_prescriber"), "practice_city", "practice_state", zip5.alias("practice_zip5"), *point(zip5))


def point(zip5: Column) -> tuple[Column, Column]:
    """Stand-in for a gazetteer: latitude and longitude from digits of the ZIP; none for ZIPs that end with 7."""
    known = zip5.rlike(r"\A[0-9]{5}\z") & (F.right(zip5, F.lit(1)) != "7")
    lat = F.lit(25.0) + F.substring(zip5, 2, 2).cast("int") / F.lit(10.0)
    lon = F.lit(-106.0) + F.substring(zip5, 3, 2).cast("int") / F.lit(8.0)
    return F.when(known, lat).alias("lat"), F.when(known, lon).alias("lon")


def tag_columns(tin: Column) -> list[Column]:
    """Stand-in for a list of tagged entities: type, name and confidence from the last two digits of the TIN."""
    a, b = F.right(tin, F.lit(1)).try_cast("int"), F.substring(tin, -2, 1).try_cast("int")
    kind = F.when(a % 5 == 0, "platform").when(a % 5 == 1, "health_system")
    name = F.when(a % 5 == 0, F.concat(F.lit("Platform "), (b % 2).cast("string"))).when(a % 5 == 1, F.concat(F.lit("System "), (b % 3).cast("string")))
    sure = F.when(a % 5 < 2, F.element_at(F.array(F.lit("confirmed"), F.lit("high"), F.lit("medium")), b % 3 + 1))
    return [kind.alias("tag_type"), name.alias("tag_name"), sure.alias("tag_confidence")]


def build_tins(spark: SparkSession, sf: str) -> DataFrame:
    """One row per TIN: most common name, all names by frequency, number of NPIs, tag."""
    g = table(spark, sf, "provider_groups").filter("tin_value is not null")
    named = g.filter("tin_business_name is not null").groupBy("tin_value", "tin_business_name").agg(F.count(F.lit(1)).alias("n"))
    names = named.groupBy("tin_value").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), F.col("tin_business_name").alias("name")))).alias("v"))
    names = names.select("tin_value", F.transform("v", lambda x: x["name"]).alias("names"))
    size = g.groupBy("tin_value").agg(F.count_distinct("npi").alias("n_npis"))
    t = size.join(names, "tin_value", "left")
    text = F.upper(F.concat_ws(" ", "tin_value", "names"))
    return t.select(F.col("tin_value").alias("tin"), F.try_element_at("names", F.lit(1)).alias("display_name"), "names", "n_npis", text.alias("search_text"), *tag_columns(F.col("tin_value")))


def latest_snapshot(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """The rows of the last snapshot."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def build_fact(spark: SparkSession, sf: str) -> DataFrame:
    """One row per deduplicated rate of the last snapshot with what filters need; dimensions join from the small side."""
    r = latest_snapshot(table(spark, sf, "rates_npi_dedup"))
    p = build_providers(spark, sf)
    t = build_tins(spark, sf)
    d = r.join(p, "npi", "left").join(t.drop("names").withColumnRenamed("tin", "tin_value").withColumnRenamed("n_npis", "tin_npis"), "tin_value", "left")
    scope = first_match([(F.col("entity_type_code").isNull(), "not_registered"), (F.col("entity_type_code") == "2", "organization")], "expected")
    return d.select(
        "snapshot_date", "billing_code", "negotiation_arrangement", "negotiated_type", "negotiated_rate", "negotiated_rate_raw", "rate_unit", "is_zero_rate",
        "billing_class", "setting", "npi", "is_valid_npi", F.col("tin_value").alias("tin"), "networks", "service_code", place_group(F.col("service_code")).alias("pos_group"),
        "billing_code_modifier", "expiration_date", expired(F.col("expiration_date"), F.col("snapshot_date")).alias("is_expired"), "is_in_state_any", "n_sources",
        "provider_name", F.coalesce("provider_type", F.lit("Other")).alias("provider_type"), "practice_state", "practice_city", "practice_zip5", "lat", "lon",
        F.col("display_name").alias("tin_name"), F.col("search_text").alias("tin_search"), "tag_type", "tag_name", "tag_confidence", scope.alias("scope_flag"),
        F.array_join(F.array_sort("service_code"), ",").alias("service_text"), F.array_join(F.array_sort("networks"), ",").alias("network_text"),
    )


def numbered(df: DataFrame, order: list[Column], name: str = "rate_id", partitions: int | None = None) -> DataFrame:
    """Gap-free numbers from 1 in the given order, without gathering the rows or any group of them in one task.

    Rows are range-partitioned and sorted, written once so that their partitions are settled, and numbered by their place in
    the partition plus the sizes of the partitions before. Rows with equal order columns are numbered arbitrarily.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut(keyed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(before, "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def prescriber(code: Column) -> Column:
    """Whether the primary code is of a kind that prescribes, by its leading characters; null is none."""
    return F.coalesce(code.startswith("9C") | code.startswith("9D"), F.lit(False))


def build_pos_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The different lists of place codes, numbered by their text; null is one of them."""
    r = latest_snapshot(table(spark, sf, "rates_npi_dedup"))
    sets = r.select(F.array_sort("service_code").alias("codes")).distinct()
    return sets.select(F.row_number().over(Window.orderBy(F.array_join("codes", ",").asc_nulls_last())).alias("pos_set_id"), "codes")


def write_site(spark: SparkSession, sf: str, folder: str) -> None:
    """Builds and stores all that the calls read; a mark is written last, so that half a site is none."""
    numbers = numbered(build_fact(spark, sf), [F.col(c).asc_nulls_last() for c in ORDER])
    numbers.write.mode("overwrite").option("compression", "zstd").partitionBy("snapshot_date").parquet(f"{folder}/fact")
    for name, df in (("providers", build_providers(spark, sf)), ("tins", build_tins(spark, sf)), ("pos_sets", build_pos_sets(spark, sf))):
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
    spark.range(1).coalesce(1).write.mode("overwrite").json(f"{folder}/complete")


def site(spark: SparkSession, sf: str) -> str:
    """The folder of the site of these tables; built in the shared folder by the first call of an application that asks for it."""
    sc = spark.sparkContext
    if not hasattr(sc, "_pq_sites"):
        sc._pq_sites = {}
    if sf not in sc._pq_sites:
        folder = fresh_folder(spark, "site")
        write_site(spark, sf, folder)
        sc._pq_sites[sf] = folder
    return sc._pq_sites[sf]


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if not exists(spark, f"{folder}/complete"):
        raise FileNotFoundError(f"no complete site in {folder}")
    return spark.read.parquet(f"{folder}/{name}")


def fact(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact, with rate_id."""
    return stored(spark, site(spark, sf), "fact")


def providers(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, site(spark, sf), "providers")


def tins(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, site(spark, sf), "tins")


def pos_sets(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, site(spark, sf), "pos_sets")


PREFIX = r"""
with snap as (select max(snapshot_date) as d from rates_npi_dedup),
providers as (
  select npi, provider_name, entity_type_code, org_name, primary_taxonomy_code, practice_city, practice_state, left(practice_zip, 5) as practice_zip5,
         case when entity_type_code = '2' then 'Organization' when primary_taxonomy_code like '9A%' then 'Therapist'
              when primary_taxonomy_code like '9B%' then 'Counselor' when primary_taxonomy_code like '9C%' then 'Physician' else 'Other' end as provider_type,
         case when regexp_full_match(left(practice_zip, 5), '[0-9]{5}') and substr(practice_zip, 5, 1) <> '7' then 25.0::double + substr(practice_zip, 2, 2)::int / 10.0::double end as lat,
         case when regexp_full_match(left(practice_zip, 5), '[0-9]{5}') and substr(practice_zip, 5, 1) <> '7' then -106.0::double + substr(practice_zip, 3, 2)::int / 8.0::double end as lon
  from nppes),
tin_names as (
  select tin_value, list(name order by n desc, name) as names
  from (select tin_value, tin_business_name as name, count(*) as n from provider_groups where tin_value is not null and tin_business_name is not null group by 1, 2)
  group by 1),
tins as (
  select tin_value as tin, names[1] as display_name, names, n_npis, upper(concat_ws(' ', tin_value, array_to_string(names, ' '))) as search_text,
         case when a % 5 = 0 then 'platform' when a % 5 = 1 then 'health_system' end as tag_type,
         case when a % 5 = 0 then 'Platform ' || (b % 2) when a % 5 = 1 then 'System ' || (b % 3) end as tag_name,
         case when a % 5 < 2 then (['confirmed', 'high', 'medium'])[b % 3 + 1] end as tag_confidence
  from (select tin_value, count(distinct npi) as n_npis, try_cast(right(tin_value, 1) as int) as a, try_cast(substr(tin_value, -2, 1) as int) as b
        from provider_groups where tin_value is not null group by 1)
  left join tin_names using (tin_value)),
fact as (
  select r.snapshot_date, r.billing_code, r.negotiation_arrangement, r.negotiated_type, r.negotiated_rate, r.negotiated_rate_raw, r.rate_unit, r.is_zero_rate,
         r.billing_class, r.setting, r.npi, r.is_valid_npi, r.tin_value as tin, r.networks, r.service_code,
         case when list_has_any(r.service_code, ['11']) and list_has_any(r.service_code, ['22', '19']) then 'all_settings'
              when list_has_any(r.service_code, ['11']) then 'non_facility' when list_has_any(r.service_code, ['22', '19']) then 'facility' else 'unspecified' end as pos_group,
         r.billing_code_modifier, r.expiration_date,
         coalesce(case when regexp_matches(r.expiration_date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') then try_cast(r.expiration_date as date) < r.snapshot_date end, false) as is_expired,
         r.is_in_state_any, r.n_sources, p.provider_name, coalesce(p.provider_type, 'Other') as provider_type, p.practice_state, p.practice_city, p.practice_zip5, p.lat, p.lon,
         t.display_name as tin_name, t.search_text as tin_search, t.tag_type, t.tag_name, t.tag_confidence,
         case when p.entity_type_code is null then 'not_registered' when p.entity_type_code = '2' then 'organization' else 'expected' end as scope_flag,
         array_to_string(list_sort(r.service_code), ',') as service_text, array_to_string(list_sort(r.networks), ',') as network_text
  from rates_npi_dedup r join snap on r.snapshot_date = snap.d left join providers p on p.npi = r.npi left join tins t on t.tin = r.tin_value),
numbered as (select *, row_number() over (order by """ + ", ".join(f"{c} nulls last" for c in ORDER) + ") as rate_id from fact)"
