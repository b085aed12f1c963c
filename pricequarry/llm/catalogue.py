"""Registered queries of the operators for training text, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricequarry.llm import leakage, linkage, packing, quantiles, reading
from pricequarry.session import table

GROUP = ["snapshot_date", "billing_code", "rate_unit"]
RANKS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def p4_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, component): every registry and TIN key with a usable name, and the class of keys it belongs to."""
    nppes = table(spark, sf_dir, "nppes")
    groups = table(spark, sf_dir, "provider_groups").filter("tin_value is not null")
    names = nppes.select(F.concat(F.lit("npi:"), "npi").alias("key"), F.col("org_name").alias("name")).unionByName(
        groups.select(F.concat(F.lit("tin:"), "tin_value").alias("key"), F.col("tin_business_name").alias("name"))
    )
    individuals = nppes.filter("org_name is null").select("last_name", "first_name")
    return linkage.linked_keys(names, individuals)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of registry and TIN keys of the same organisation or sole practitioner."""
    return linkage.key_pairs(p4_clusters(spark, sf_dir))


def every_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per snapshot_date, billing_code and rate_unit, and merged over units, days and both ('*')."""
    daily = quantiles.sketches(table(spark, sf_dir, "rates_npi_dedup"), GROUP, "negotiated_rate")
    units = quantiles.combine(daily, GROUP, ["rate_unit"])
    every = daily.unionByName(units)
    return every.unionByName(quantiles.combine(every, GROUP, ["snapshot_date"]))


def p7_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of negotiated_rate per billing_code and rate_unit, for each snapshot_date and for all combined ('*')."""
    return quantiles.percentiles(every_sketch(spark, sf_dir), GROUP, RANKS)


def p7_within_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each group, merged ones too, and each percentile whether the estimate's exact rank keeps within three standard deviations."""
    src = table(spark, sf_dir, "rates_npi_dedup").filter("negotiated_rate is not null and not isnan(negotiated_rate)")
    est = quantiles.percentiles(every_sketch(spark, sf_dir), GROUP, RANKS)
    est = est.withColumn("slack", F.least((1 - F.col("q")) * (3 * quantiles.RELATIVE / 32), F.lit(3 * quantiles.ABSOLUTE / 32)) + 1 / F.col("n"))
    lists = est.groupBy(*GROUP).agg(F.first("n").alias("n"), F.collect_list(F.struct("q", "value", "slack")).alias("e"))
    keys = [F.col(c).cast("string").alias(c) for c in GROUP]
    same = lambda c: F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}"))
    counted = src.groupBy(*keys, F.col("negotiated_rate").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    for c in ("snapshot_date", "rate_unit"):
        counted = counted.withColumn(c, F.explode(F.array(F.col(c), F.lit("*"))))
    counted = counted.groupBy(*GROUP, "v").agg(F.sum("c").alias("c"))
    met = counted.alias("s").join(lists.alias("l"), [same(c) for c in GROUP]).select(*[f"l.{c}" for c in GROUP], "l.n", "s.v", "s.c", F.explode("l.e").alias("x"))
    below, upto = F.sum(F.when(F.col("v") < F.col("x.value"), F.col("c")).otherwise(0)), F.sum(F.when(F.col("v") <= F.col("x.value"), F.col("c")).otherwise(0))
    rank = met.groupBy(*GROUP, "n", "x").agg(below.alias("below"), upto.alias("upto"))
    ok = (F.col("below") <= (F.col("x.q") + F.col("x.slack")) * F.col("n")) & (F.col("upto") >= (F.col("x.q") - F.col("x.slack")) * F.col("n"))
    return rank.select(*GROUP, F.col("n").alias("n_values"), F.col("x.q").alias("q"), ok.alias("within_bound"))


def p8_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document or piece of one."""
    return packing.packing_plan(table(spark, sf_dir, "documents"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill(packing.packing_plan(table(spark, sf_dir, "documents")))


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document whether its pieces are the whole of it, in order and without gaps, split only if longer than a container,
    and none of its containers holds more than its capacity, each token in a place of its own."""
    plan = packing.packing_plan(table(spark, sf_dir, "documents"))
    stored = linkage.cut(plan)
    inside = stored.filter("container_id is not null")
    full = inside.groupBy("container_id").agg((F.sum("n_tokens") <= 2048).alias("fits"), (F.sum("n_tokens") == F.max(F.col("offset") + F.col("n_tokens"))).alias("tight"))
    rows = stored.join(full, "container_id", "left")
    per = rows.groupBy("doc_id").agg(
        ((F.sum("n_tokens") == F.max(F.col("token_start") + F.col("n_tokens"))) & (F.count_distinct("token_start") == F.count(F.lit(1))) & (F.max("piece") + 1 == F.count(F.lit(1)))).alias("whole"),
        ((F.count(F.lit(1)) == 1) | (F.sum("n_tokens") > 2048)).alias("split_only_if_longer"), F.bool_and(F.coalesce(F.col("fits") & F.col("tight"), F.lit(True))).alias("fits"),
    )
    return per


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item's passage."""
    found = leakage.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id")


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are left when those with leaked passages are removed."""
    documents = table(spark, sf_dir, "documents")
    return leakage.without_leaks(documents, leakage.find_leaks(documents, table(spark, sf_dir, "eval_items"))).select("doc_id", "lang", "n_chars")


def p9_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document whether it is either clean or found to hold a passage, never both."""
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    found = linkage.cut(leakage.find_leaks(documents, items).select("doc_id", "item_id").distinct())
    clean = leakage.without_leaks(documents, found).select("doc_id").withColumn("clean", F.lit(True))
    held = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = documents.select("doc_id").join(clean, "doc_id", "left").join(held, "doc_id", "left")
    return rows.select("doc_id", (F.col("clean").isNotNull() != F.col("n").isNotNull()).alias("accounted"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of every English page with enough prose."""
    pages = reading.pages(table(spark, sf_dir, "documents"))
    model = reading.train(pages, table(spark, sf_dir, "reading_labels"))
    return reading.reading_levels(pages, model).select("doc_id", "band")


QUERIES = {f.__name__: f for f in (p4_found, p4_clusters, p7_percentiles, p7_within_bound, p8_plan, p8_fill, p8_checked, p9_found, p9_clean, p9_accounted, p10_found)}
_DAYS = "(select unnest([strftime(snapshot_date, '%Y-%m-%d'), '*']) as snapshot_date, billing_code, rate_unit from rates_npi_dedup where negotiated_rate is not null)"
SQL: dict[str, str] = {
    "p7_within_bound": f"""
select snapshot_date, billing_code, rate_unit, n_values, q, true as within_bound
from (select snapshot_date, billing_code, rate_unit, count(*) as n_values from (select snapshot_date, billing_code, unnest([rate_unit, '*']) as rate_unit from {_DAYS}) group by 1, 2, 3)
cross join (select unnest([{", ".join(map(str, RANKS))}]::double[]) as q)""",
    "p8_checked": "select doc_id, true as whole, true as split_only_if_longer, true as fits from documents",
    "p9_accounted": "select doc_id, true as accounted from documents",
}
