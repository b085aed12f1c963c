"""From extracted tables to the query tables: NPI grain, deduplication with lineage, views, quality tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricequarry.functions.scalar import sorted_union, valid_npi

GROUP_KEY = ["file_id", "provider_group_id"]
# Columns in which rows must agree to be one deduplicated rate; the list columns agree as sorted lists.
SAME = (
    "billing_code", "billing_code_type", "billing_code_type_version", "negotiation_arrangement", "name", "description", "tin_type", "tin_value", "tin_business_name",
    "npi", "is_valid_npi", "negotiated_type", "negotiated_rate_raw", "rate_unit", "is_zero_rate", "billing_class", "setting", "expiration_date", "additional_information",
)
SAME_LISTS = ("service_code", "billing_code_modifier")
POSITIONS = ("file_id", "i", "j", "k", "r", "m", "n", "p")


def files_of(rates_npi: DataFrame) -> DataFrame:
    """One row per source file."""
    return rates_npi.select("file_id", "file_name", "is_in_state_file", "file_sha256", "file_last_updated_on").distinct()


def npi_grain(rates: DataFrame, groups: DataFrame, files: DataFrame) -> DataFrame:
    """One row per price and NPI of each group it names: many to many, so both sides shuffle on (file, group) and adaptive
    execution splits large groups; files join from the small side and may be missing."""
    g = groups.withColumn("is_valid_npi", valid_npi(F.col("npi")))
    return rates.join(g, GROUP_KEY).join(files, "file_id", "left")


def referenced_groups(groups: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows of groups that a price names."""
    return groups.join(rates, GROUP_KEY, "left_semi")


def undefined_groups(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """(file_id, provider_group_id, n_rows) named by prices but defined nowhere in their file."""
    return rates.join(groups, GROUP_KEY, "left_anti").groupBy(*GROUP_KEY).agg(F.count(F.lit(1)).alias("n_rows"))


def deduplicated(rows: DataFrame) -> DataFrame:
    """Rows that agree in all of SAME (nulls agree) become one: networks united, sources counted.

    Lineage isn't carried here: ``lineage`` has it, one row per source, under the same ``rate_key``.
    """
    keyed = rows.withColumns({c: F.array_sort(c) for c in SAME_LISTS})
    return keyed.groupBy(*SAME, *SAME_LISTS).agg(
        F.any_value("negotiated_rate", True).alias("negotiated_rate"), sorted_union(F.collect_set("network_name")).alias("networks"),
        F.bool_or("is_in_state_file").alias("is_in_state_any"), F.bool_and("is_in_state_file").alias("is_in_state_all"), F.count(F.lit(1)).alias("n_sources"),
    )


def rate_key() -> Column:
    """A key of the deduplicated rate that a row belongs to."""
    return F.sha2(F.to_json(F.struct(*SAME, *[F.array_sort(c).alias(c) for c in SAME_LISTS]), {"ignoreNullFields": "false"}), 256)


def lineage(rows: DataFrame) -> DataFrame:
    """Each source of each deduplicated rate, as a table of its own: nothing wide is gathered per rate."""
    return rows.select(rate_key().alias("rate_key"), *POSITIONS, "network_name", "provider_group_id", *SAME_LISTS)


def sources_list(lineage_rows: DataFrame) -> DataFrame:
    """(rate_key, sources): the sources of selected rates as ordered lists of structs, for the reader of a few rates."""
    order = F.struct(*POSITIONS)
    return lineage_rows.groupBy("rate_key").agg(F.array_sort(F.collect_list(order)).alias("sources"))


def named(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows with the provider's name and, where the TIN is an NPI, that provider's too."""
    a = registry.select("npi", F.col("provider_name").alias("npi_name"), "practice_state")
    b = registry.select(F.col("npi").alias("tin_value"), F.col("provider_name").alias("tin_npi_name"))
    out = rows.join(a, "npi", "left").join(b, "tin_value", "left")
    return out.withColumn("tin_npi_name", F.when(F.col("tin_type") == "npi", F.col("tin_npi_name")))


def stacked(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def clustered(df: DataFrame, columns: Sequence[str], partitions: int) -> DataFrame:
    """Stored order: ranges of the first columns per file, sorted within, so that min/max statistics prune scans."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def price_grain(rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts over different prices (file, item, rate, price), whatever number of groups they are listed for."""
    grain = ["file_id", "i", "j", "k"]
    rows = rates.select(*dict.fromkeys([*grain, *by, "is_zero_rate", "negotiated_rate"])).distinct()
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_prices"), F.count_if("is_zero_rate").alias("n_zero"), F.count_distinct("file_id").alias("n_files"))


def conflicts(fact: DataFrame) -> DataFrame:
    """Keys that have more than one price within a network."""
    keys = ["billing_code", "tin", "npi", "network", "billing_class", "service_text", "negotiated_type"]
    rows = fact.withColumn("network", F.explode("networks")).groupBy(*keys)
    out = rows.agg(F.count_distinct("negotiated_rate_raw").alias("n_prices"), F.array_join(F.array_sort(F.collect_set("negotiated_rate_raw")), ";").alias("prices"))
    return out.filter("n_prices > 1")


def conflict_rows(fact: DataFrame) -> DataFrame:
    """The fact's rows that take part in a conflict."""
    c = conflicts(fact).drop("n_prices", "prices").withColumnRenamed("network", "_network")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ("billing_code", "tin", "npi", "billing_class", "service_text", "negotiated_type")]
    return fact.alias("f").join(c.alias("c"), [*same, F.array_contains("f.networks", F.col("c._network"))], "left_semi")


def quality_stats(fact: DataFrame, anomalies: DataFrame, sources: DataFrame) -> DataFrame:
    """(metric, n): all scalar counts of the fact in one pass, what deduplication removed of its ``sources``, conflicting keys,
    unregistered NPIs, rows by scope, and anomalies by step and type."""
    tests = {
        "rates": F.lit(True), "zero_rate": F.col("is_zero_rate"), "null_rate": F.col("negotiated_rate").isNull(), "invalid_npi": ~F.col("is_valid_npi"), "expired": F.col("is_expired"),
        "not_registered": F.col("scope_flag") == "not_registered", "not_registered_valid_npi": (F.col("scope_flag") == "not_registered") & F.col("is_valid_npi"),
        "percentage": F.col("rate_unit") == "percent_of_billed_charges", "unknown_unit": F.col("rate_unit") == "unknown", "no_network": F.col("networks").isNull(), "many_sources": F.col("n_sources") > 1,
        **{f"scope_{x}": F.col("scope_flag") == x for x in SCOPES},
    }
    gone = F.when((F.col("scope_flag") == "not_registered") & F.col("is_valid_npi"), F.col("npi"))
    one = fact.agg(*[F.count_if(c).alias(m) for m, c in tests.items()], F.count_distinct(gone).alias("npis_not_registered"))
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("n")) for m in one.columns]))
    scalar = one.select(pairs.alias("x")).select("x.metric", "x.n")
    counted = lambda df, metric, sign=1: df.agg((F.count(F.lit(1)) * sign).alias("n")).select(F.lit(metric).alias("metric"), "n")
    removed = counted(sources, "rows_removed_by_dedup").unionByName(counted(deduplicated(sources), "rows_removed_by_dedup", -1))
    merged = counted(sources, "rows_before_dedup").unionByName(removed).groupBy("metric").agg(F.sum("n").alias("n"))
    clash = conflicts(fact).agg(F.count(F.lit(1)).alias("n")).select(F.lit("conflicting_keys").alias("metric"), "n")
    logged = anomalies.groupBy(F.concat_ws(":", F.lit("anomaly"), "step", "type").alias("metric")).agg(F.count(F.lit(1)).alias("n"))
    return scalar.unionByName(merged).unionByName(clash).unionByName(logged)


SCOPES = ("expected", "organization", "not_registered")


def conflict_page(found: DataFrame, most: int = 500) -> DataFrame:
    """The conflicts with most prices first, then by NPI and the rest of the key."""
    rest = [c for c in found.columns if c not in ("n_prices", "prices", "npi")]
    return found.orderBy(F.desc("n_prices"), F.col("npi").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]).limit(most)


def profile_sections(rates: DataFrame, anomalies: DataFrame, groups: DataFrame, capitation: DataFrame, counts: DataFrame, most: int = 15) -> dict[str, DataFrame]:
    """The report's sections, in its order: seven over different prices, then anomalies, odd NPIs, capitation, counts per file."""
    sets = {c: F.array_join(F.array_sort(c), ",").alias(c) for c in SAME_LISTS}
    prices = rates.select("file_id", "i", "j", "k", "billing_code", "negotiated_type", "rate_unit", "billing_class", "setting", "negotiation_arrangement", *sets.values(), "is_zero_rate").distinct()

    def by(*columns: str, rows: DataFrame = prices, name: str = "prices") -> DataFrame:
        out = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
        return out.orderBy(F.desc(name), *[F.col(c).asc_nulls_last() for c in columns])

    codes = by("billing_code", "rate_unit", "billing_class")
    odd = groups.filter(~valid_npi(F.col("npi")))
    cap = capitation.groupBy("covered_target_codes", "rate_unit").agg(F.count(F.lit(1)).alias("rows"), F.min("negotiated_rate").alias("min_rate"), F.max("negotiated_rate").alias("max_rate"))
    return {
        "prices by type, unit and class": by("negotiated_type", "rate_unit", "billing_class"),
        "prices by code, unit and class": codes.orderBy(*[F.col(c).asc_nulls_last() for c in codes.columns]),
        "prices by arrangement": by("negotiation_arrangement"),
        "prices by setting": by("setting"),
        "largest sets of places": by("service_code").limit(most),
        "largest sets of modifiers": by("billing_code_modifier").limit(most),
        "zero prices": by("rate_unit", "billing_class", rows=prices.filter("is_zero_rate")),
        "anomalies": by("step", "type", rows=anomalies, name="n"),
        "npis that are none": by("npi", rows=odd, name="rows"),
        "capitation": cap.orderBy(F.desc("rows"), "covered_target_codes", F.col("rate_unit").asc_nulls_last()),
        "counts per file": counts.orderBy("file_id"),
    }


def stacked_sections(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, n, cells): every row of every section as text, its place in it and its values in order."""
    out = []
    for title, df in sections.items():
        cells = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
        out.append(df.select(F.lit(title).alias("section"), cells.alias("cells")))
    return reduce(DataFrame.unionByName, out)


def top_per_group(df: DataFrame, group: str, item: str, counted: str, k: int = 10) -> DataFrame:
    """The ``k`` items of each group with most different ``counted``; ties by item."""
    n = df.filter(F.col(item).isNotNull()).groupBy(group, item).agg(F.count_distinct(counted).alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), item)
    return n.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def drift(before: DataFrame, now: DataFrame, key: str, threshold: float = 0.2) -> DataFrame:
    """(key, n_before, n_now, change, breaks): keys whose count moved by more than the threshold, or that are gone."""
    a, b = before.groupBy(key).agg(F.count(F.lit(1)).alias("n_before")), now.groupBy(key).agg(F.count(F.lit(1)).alias("n_now"))
    out = a.join(b, key, "left").withColumn("n_now", F.coalesce("n_now", F.lit(0)))
    change = F.abs(F.col("n_now") - F.col("n_before")) / F.col("n_before")
    return out.withColumn("change", change).withColumn("breaks", (F.col("n_now") == 0) | (change > threshold))


class DriftError(RuntimeError):
    """Counts moved too far since the last snapshot."""


def check_drift(before: DataFrame, now: DataFrame, key: str, threshold: float = 0.2, force: bool = False, wanted: Sequence[str] = ()) -> DataFrame:
    """``drift``, or an error that names the keys that moved too far or are missing (of ``wanted`` ones too), unless forced."""
    moved = drift(before, now, key, threshold)
    broken = [f"{r[key]}: {r.n_before} -> {r.n_now}" for r in moved.filter("breaks").orderBy(key).limit(20).collect()]
    have = {r[0] for r in now.filter(F.col(key).isin(list(wanted))).select(key).distinct().collect()} if wanted else set()
    broken += [f"{k}: none" for k in wanted if k not in have]
    if broken and not force:
        raise DriftError(f"counts moved by more than {threshold:.0%}: {', '.join(broken)}")
    return moved


def registry_log(registry: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(registry rows with the names of their primary code, log of codes that aren't listed and of providers without a clear one)."""
    names = taxonomy.select(F.col("code").alias("primary_taxonomy_code"), "grouping", "classification", "specialization", "display_name")
    joined = registry.join(names.withColumn("listed", F.lit(True)), "primary_taxonomy_code", "left")
    unlisted = joined.filter("primary_taxonomy_code is not null and listed is null").select("npi", F.lit("taxonomy_code_not_listed").alias("type"), F.col("primary_taxonomy_code").alias("detail"))
    unclear = registry.filter("primary_taxonomy_rule = 'ambiguous'").select("npi", F.lit("ambiguous_primary_taxonomy").alias("type"), F.array_join("taxonomy_codes", ",").alias("detail"))
    return joined.drop("listed"), unlisted.unionByName(unclear)


def trace_rows(rates_npi: DataFrame, files: DataFrame, most: int = 20) -> DataFrame:
    """The rows to be traced to their source: of the smallest files first, in order of position; ``files`` has (file_id, size)."""
    order = [F.col("size"), F.col("file_id"), *[F.col(c).asc_nulls_last() for c in "ijkrmnp"]]
    return rates_npi.join(files.select("file_id", "size"), "file_id").orderBy(*order).limit(most)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n): keys that stand more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_no_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, or an error that names a key that stands twice."""
    twice = duplicates(df, keys).take(1)
    if twice:
        raise ValueError(f"duplicate key: {twice[0].asDict()}")
    return df


def zip_points(gazetteer: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(zip5, lat, lon, how): areas of the gazetteer themselves, and ZIPs that the crosswalk leads to one of them."""
    direct = gazetteer.select(F.col("area").alias("zip5"), "lat", "lon", F.lit("direct").alias("how"))
    one = crosswalk.filter("zip is not null and area is not null").groupBy(F.col("zip").alias("zip5")).agg(F.min("area").alias("area"))
    via = one.join(gazetteer, "area").select("zip5", "lat", "lon", F.lit("crosswalk").alias("how"))
    return direct.unionByName(via.join(direct.select("zip5"), "zip5", "left_anti"))


def provider_points(providers: DataFrame, points: DataFrame, first: str = "practice_zip5", second: str = "mailing_zip5") -> DataFrame:
    """Providers with the point of their first ZIP, else of their second."""
    p = lambda n: points.select(F.col("zip5").alias(f"{n}_zip"), F.col("lat").alias(f"{n}_lat"), F.col("lon").alias(f"{n}_lon"), F.col("how").alias(f"{n}_how"))
    out = providers.join(p("a"), F.col(first) == F.col("a_zip"), "left").join(p("b"), F.col(second) == F.col("b_zip"), "left")
    how = F.when(F.col("a_lat").isNotNull(), F.concat(F.lit("first_"), "a_how")).when(F.col("b_lat").isNotNull(), F.concat(F.lit("second_"), "b_how"))
    return out.select(*providers.columns, F.coalesce("a_lat", "b_lat").alias("lat"), F.coalesce("a_lon", "b_lon").alias("lon"), how.alias("point_source"))
