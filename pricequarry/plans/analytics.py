"""The analytic calls: each takes the fact and filters and gives a DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricequarry.functions.scalar import literal_contains
from pricequarry.plans.filters import UNITS, Filters

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
TAGS = {"tag_types", "tag_names"}
PLATFORMS = {"exclude_platforms_from_market"}
PROFILE = {"provider_types", "states", "cities", "zips", "search", "tins", "npis", *TAGS}
MOST_ROWS = 5000

# breakdown or grouping -> key columns; 'network' counts a row once per network, 'tag' is null below the asked confidence
BREAKDOWNS = {"provider_type": "provider_type", "network": "network", "place_of_service": "pos_group", "tag": "tag"}
GROUPINGS = {
    "code": ("billing_code",), "tin_code": ("tin", "billing_code"), "npi_code": ("npi", "billing_code"), "network_code": ("network", "billing_code"),
    "provider_type_code": ("provider_type", "billing_code"), "pos_group_code": ("pos_group", "billing_code"), "tag_code": ("tag", "billing_code"),
}
EXPLORER = (
    "rate_id", "billing_code", "negotiated_rate", "negotiated_type", "rate_unit", "network_text", "service_text", "pos_group", "billing_class", "expiration_date", "npi",
    "provider_name", "provider_type", "tin", "tin_name", "practice_city", "practice_state", "practice_zip5", "scope_flag", "n_sources", "snapshot_date",
)


def prepared(rows: DataFrame, f: Filters, keys: Sequence[str]) -> DataFrame:
    """Adds the columns ``tag`` and, after filtering, ``network`` where the keys ask for them."""
    if "tag" in keys:
        rows = rows.withColumn("tag", f.tag())
    return rows.withColumn("network", F.explode("networks")) if "network" in keys else rows


def unit_values(fact: DataFrame, f: Filters, keys: Sequence[str], ignore: set[str] = frozenset()) -> DataFrame:
    """(keys..., v): one value per counting unit, the median of its rates, or every rate."""
    rows = prepared(f.apply(fact, ignore, market=True), f, keys)
    unit = UNITS[f.counting_unit]
    if unit is None:
        return rows.select(*keys, F.col("negotiated_rate").alias("v"))
    return rows.groupBy(*keys, unit).agg(F.median("negotiated_rate").alias("v")).select(*keys, "v")


def code_summary(fact: DataFrame, f: Filters, breakdown: str | None = None) -> DataFrame:
    """Per code (and breakdown): counts, statistics over counting units, share of percentage rows among all units of price."""
    if breakdown is not None and breakdown not in BREAKDOWNS:
        raise ValueError(f"breakdown: one of {tuple(BREAKDOWNS)}")
    keys = ["billing_code"] + ([BREAKDOWNS[breakdown]] if breakdown else [])
    # one pass for what is counted among the rows kept and among those of all units of price
    kept = f.predicates(market=True).get("dollar_rates_only", F.lit(True))
    every = prepared(f.apply(fact, {"dollar_rates_only"}, market=True).withColumn("kept", kept), f, keys).groupBy(*keys)
    counts = every.agg(
        F.count_distinct(F.when(F.col("kept"), F.col("tin"))).alias("n_tins"), F.count_distinct(F.when(F.col("kept"), F.col("npi"))).alias("n_npis"), F.count_if("kept").alias("n_rows"),
        (F.avg(F.when(F.col("rate_unit") == "percent_of_billed_charges", 1.0).otherwise(0.0)) * 100).alias("pct_percentage_rows"),
    )
    stats = unit_values(fact, f, keys).groupBy(*keys)
    stats = stats.agg(
        F.count(F.lit(1)).alias("n_units"), F.min("v").alias("min_rate"), F.max("v").alias("max_rate"), F.avg("v").alias("mean_rate"),
        F.percentile("v", F.array(*map(F.lit, QUANTILES))).alias("q"),
    )
    out = counts.join(stats, keys)  # a null breakdown has no statistics, hence no row; nor has a group of which no row is kept
    named = [F.col("q")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(QUANTILES)]
    first = ["billing_code"] + ([F.col(keys[1]).alias("breakdown")] if breakdown else [])
    return out.select(*first, "n_tins", "n_npis", "n_rows", "n_units", "min_rate", "max_rate", "mean_rate", *named, "pct_percentage_rows")


def histogram(fact: DataFrame, f: Filters, bins: int = 30) -> DataFrame:
    """(billing_code, bucket, n, low, high) for every code: equal bins between the first and 99th percentile of the units.

    Bucket -1 holds what is lower, ``bins`` what is at the upper edge or above. Where the percentiles coincide, the bins span
    minimum to maximum, or one unit if these coincide too. Empty bins have no row.
    """
    units = unit_values(fact, f, ["billing_code"]).filter("v is not null")
    lo, hi, low, high = F.col("q")[0], F.col("q")[1], F.col("low"), F.col("high")
    edges = units.groupBy("billing_code").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("q"), F.min("v").alias("low"), F.max("v").alias("high"))
    flat = hi <= lo
    edges = edges.select("billing_code", F.when(flat, low).otherwise(lo).alias("lo"), F.when(flat, F.when(high > low, high).otherwise(low + 1)).otherwise(hi).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.greatest(F.floor((F.col("v") - F.col("lo")) / width), F.lit(-1)), F.lit(bins)).cast("int")
    n = units.join(edges, "billing_code").groupBy("billing_code", "lo", "hi", at.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("bucket").between(0, bins - 1)
    return n.select("billing_code", "bucket", "n", F.when(inside, F.col("lo") + F.col("bucket") * width).alias("low"), F.when(inside, F.col("lo") + (F.col("bucket") + 1) * width).alias("high"))


def _of_selected_tags(f: Filters) -> Column:
    real = [t for t in f.tag_types if t != "none"]
    ok = F.lit(True)
    if real:
        ok &= f.tag("tag_type").isin(real)
    return ok & f.tag().isin(list(f.tag_names)) if f.tag_names else ok


def benchmark_markers(fact: DataFrame, f: Filters) -> DataFrame:
    """Median and different rates of each tagged entity per code."""
    rows = f.apply(fact, TAGS | PLATFORMS).withColumn("tag", f.tag()).filter(F.col("tag").isNotNull() & _of_selected_tags(f))
    by = rows.groupBy("billing_code", "tag_type", F.col("tag").alias("tag_name"))
    return by.agg(F.median("negotiated_rate").alias("median_rate"), F.array_sort(F.collect_set("negotiated_rate")).alias("rates"))


def ranked(points: DataFrame, market: DataFrame, by: Sequence[str], x: str, v: str = "v") -> DataFrame:
    """``points`` with n_market, market_median, pct_below and pct_at_or_below of column ``x`` among the market's values.

    Values are reduced to counts of different values first; these and the points are counted through in order, so the work
    grows with the different values and not with points times market. A null ``x`` has no rank; points without a market
    have n_market 0.
    """
    keys = list(by)
    counts = market.filter(F.col(v).isNotNull()).groupBy(*keys, F.col(v).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    asked = points.filter(F.col(x).isNotNull()).select(*keys, F.col(x).alias("_x")).distinct().withColumn("_n", F.lit(0).cast("long"))
    marks = counts.unionByName(asked).groupBy(*keys, "_x").agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy(*keys)
    upto = F.sum("_n").over(w.orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    marks = marks.select(*keys, "_x", "_n", upto.alias("_upto"))
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("n_market"), F.expr("percentile(_x, 0.5, _n)").alias("market_median"))
    out = points.join(total, keys, "left").join(marks.withColumnRenamed("_x", x), [*keys, x], "left")
    share = lambda c: F.try_divide(c * F.lit(100.0), F.col("n_market"))
    return out.select(
        *points.columns, F.coalesce("n_market", F.lit(0)).alias("n_market"), "market_median",
        share(F.col("_upto") - F.col("_n")).alias("pct_below"), share(F.col("_upto")).alias("pct_at_or_below"),
    )


def benchmarks(fact: DataFrame, f: Filters) -> DataFrame:
    """Each tagged entity's different rates with their percentile ranks in the market."""
    market = unit_values(fact, f, ["billing_code"], TAGS)
    rows = f.apply(fact, TAGS | PLATFORMS).withColumn("tag", f.tag()).filter(F.col("tag").isNotNull() & _of_selected_tags(f))
    lines = rows.groupBy("billing_code", "tag_type", F.col("tag").alias("tag_name"), F.col("negotiated_rate").alias("rate"), "network_text", "pos_group", "provider_type")
    lines = lines.agg(F.count_distinct("npi").alias("n_npis"), F.count_distinct("tin").alias("n_tins"), F.count(F.lit(1)).alias("n_rows"))
    return ranked(lines, market, ["billing_code"], "rate")


def page(df: DataFrame, order: Sequence[Column], number: int = 1, size: int = 200) -> DataFrame:
    """A page of the ordered rows; sizes are kept between 1 and 5,000."""
    number, size = max(1, int(number)), max(1, min(int(size), MOST_ROWS))
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def sort_key(name: str, direction: str, allowed: Sequence[str]) -> Column:
    if name not in allowed:
        raise ValueError(f"sort by one of {tuple(allowed)}")
    return F.col(name).desc_nulls_last() if direction.lower() == "desc" else F.col(name).asc_nulls_last()


def rate_explorer(fact: DataFrame, f: Filters, number: int = 1, size: int = 200, sort_by: str = "negotiated_rate", direction: str = "asc") -> DataFrame:
    """A page of rows. Only the sort key, the row's number and what filters read is scanned for all rows; the page's other columns
    are read for the rows of the page."""
    order = [sort_key(sort_by, direction, EXPLORER), F.col("rate_id")]
    ids = page(f.apply(fact).select("rate_id", *([sort_by] if sort_by != "rate_id" else [])), order, number, size)
    return fact.join(F.broadcast(ids.select("rate_id")), "rate_id", "left_semi").select(*EXPLORER, f.tag().alias("tag_name")).orderBy(*order)


def total(fact: DataFrame, f: Filters) -> DataFrame:
    """(n_total): rows of all pages of the explorer."""
    return f.apply(fact).agg(F.count(F.lit(1)).alias("n_total"))


def percentage_rates(numbered: DataFrame, f: Filters, **paging) -> DataFrame:
    """The explorer over shares of billed charges, with two columns to be filled by the reader."""
    share = numbered.filter(F.col("rate_unit") == "percent_of_billed_charges")
    out = rate_explorer(share, f.but(dollar_rates_only=False), **paging)
    return out.withColumn("billed_charge", F.lit(None).cast("double")).withColumn("estimated_dollars", F.lit(None).cast("double"))


def summarize(fact: DataFrame, f: Filters, by: str) -> DataFrame:
    """Counts and rates per group of one of the seven groupings."""
    if by not in GROUPINGS:
        raise ValueError(f"summarize by one of {tuple(GROUPINGS)}")
    keys = list(GROUPINGS[by])
    out = prepared(f.apply(fact), f, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("npi").alias("n_npis"), F.count_distinct("tin").alias("n_tins"), F.avg("negotiated_rate").alias("avg_rate"),
        F.median("negotiated_rate").alias("median_rate"), F.min("negotiated_rate").alias("min_rate"), F.max("negotiated_rate").alias("max_rate"),
    )
    return out


def summary_page(fact: DataFrame, f: Filters, by: str, number: int = 1, size: int = 200, direction: str = "asc") -> DataFrame:
    """A page of a summary, by average rate, then keys."""
    out = summarize(fact, f, by)
    return page(out, [sort_key("avg_rate", direction, ["avg_rate"]), *[F.col(k).asc_nulls_last() for k in GROUPINGS[by]]], number, size)


def map_points(fact: DataFrame, f: Filters, code: str, most: int = MOST_ROWS) -> DataFrame:
    """One row per place: providers, TINs, median rate, its percentile in the market, tags; the largest ``most`` places."""
    fc = f.but(codes=(code,))
    rows = fc.apply(fact).filter("lat is not null").withColumn("tag", f.tag()).withColumn("kind", f.tag("tag_type"))
    pts = rows.groupBy("lat", "lon", F.lit(code).alias("billing_code")).agg(
        F.count_distinct("npi").alias("n_providers"), F.count_distinct("tin").alias("n_tins"), F.median("negotiated_rate").alias("median_rate"),
        F.bool_or(F.col("kind") == "platform").alias("has_platform"), F.bool_or(F.col("kind") == "health_system").alias("has_health_system"),
        F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tag_names"),
    )
    out = ranked(pts, unit_values(fact, fc, ["billing_code"]), ["billing_code"], "median_rate").withColumnRenamed("pct_at_or_below", "market_percentile")
    out = out.drop("n_market", "market_median", "pct_below", "billing_code")
    return out.orderBy(F.desc("n_providers"), "lat", "lon").limit(most)


def marker_radius(points: DataFrame) -> DataFrame:
    """Points with the radius of their marker, from 4 to 16 by the root of their share of the largest one's providers; whether
    the list of points was cut off at its limit is for ``capped`` to say."""
    biggest = F.max("n_providers").over(Window.partitionBy(F.lit(1)))  # of a list of at most MOST_ROWS points
    return points.withColumn("radius", F.round(4 + 12 * F.sqrt(F.col("n_providers") / biggest) + 1e-9, 1))


def capped(points: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(n_points, capped): whether there may be more points than the list has."""
    return points.agg(F.count(F.lit(1)).alias("n_points"), (F.count(F.lit(1)) >= most).alias("capped"))


def outlined(points: DataFrame, pinned: Sequence[str]) -> DataFrame:
    """Points with the pinned tags among theirs, in order; null if there is none."""
    hits = F.array_sort(F.array_intersect(F.split("tag_names", ","), F.array(*[F.lit(t) for t in pinned]).cast("array<string>")))
    return points.withColumn("pinned", F.when(F.size(hits) > 0, F.array_join(hits, ",")))


def unmapped_providers(fact: DataFrame, f: Filters, code: str) -> DataFrame:
    return f.but(codes=(code,)).apply(fact).filter("lat is null").agg(F.count_distinct("npi").alias("n"))


def point_providers(fact: DataFrame, f: Filters, code: str, lat: float, lon: float, most: int = 500) -> DataFrame:
    """The providers at one place."""
    rows = f.but(codes=(code,)).apply(fact).filter((F.col("lat") == lat) & (F.col("lon") == lon))
    out = rows.groupBy("npi").agg(
        F.any_value("provider_name", True).alias("provider_name"), F.any_value("provider_type", True).alias("provider_type"),
        F.array_join(F.array_sort(F.collect_set("tin")), ",").alias("tins"), F.median("negotiated_rate").alias("median_rate"),
    )
    return out.orderBy(F.col("median_rate").asc_nulls_last(), "npi").limit(most)


def rate_type_composition(fact: DataFrame, f: Filters, by_network: bool = True) -> DataFrame:
    keys = ["billing_code", *(["network"] if by_network else []), "negotiated_type", "rate_unit"]
    rows = prepared(f.apply(fact, {"dollar_rates_only"}), f, keys)
    return rows.groupBy(*keys).agg(F.count_distinct("tin").alias("n_tins"), F.count_distinct("npi").alias("n_npis"), F.count(F.lit(1)).alias("n_rows"))


def profile(fact: DataFrame, f: Filters, kind: str, key: str) -> DataFrame:
    """Per code of one NPI or TIN: median, different rates, counts, rank in the market and ratio to its median."""
    mine = f.apply(fact, PROFILE).filter(F.col(kind) == key).groupBy("billing_code").agg(
        F.median("negotiated_rate").alias("rate"), F.array_join(F.transform(F.array_sort(F.collect_set("negotiated_rate")), lambda x: F.format_number(x, 2)), ";").alias("rates"),
        F.count_distinct("npi").alias("n_npis"), F.count(F.lit(1)).alias("n_rows"),
    )
    out = ranked(mine, unit_values(fact, f, ["billing_code"], PROFILE), ["billing_code"], "rate")
    return out.withColumn("rate_ratio", F.try_divide("rate", "market_median"))


def uniform_or_split(fact: DataFrame, f: Filters, tin: str) -> DataFrame:
    """Per code of a TIN whether each network set and place group has one rate."""
    rows = f.apply(fact, PROFILE).filter(F.col("tin") == tin).groupBy("billing_code", "networks", "pos_group")
    n = rows.agg(F.count_distinct("negotiated_rate").alias("n")).groupBy("billing_code")
    return n.agg((F.max("n") == 1).alias("uniform"), F.max("n").alias("max_distinct_rates"))


def type_mix(fact: DataFrame, f: Filters, tin: str) -> DataFrame:
    return f.apply(fact, PROFILE).filter(F.col("tin") == tin).groupBy("provider_type").agg(F.count_distinct("npi").alias("n_npis"))


def entity_list(fact: DataFrame, f: Filters, kind: str) -> DataFrame:
    """Per NPI or TIN: codes, providers and rate index, the mean of its medians over those of the market."""
    market = unit_values(fact, f, ["billing_code"]).groupBy("billing_code").agg(F.median("v").alias("m"))
    per = f.apply(fact).groupBy(kind, "billing_code").agg(F.median("negotiated_rate").alias("rate"), F.count_distinct("npi").alias("n"))
    return per.join(market, "billing_code").groupBy(kind).agg(
        F.count(F.lit(1)).alias("n_codes"), F.max("n").alias("n_npis"), F.avg(F.try_divide("rate", "m")).alias("rate_index")
    )


def suggest(dim: DataFrame, field: str, text: str, most: int = 20) -> DataFrame:
    """Values of a provider or TIN dimension that contain the text."""
    has = lambda *cs: F.coalesce(F.greatest(*[literal_contains(F.col(c), text) for c in cs], F.lit(False)), F.lit(False))
    if field == "city":
        out = dim.filter(has("practice_city")).groupBy(F.col("practice_city").alias("value"), F.col("practice_state").alias("state")).agg(F.count(F.lit(1)).alias("n"))
        return out.orderBy(F.desc("n"), "value", F.col("state").asc_nulls_last()).limit(most)
    if field == "zip":
        out = dim.filter(has("practice_zip5")).groupBy(F.col("practice_zip5").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return out.orderBy(F.desc("n"), "value").limit(most)
    if field == "provider":
        return dim.filter(has("npi", "provider_name")).select(F.col("npi").alias("value"), F.col("provider_name").alias("label"), "provider_type").orderBy("label", "value").limit(most)
    if field == "entity":
        return dim.filter(has("search_text")).select(F.col("tin").alias("value"), F.col("display_name").alias("label"), "n_npis").orderBy(F.desc("n_npis"), "value").limit(most)
    raise ValueError("field: city, zip, provider or entity")


def options(fact: DataFrame, columns: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """(name, value, n): every value that a filter can take, with its rows."""
    one = [F.array(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))) for c in columns]
    many = [_named(c) for c in arrays]
    rows = fact.select(F.explode(F.flatten(F.array_compact(F.array(*one, *many)))).alias("o")).select("o.name", "o.value")
    return rows.filter("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def _named(column: str) -> Column:
    return F.transform(F.array_distinct(column), lambda x: F.struct(F.lit(column).alias("name"), x.cast("string").alias("value")))
