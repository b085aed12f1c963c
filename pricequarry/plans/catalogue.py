"""Registered queries over the project's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricequarry.functions import scalar as X
from pricequarry.plans import analytics as A
from pricequarry.plans import build as B
from pricequarry.plans import extract as E
from pricequarry.plans import index as I
from pricequarry.plans import star as S
from pricequarry.plans.filters import Filters, core_subset
from pricequarry.session import fresh_folder, table
from pricequarry.settings import CODE_TYPE, CODES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
DEFAULT = Filters()
CODE = "90837"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Both engines round, a little off ties, since their last digits differ."""
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in columns})


def r6(expr: str) -> str:
    return f"round({expr} + 1e-9, 6)"


# what the default filters keep, as SQL
PARTS = {
    "billing_classes": "billing_class = 'professional'", "exclude_zero": "not is_zero_rate", "exclude_invalid_npi": "is_valid_npi", "in_state_only": "is_in_state_any",
    "dollar_rates_only": "rate_unit = 'dollars' and negotiated_type in ('negotiated', 'fee schedule')", "exclude_expired": "not is_expired", "expected_scope_only": "scope_flag = 'expected'",
}


def where(*ignore: str, more: str = "true") -> str:
    return " and ".join([f"({v})" for k, v in PARTS.items() if k not in ignore] + [f"({more})"])


TAG = "case when tag_confidence in ('confirmed', 'high') then tag_name end"
QS = "quantile_cont(v, [0.1, 0.25, 0.5, 0.75, 0.9])"
NETWORKS = "(select * exclude (networks), unnest(networks) as network from fact)"
KEY_SQL = {"provider_type": "provider_type", "network": "network", "place_of_service": "pos_group", "tag": TAG}


def summary_sql(breakdown: str | None = None, unit: str = "tin", cond: str | None = None) -> str:
    src = NETWORKS if breakdown == "network" else "fact"
    b = f", {KEY_SQL[breakdown]} as breakdown" if breakdown else ""
    by = "billing_code" + (", breakdown" if breakdown else "")
    cond, shared = cond or where(), where("dollar_rates_only")
    units = f"select billing_code{b}, {unit}, median(negotiated_rate) as v from {src} where {cond} group by all" if unit != "row" else f"select billing_code{b}, negotiated_rate as v from {src} where {cond}"
    return f"""{S.PREFIX},
counts as (select billing_code{b}, count(distinct tin) as n_tins, count(distinct npi) as n_npis, count(*) as n_rows from {src} where {cond} group by {by}),
units as ({units}),
stats as (select {by}, count(*) as n_units, min(v) as min_rate, max(v) as max_rate, avg(v) as mean_rate, {QS} as q from units group by {by}),
share as (select billing_code{b}, avg(case when rate_unit = 'percent_of_billed_charges' then 1.0 else 0.0 end) * 100 as pct from {src} where {shared} group by {by})
select {by}, n_tins, n_npis, n_rows, n_units, min_rate, max_rate, {r6("mean_rate")} as mean_rate, {r6("q[1]")} as p10, {r6("q[2]")} as p25, {r6("q[3]")} as p50, {r6("q[4]")} as p75,
       {r6("q[5]")} as p90, {r6("pct")} as pct_percentage_rows
from counts join stats using ({by}) left join share using ({by})"""


STATS = ("mean_rate", "p10", "p25", "p50", "p75", "p90", "pct_percentage_rows")


def summary(breakdown: str | None = None, f: Filters = DEFAULT):
    return lambda spark, sf: rounded(A.code_summary(S.fact(spark, sf), f, breakdown), *STATS)


query("code_summary", summary_sql())(summary())
for _b in A.BREAKDOWNS:
    query(f"code_summary_by_{_b}", summary_sql(_b))(summary(_b))
for _u in ("npi", "row"):
    query(f"code_summary_unit_{_u}", summary_sql(unit=_u))(summary(f=DEFAULT.but(counting_unit=_u)))

UNITS_SQL = "select billing_code, tin, median(negotiated_rate) as v from fact where {w} group by 1, 2"


@query(
    "histogram",
    f"""{S.PREFIX}, units as ({UNITS_SQL.format(w=where())}),
q as (select billing_code, quantile_cont(v, 0.01) as a, quantile_cont(v, 0.99) as b, min(v) as lo0, max(v) as hi0 from units where v is not null group by 1),
e as (select billing_code, case when b <= a then lo0 else a end as lo, case when b <= a then case when hi0 > lo0 then hi0 else lo0 + 1 end else b end as hi from q),
n as (select billing_code, lo, (hi - lo) / 30 as w, least(greatest(floor((v - lo) / ((hi - lo) / 30)), -1), 30)::int as bucket from units join e using (billing_code) where v is not null)
select billing_code, bucket, count(*) as n, {r6("case when bucket between 0 and 29 then any_value(lo + bucket * w) end")} as low,
       {r6("case when bucket between 0 and 29 then any_value(lo + (bucket + 1) * w) end")} as high from n group by billing_code, bucket""",
)
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.histogram(S.fact(spark, sf), DEFAULT), "low", "high")


@query(
    "benchmark_markers",
    f"""{S.PREFIX} select billing_code, tag_type, {TAG} as tag_name, {r6("median(negotiated_rate)")} as median_rate,
array_to_string(list_transform(list_sort(list(distinct negotiated_rate)), lambda x: format('{{:.2f}}', x)), ';') as rates from fact where {where()} and {TAG} is not null group by 1, 2, 3""",
)
def benchmark_markers(spark: SparkSession, sf: str) -> DataFrame:
    m = A.benchmark_markers(S.fact(spark, sf), DEFAULT)
    return rounded(m.withColumn("rates", F.array_join(F.transform("rates", lambda x: F.format_string("%.2f", x)), ";")), "median_rate")


RANKED = """{prefix}, units as ({units}), med as (select billing_code, count(v) as n_market, median(v) as market_median from units group by 1),
lines as ({lines})
select l.*, coalesce(n_market, 0) as n_market, {mm} as market_median,
       {below} as pct_below, {upto} as pct_at_or_below
from lines l left join med using (billing_code)"""


def ranked_sql(lines: str, x: str, units: str) -> str:
    count = lambda op: r6(f"case when l.{x} is not null then (select count(*) from units u where u.billing_code = l.billing_code and u.v {op} l.{x}) * 100.0 / n_market end")
    return RANKED.format(prefix=S.PREFIX, units=units, lines=lines, mm=r6("market_median"), below=count("<"), upto=count("<="))


@query(
    "benchmarks",
    ranked_sql(
        f"""select billing_code, tag_type, {TAG} as tag_name, negotiated_rate as rate, network_text, pos_group, provider_type, count(distinct npi) as n_npis, count(distinct tin) as n_tins,
count(*) as n_rows from fact where {where()} and {TAG} is not null group by all""", "rate", UNITS_SQL.format(w=where()),
    ),
)
def benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.benchmarks(S.fact(spark, sf), DEFAULT), "market_median", "pct_below", "pct_at_or_below")


PAGE_COLUMNS = ", ".join(A.EXPLORER) + f", {TAG} as tag_name"


@query("rate_explorer_page", f"{S.PREFIX} select {PAGE_COLUMNS} from numbered where {where()} order by negotiated_rate nulls last, rate_id limit 200 offset 200")
def rate_explorer_page(spark: SparkSession, sf: str) -> DataFrame:
    return A.rate_explorer(S.fact(spark, sf), DEFAULT, number=2)


@query("rate_explorer_name_sort", f"{S.PREFIX} select {PAGE_COLUMNS} from numbered where {where()} order by provider_name desc nulls last, rate_id limit 200")
def rate_explorer_name_sort(spark: SparkSession, sf: str) -> DataFrame:
    return A.rate_explorer(S.fact(spark, sf), DEFAULT, sort_by="provider_name", direction="desc")


query("rate_explorer_total", f"{S.PREFIX} select count(*) as n_total from fact where {where()}")(lambda spark, sf: A.total(S.fact(spark, sf), DEFAULT))


@query(
    "percentage_rates",
    f"""{S.PREFIX} select {PAGE_COLUMNS}, null::double as billed_charge, null::double as estimated_dollars from numbered
where {where("dollar_rates_only", more="rate_unit = 'percent_of_billed_charges'")} order by negotiated_rate nulls last, rate_id limit 200""",
)
def percentage_rates(spark: SparkSession, sf: str) -> DataFrame:
    return A.percentage_rates(S.fact(spark, sf), DEFAULT)


GROUP_SQL = {"tag": f"{TAG} as tag"}
for _g, _keys in A.GROUPINGS.items():
    _cols = ", ".join(GROUP_SQL.get(k, k) for k in _keys)
    query(
        f"summarize_{_g}",
        f"""{S.PREFIX} select {_cols}, count(*) as n_rows, count(distinct npi) as n_npis, count(distinct tin) as n_tins, {r6("avg(negotiated_rate)")} as avg_rate,
{r6("median(negotiated_rate)")} as median_rate, min(negotiated_rate) as min_rate, max(negotiated_rate) as max_rate from {NETWORKS if "network" in _keys else "fact"} where {where()} group by {", ".join(_keys)}""",
    )(lambda spark, sf, g=_g: rounded(A.summarize(S.fact(spark, sf), DEFAULT, g), "avg_rate", "median_rate"))


@query(
    "summary_page",
    f"""{S.PREFIX} select npi, billing_code, count(*) as n_rows, count(distinct npi) as n_npis, count(distinct tin) as n_tins, {r6("avg(negotiated_rate)")} as avg_rate,
{r6("median(negotiated_rate)")} as median_rate, min(negotiated_rate) as min_rate, max(negotiated_rate) as max_rate from fact where {where()} group by 1, 2
order by round(avg(negotiated_rate), 6) nulls last, npi, billing_code limit 200""",
)
def summary_page(spark: SparkSession, sf: str) -> DataFrame:
    out = A.summarize(S.fact(spark, sf), DEFAULT, "npi_code")
    ordered = A.page(out, [F.round("avg_rate", 6).asc_nulls_last(), F.col("npi").asc_nulls_last(), F.col("billing_code").asc_nulls_last()])
    return rounded(ordered, "avg_rate", "median_rate")


@query(
    "map_points",
    f"""{S.PREFIX}, units as (select median(negotiated_rate) as v from fact where {where(more=f"billing_code = '{CODE}'")} group by tin), base as (
  select *, {TAG} as tag, {TAG.replace("tag_name", "tag_type")} as kind from fact where {where(more=f"billing_code = '{CODE}'")} and lat is not null),
pts as (select lat, lon, count(distinct npi) as n_providers, count(distinct tin) as n_tins, median(negotiated_rate) as med, bool_or(kind = 'platform') as has_platform,
        bool_or(kind = 'health_system') as has_health_system, coalesce(array_to_string(list_sort(list(distinct tag) filter (where tag is not null)), ','), '') as tag_names from base group by 1, 2)
select lat, lon, n_providers, n_tins, {r6("med")} as median_rate, has_platform, has_health_system, tag_names,
       {r6("(select count(*) from units where v <= med) * 100.0 / (select count(v) from units)")} as market_percentile
from pts order by n_providers desc, lat, lon limit 5000""",
)
def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.map_points(S.fact(spark, sf), DEFAULT, CODE), "median_rate", "market_percentile")


_points = SQL["map_points"]
query("map_markers", f"select lat, lon, round(4 + 12 * sqrt(n_providers / max(n_providers) over ()) + 1e-9, 1) as radius from ({_points})")(
    lambda spark, sf: A.marker_radius(A.map_points(S.fact(spark, sf), DEFAULT, CODE)).select("lat", "lon", "radius")
)
query("map_capped", f"select count(*) as n_points, count(*) >= 25 as capped from (select * from ({_points}) order by n_providers desc, lat, lon limit 25)")(
    lambda spark, sf: A.capped(A.map_points(S.fact(spark, sf), DEFAULT, CODE, 25), 25)
)
query(
    "map_outlined",
    f"""select lat, lon, nullif(array_to_string(list_sort(list_distinct(list_filter(string_split(tag_names, ','), lambda x: x in ('Platform 0', 'System 1')))), ','), '') as pinned from ({_points})""",
)(lambda spark, sf: A.outlined(A.map_points(S.fact(spark, sf), DEFAULT, CODE), ("System 1", "Platform 0")).select("lat", "lon", "pinned"))


@query("unmapped_providers", f"{S.PREFIX} select count(distinct npi) as n from fact where {where(more=f"billing_code = '{CODE}'")} and lat is null")
def unmapped_providers(spark: SparkSession, sf: str) -> DataFrame:
    return A.unmapped_providers(S.fact(spark, sf), DEFAULT, CODE)


@query(
    "point_providers",
    f"""{S.PREFIX} select npi, any_value(provider_name) as provider_name, any_value(provider_type) as provider_type, coalesce(array_to_string(list_sort(list(distinct tin)), ','), '') as tins,
{r6("median(negotiated_rate)")} as median_rate from fact where {where(more=f"billing_code = '{CODE}'")} and lat = 26.0 and lon = -105.875 group by npi order by median(negotiated_rate) nulls last, npi limit 500""",
)
def point_providers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.point_providers(S.fact(spark, sf), DEFAULT, CODE, 26.0, -105.875), "median_rate")


for _name, _net in (("rate_type_composition", ""), ("rate_type_composition_by_network", "network, ")):
    query(
        _name,
        f"""{S.PREFIX} select billing_code, {_net}negotiated_type, rate_unit, count(distinct tin) as n_tins, count(distinct npi) as n_npis, count(*) as n_rows
from {NETWORKS if _net else "fact"} where {where("dollar_rates_only")} group by all""",
    )(lambda spark, sf, n=bool(_net): A.rate_type_composition(S.fact(spark, sf), DEFAULT, n))

# the profile of the NPI and of the TIN with most rows, so that the query means the same at every scale
BUSY = "(select {0} from rates_npi_dedup, snap where snapshot_date = snap.d and {0} is not null group by 1 order by count(*) desc, 1 limit 1)"
PROFILE_WHERE = where()


def busiest(spark: SparkSession, sf: str, column: str) -> str:
    rows = S.latest_snapshot(table(spark, sf, "rates_npi_dedup")).filter(F.col(column).isNotNull())
    return rows.groupBy(column).count().orderBy(F.desc("count"), column).first()[0]


for _kind, _column in (("npi", "npi"), ("tin", "tin_value")):
    _lines = f"""select billing_code, median(negotiated_rate) as rate, array_to_string(list_transform(list_sort(list(distinct negotiated_rate)), lambda x: format('{{:,.2f}}', x)), ';') as rates,
count(distinct npi) as n_npis, count(*) as n_rows from fact where {PROFILE_WHERE} and {_kind} = {BUSY.format(_column)} group by 1"""
    query(
        f"{_kind}_profile",
        f"select * replace ({r6('rate')} as rate), {r6('rate / nullif(market_median, 0)')} as rate_ratio from ({ranked_sql(_lines, 'rate', UNITS_SQL.format(w=PROFILE_WHERE))})",
    )(
        lambda spark, sf, k=_kind, c=_column: rounded(
            A.profile(S.fact(spark, sf), DEFAULT, k, busiest(spark, sf, c)), "rate", "market_median", "pct_below", "pct_at_or_below", "rate_ratio"
        )
    )


@query(
    "tin_uniform_split",
    f"""{S.PREFIX} select billing_code, max(n) = 1 as uniform, max(n) as max_distinct_rates from (select billing_code, networks, pos_group, count(distinct negotiated_rate) as n from fact
where {PROFILE_WHERE} and tin = {BUSY.format("tin_value")} group by 1, 2, 3) group by 1""",
)
def tin_uniform_split(spark: SparkSession, sf: str) -> DataFrame:
    return A.uniform_or_split(S.fact(spark, sf), DEFAULT, busiest(spark, sf, "tin_value"))


@query("tin_type_mix", f"{S.PREFIX} select provider_type, count(distinct npi) as n_npis from fact where {PROFILE_WHERE} and tin = {BUSY.format('tin_value')} group by 1")
def tin_type_mix(spark: SparkSession, sf: str) -> DataFrame:
    return A.type_mix(S.fact(spark, sf), DEFAULT, busiest(spark, sf, "tin_value"))


for _name, _kind in (("provider_list", "npi"), ("entity_list", "tin")):
    query(
        _name,
        f"""{S.PREFIX}, med as (select billing_code, median(v) as m from ({UNITS_SQL.format(w=where())}) group by 1),
per as (select {_kind}, billing_code, median(negotiated_rate) as rate, count(distinct npi) as n from fact where {where()} group by 1, 2)
select {_kind}, count(*) as n_codes, max(n) as n_npis, {r6("avg(rate / nullif(m, 0))")} as rate_index from per join med using (billing_code) group by 1""",
    )(lambda spark, sf, k=_kind: rounded(A.entity_list(S.fact(spark, sf), DEFAULT, k), "rate_index"))

query("suggest_city", f"{S.PREFIX} select practice_city as value, practice_state as state, count(*) as n from providers where contains(upper(practice_city), 'EL') group by 1, 2 order by n desc, 1, 2 nulls last limit 20")(
    lambda spark, sf: A.suggest(S.providers(spark, sf), "city", " el ")
)
query("suggest_zip", f"{S.PREFIX} select practice_zip5 as value, count(*) as n from providers where contains(practice_zip5, '78') group by 1 order by n desc, 1 limit 20")(
    lambda spark, sf: A.suggest(S.providers(spark, sf), "zip", "78")
)
query(
    "suggest_provider",
    f"{S.PREFIX} select npi as value, provider_name as label, provider_type from providers where contains(npi, 'SU') or contains(upper(provider_name), 'SU') order by 2 nulls first, 1 limit 20",
)(lambda spark, sf: A.suggest(S.providers(spark, sf), "provider", "su"))
query("suggest_entity", f"{S.PREFIX} select tin as value, display_name as label, n_npis from tins where contains(search_text, 'HEALTH') order by n_npis desc, tin limit 20")(
    lambda spark, sf: A.suggest(S.tins(spark, sf), "entity", "health")
)
_options = (
    "billing_code", "provider_type", "practice_state", "practice_city", "practice_zip5", "pos_group", "billing_class", "negotiated_type", "scope_flag", "snapshot_date", "tag_type", "tag_name",
    "tag_confidence",
)
query(
    "filter_options",
    S.PREFIX + " " + " union all ".join(f"select '{c}' as name, {c}::varchar as value, count(*) as n from fact where {c} is not null group by 2" for c in _options)
    + " union all select 'networks', v, count(*) from (select unnest(list_distinct(networks)) as v from fact) where v is not null group by 2"
    + " union all select 'service_code', v, count(*) from (select unnest(list_distinct(service_code)) as v from fact) where v is not null group by 2",
)(lambda spark, sf: A.options(S.fact(spark, sf), _options, ("networks", "service_code")))

COUNT = "select count(*) as n_rows, count(distinct tin) as n_tins, count(distinct npi) as n_npis from fact where "


def counted(f: Filters):
    return lambda spark, sf: f.apply(S.fact(spark, sf), market=True).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("tin").alias("n_tins"), F.count_distinct("npi").alias("n_npis"))


for _name, _f, _cond in (
    ("filter_search", DEFAULT.but(search="health"), where(more="contains(upper(npi), 'HEALTH') or contains(upper(tin), 'HEALTH') or contains(upper(provider_name), 'HEALTH') or contains(tin_search, 'HEALTH')")),
    ("filter_networks", DEFAULT.but(networks=("Juniper Value", "Cedar Select")), where(more="list_has_any(networks, ['Juniper Value', 'Cedar Select'])")),
    ("filter_places", DEFAULT.but(places_of_service=("11", "53")), where(more="list_has_any(service_code, ['11', '53'])")),
    ("filter_tag_none", DEFAULT.but(tag_types=("none", "platform")), where(more=f"({TAG}) is null or (case when tag_confidence in ('confirmed', 'high') then tag_type end) = 'platform'")),
    ("filter_tag_names", DEFAULT.but(tag_names=("System 0", "Platform 1"), min_tag_confidence="medium"), where(more="tag_name in ('System 0', 'Platform 1')")),
    ("filter_no_platforms", DEFAULT.but(exclude_platforms_from_market=True), where(more="(case when tag_confidence in ('confirmed', 'high') then tag_type end) is distinct from 'platform'")),
    ("filter_multi", DEFAULT.but(codes=("90837", "90834"), states=("TX",), provider_types=("Therapist", "Physician")), where(more="billing_code in ('90837', '90834') and practice_state = 'TX' and provider_type in ('Therapist', 'Physician')")),
    ("filter_toggles_off", Filters(billing_classes=(), exclude_zero=False, exclude_invalid_npi=False, in_state_only=False, dollar_rates_only=False, exclude_expired=False, expected_scope_only=False), "true"),
):
    query(_name, f"{S.PREFIX} {COUNT}{_cond}")(counted(_f))


@query("rates_core", f"{S.PREFIX} select billing_code, rate_unit, count(*) as n, count(distinct npi) as n_npis from fact where {where('dollar_rates_only')} group by 1, 2")
def rates_core(spark: SparkSession, sf: str) -> DataFrame:
    return core_subset(S.fact(spark, sf)).groupBy("billing_code", "rate_unit").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("npi").alias("n_npis"))


@query("code_summary_from_core", summary_sql())
def code_summary_from_core(spark: SparkSession, sf: str) -> DataFrame:
    assert DEFAULT.within_core() and DEFAULT.within_core({"dollar_rates_only"})
    return rounded(A.code_summary(core_subset(S.fact(spark, sf)), DEFAULT), *STATS)


@query("rates_fact_numbered", f"{S.PREFIX} select min(rate_id) as lo, max(rate_id) as hi, count(*) as n, count(distinct rate_id) as n_ids, billing_code from numbered group by billing_code")
def rates_fact_numbered(spark: SparkSession, sf: str) -> DataFrame:
    n = S.fact(spark, sf).groupBy("billing_code")
    return n.agg(F.min("rate_id").alias("lo"), F.max("rate_id").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_distinct("rate_id").alias("n_ids"))


@query("site_built", f"{S.PREFIX} select 'fact' as name, count(*) as n from fact union all select 'providers', count(*) from providers union all select 'tins', count(*) from tins")
def site_built(spark: SparkSession, sf: str) -> DataFrame:
    """A site built and stored from the start, and the rows of its tables."""
    folder = fresh_folder(spark, "site")
    S.write_site(spark, sf, folder)
    return B.stacked([S.stored(spark, folder, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in ("fact", "providers", "tins")])


@query("pos_sets", f"{S.PREFIX} select row_number() over (order by codes nulls last) as pos_set_id, codes from (select distinct array_to_string(list_sort(service_code), ',') as codes from fact)")
def pos_sets(spark: SparkSession, sf: str) -> DataFrame:
    return S.pos_sets(spark, sf).withColumn("codes", F.array_join("codes", ","))


@query(
    "pos_set_join",
    f"""{S.PREFIX}, sets as (select row_number() over (order by array_to_string(codes, ',') nulls last) as pos_set_id, codes from (select distinct list_sort(service_code) as codes from fact))
select pos_set_id, count(*) as n from fact left join sets on list_sort(service_code) is not distinct from codes group by 1""",
)
def pos_set_join(spark: SparkSession, sf: str) -> DataFrame:
    f, s = S.fact(spark, sf), S.pos_sets(spark, sf)
    return f.join(s, F.array_sort("service_code").eqNullSafe(F.col("codes")), "left").groupBy("pos_set_id").agg(F.count(F.lit(1)).alias("n"))


@query("providers_dim", f"{S.PREFIX} select npi, provider_name, provider_type, coalesce(primary_taxonomy_code[1:2] in ('9C', '9D'), false) as is_prescriber, practice_zip5, {r6('lat')} as lat, {r6('lon')} as lon from providers")
def providers_dim(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.providers(spark, sf).select("npi", "provider_name", "provider_type", "is_prescriber", "practice_zip5", "lat", "lon"), "lat", "lon")


@query("tins_names", f"{S.PREFIX} select tin, display_name, array_to_string(names, ' | ') as names, n_npis, tag_type, tag_name, tag_confidence from tins")
def tins_names(spark: SparkSession, sf: str) -> DataFrame:
    return S.tins(spark, sf).select("tin", "display_name", F.array_join("names", " | ").alias("names"), "n_npis", "tag_type", "tag_name", "tag_confidence")


# ---- building the tables -------------------------------------------------------------------------------------------------

FILES = "files as (select distinct file_id, file_name, is_in_state_file, file_sha256, file_last_updated_on from rates_npi)"


@query(
    "npi_grain_join",
    f"""with {FILES} select r.billing_code, f.is_in_state_file, coalesce(regexp_full_match(g.npi, '[0-9]{{10}}'), false) as is_valid_npi, count(*) as n_rows, count(distinct g.npi) as n_npis,
count(distinct (r.file_id, r.i, r.j, r.k, r.r)) as n_rates from rates r join provider_groups g using (file_id, provider_group_id) left join files f on f.file_id = r.file_id group by 1, 2, 3""",
)
def npi_grain_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.npi_grain(table(spark, sf, "rates"), table(spark, sf, "provider_groups"), B.files_of(table(spark, sf, "rates_npi")))
    grain = F.count_distinct(F.struct("file_id", "i", "j", "k", "r"))
    return rows.groupBy("billing_code", "is_in_state_file", "is_valid_npi").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("npi").alias("n_npis"), grain.alias("n_rates"))


SAME_SQL = ", ".join(B.SAME)
LISTS_SQL = ", ".join(f"list_sort({c})" for c in B.SAME_LISTS)


@query(
    "dedup_rates",
    f"""select {SAME_SQL}, array_to_string(list_sort(service_code), ',') as service_code, array_to_string(list_sort(billing_code_modifier), ',') as billing_code_modifier,
any_value(negotiated_rate) as negotiated_rate, array_to_string(list_sort(list_distinct(flatten(list(network_name) filter (where network_name is not null)))), ',') as networks,
bool_or(is_in_state_file) as is_in_state_any, bool_and(is_in_state_file) as is_in_state_all, count(*) as n_sources from rates_npi group by {SAME_SQL}, {LISTS_SQL}, service_code is null, billing_code_modifier is null
""".replace(", service_code is null, billing_code_modifier is null", "").replace("array_to_string(list_sort(service_code), ',')", "array_to_string(any_value(list_sort(service_code)), ',')").replace("array_to_string(list_sort(billing_code_modifier), ',')", "array_to_string(any_value(list_sort(billing_code_modifier)), ',')"),
)
def dedup_rates(spark: SparkSession, sf: str) -> DataFrame:
    d = B.deduplicated(table(spark, sf, "rates_npi"))
    return d.withColumns({c: F.array_join(c, ",") for c in (*B.SAME_LISTS, "networks")})


@query(
    "dedup_lineage",
    f"""with keyed as (select dense_rank() over (order by {SAME_SQL}, {LISTS_SQL}) as key, file_id, i, j, k, r, m, n, p from rates_npi),
per as (select key, count(*) as n_sources, count(distinct file_id) as n_files, min(i) as low_i, max(p) as high_p from keyed group by 1)
select n_sources, n_files, low_i, high_p, count(*) as n from per group by all""",
)
def dedup_lineage(spark: SparkSession, sf: str) -> DataFrame:
    per = B.lineage(table(spark, sf, "rates_npi")).groupBy("rate_key")
    per = per.agg(F.count(F.lit(1)).alias("n_sources"), F.count_distinct("file_id").alias("n_files"), F.min("i").alias("low_i"), F.max("p").alias("high_p"))
    return per.groupBy("n_sources", "n_files", "low_i", "high_p").agg(F.count(F.lit(1)).alias("n"))


@query("undefined_groups", "select file_id, provider_group_id, count(*) as n_rows from rates r anti join provider_groups g using (file_id, provider_group_id) group by 1, 2")
def undefined_groups(spark: SparkSession, sf: str) -> DataFrame:
    return B.undefined_groups(table(spark, sf, "rates"), table(spark, sf, "provider_groups"))


@query("referenced_groups", "select file_id, count(*) as n_rows, count(distinct provider_group_id) as n_groups from provider_groups semi join rates using (file_id, provider_group_id) group by 1")
def referenced_groups(spark: SparkSession, sf: str) -> DataFrame:
    g = B.referenced_groups(table(spark, sf, "provider_groups"), table(spark, sf, "rates"))
    return g.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("provider_group_id").alias("n_groups"))


@query(
    "named_groups",
    """select g.file_id, g.m, g.n, g.p, g.npi, g.tin_value, a.provider_name as npi_name, a.practice_state, case when g.tin_type = 'npi' then b.provider_name end as tin_npi_name
from provider_groups g left join nppes a on a.npi = g.npi left join nppes b on b.npi = g.tin_value""",
)
def named_groups(spark: SparkSession, sf: str) -> DataFrame:
    return B.named(table(spark, sf, "provider_groups"), table(spark, sf, "nppes")).select("file_id", "m", "n", "p", "npi", "tin_value", "npi_name", "practice_state", "tin_npi_name")


@query(
    "union_by_name",
    """select step, type, file_id, billing_code, count(*) as n from (
select step, type, file_id, null as billing_code from anomalies union all by name select file_id, billing_code from rates) group by all""",
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    both = B.stacked([table(spark, sf, "anomalies").select("step", "type", "file_id"), table(spark, sf, "rates").select("file_id", "billing_code")])
    return both.groupBy("step", "type", "file_id", "billing_code").agg(F.count(F.lit(1)).alias("n"))


for _name, _by in (("price_grain_profile", "billing_code"), ("price_type_profile", "negotiated_type"), ("price_class_profile", "billing_class")):
    query(
        _name,
        f"""select {_by}, count(*) as n_prices, count_if(is_zero_rate) as n_zero, count(distinct file_id) as n_files from (select distinct file_id, i, j, k, {_by}, is_zero_rate, negotiated_rate from rates) group by 1""",
    )(lambda spark, sf, by=_by: B.price_grain(table(spark, sf, "rates"), [by]))

query("anomaly_profile", "select step, type, count(*) as n, count(distinct file_id) as n_files from anomalies group by 1, 2")(
    lambda spark, sf: table(spark, sf, "anomalies").groupBy("step", "type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_id").alias("n_files"))
)
query("file_rows", f"with {FILES} select file_id, file_name, is_in_state_file, count(*) as n_rows, count(distinct npi) as n_npis from rates_npi join files using (file_id, file_name, is_in_state_file) group by 1, 2, 3")(
    lambda spark, sf: table(spark, sf, "rates_npi").groupBy("file_id", "file_name", "is_in_state_file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("npi").alias("n_npis"))
)
query(
    "registry_ids",
    "select distinct npi from (select npi from rates_npi where regexp_full_match(npi, '[0-9]{10}') union select tin_value from rates_npi where tin_type = 'npi' and regexp_full_match(tin_value, '[0-9]{10}')) except select npi from nppes",
)(
    lambda spark, sf: (lambda r: r.select("npi").filter(X.valid_npi(F.col("npi"))).union(r.filter("tin_type = 'npi'").select("tin_value").filter(X.valid_npi(F.col("tin_value")))).distinct())(table(spark, sf, "rates_npi"))
    .subtract(table(spark, sf, "nppes").select("npi"))
)

# ---- quality --------------------------------------------------------------------------------------------------------------

CONFLICTS = """conflicts as (select billing_code, tin, npi, network, billing_class, service_text, negotiated_type, count(distinct negotiated_rate_raw) as n_prices,
array_to_string(list_sort(list(distinct negotiated_rate_raw)), ';') as prices from (select *, unnest(networks) as network from fact) group by 1, 2, 3, 4, 5, 6, 7 having count(distinct negotiated_rate_raw) > 1)"""
query("dq_conflicts", f"{S.PREFIX}, {CONFLICTS} select * from conflicts")(lambda spark, sf: B.conflicts(S.fact(spark, sf)))
query(
    "dq_conflict_rows",
    f"""{S.PREFIX}, {CONFLICTS} select billing_code, count(*) as n, count(distinct npi) as n_npis from fact f where exists (select 1 from conflicts c where f.billing_code is not distinct from c.billing_code
and f.tin is not distinct from c.tin and f.npi is not distinct from c.npi and f.billing_class is not distinct from c.billing_class and f.service_text is not distinct from c.service_text
and f.negotiated_type is not distinct from c.negotiated_type and list_contains(f.networks, c.network)) group by 1""",
)(lambda spark, sf: B.conflict_rows(S.fact(spark, sf)).groupBy("billing_code").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("npi").alias("n_npis")))
_tests = {
    "rates": "true", "zero_rate": "is_zero_rate", "null_rate": "negotiated_rate is null", "invalid_npi": "not is_valid_npi", "expired": "is_expired", "not_registered": "scope_flag = 'not_registered'",
    "not_registered_valid_npi": "scope_flag = 'not_registered' and is_valid_npi", **{f"scope_{x}": f"scope_flag = '{x}'" for x in B.SCOPES},
    "percentage": "rate_unit = 'percent_of_billed_charges'", "unknown_unit": "rate_unit = 'unknown'", "no_network": "networks is null", "many_sources": "n_sources > 1",
}
query(
    "dq_stats",
    f"{S.PREFIX}, {CONFLICTS}, dd as (select 1 from rates_npi group by {SAME_SQL}, {LISTS_SQL}) " + " union all ".join(f"select '{m}' as metric, count_if({c}) as n from fact" for m, c in _tests.items())
    + " union all select 'npis_not_registered', count(distinct npi) from fact where scope_flag = 'not_registered' and is_valid_npi"
    + " union all select 'rows_before_dedup', count(*) from rates_npi union all select 'rows_removed_by_dedup', (select count(*) from rates_npi) - (select count(*) from dd)"
    + " union all select 'conflicting_keys', count(*) from conflicts union all select concat_ws(':', 'anomaly', step, type), count(*) from anomalies group by 1",
)(lambda spark, sf: B.quality_stats(S.fact(spark, sf), table(spark, sf, "anomalies"), table(spark, sf, "rates_npi")).groupBy("metric").agg(F.sum("n").alias("n")))
_conflict_order = "n_prices desc, npi nulls last, billing_code nulls last, tin nulls last, network nulls last, billing_class nulls last, service_text nulls last, negotiated_type nulls last"
query("dq_conflict_page", f"{S.PREFIX}, {CONFLICTS} select * from conflicts order by {_conflict_order} limit 500")(lambda spark, sf: B.conflict_page(B.conflicts(S.fact(spark, sf))))
query("dq_scope_by_code", f"{S.PREFIX} select billing_code, scope_flag, count(*) as n from fact where billing_class = 'professional' and rate_unit = 'dollars' group by 1, 2")(
    lambda spark, sf: S.fact(spark, sf).filter("billing_class = 'professional' and rate_unit = 'dollars'").groupBy("billing_code", "scope_flag").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "dq_top_cities",
    f"""{S.PREFIX}, n as (select scope_flag, practice_city, count(distinct npi) as n from fact where practice_city is not null group by 1, 2)
select * from (select *, row_number() over (partition by scope_flag order by n desc, practice_city) as place from n) where place <= 10""",
)(lambda spark, sf: B.top_per_group(S.fact(spark, sf), "scope_flag", "practice_city", "npi"))
query(
    "drift_forced",
    """with d as (select distinct snapshot_date from rates_npi_dedup order by 1 desc limit 2) select billing_code, count(*) as n_before from rates_npi_dedup where snapshot_date = (select min(snapshot_date) from d) group by 1""",
)(lambda spark, sf: _checked(spark, sf))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    """With a limit of nothing the check ends in an error, unless it is forced."""
    rows = table(spark, sf, "rates_npi_dedup")
    last = rows.agg(F.max("snapshot_date")).scalar()
    before, now = S.latest_snapshot(rows.filter(F.col("snapshot_date") < last)), rows.filter(F.col("snapshot_date") == last)
    return B.check_drift(before, now, "billing_code", threshold=0.0, force=True, wanted=("no such code",)).select("billing_code", "n_before")


query(
    "drift_check",
    f"""with d as (select distinct snapshot_date from rates_npi_dedup order by 1 desc limit 2), b as (select billing_code, count(*) as n_before from rates_npi_dedup where snapshot_date = (select min(snapshot_date) from d) group by 1),
a as (select billing_code, count(*) as n_now from rates_npi_dedup where snapshot_date = (select max(snapshot_date) from d) group by 1)
select billing_code, n_before, coalesce(n_now, 0) as n_now, {r6("abs(coalesce(n_now, 0) - n_before) / n_before")} as change, coalesce(n_now, 0) = 0 or abs(coalesce(n_now, 0) - n_before) / n_before > 0.05 as breaks
from b left join a using (billing_code)""",
)(lambda spark, sf: _drift(spark, sf))


def _drift(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "rates_npi_dedup")
    last = rows.agg(F.max("snapshot_date")).scalar()
    before = rows.filter(F.col("snapshot_date") < last)
    return rounded(B.drift(S.latest_snapshot(before), rows.filter(F.col("snapshot_date") == last), "billing_code", 0.05), "change")


for _kind, _cond in (("zero_rate", "is_zero_rate"), ("invalid_npi", "not is_valid_npi"), ("expired", "is_expired"), ("not_registered", "scope_flag = 'not_registered' and is_valid_npi")):
    query(f"dq_rows_{_kind}", f"{S.PREFIX} select billing_code, npi, tin, negotiated_rate_raw, count(*) as n from fact where {_cond} group by all")(
        lambda spark, sf, c=_cond: S.fact(spark, sf).filter(c).groupBy("billing_code", "npi", "tin", "negotiated_rate_raw").agg(F.count(F.lit(1)).alias("n"))
    )

# ---- lineage --------------------------------------------------------------------------------------------------------------

query(
    "source_paths",
    """select file_id, format('in_network[{}].negotiated_rates[{}].negotiated_prices[{}]', i, j, k) as price_path,
case when m is not null then format('provider_references[{}].provider_groups[{}].npi[{}]', m, n, p) end as npi_path, count(*) as n from rates_npi group by 1, 2, 3""",
)(lambda spark, sf: table(spark, sf, "rates_npi").groupBy("file_id", X.price_path().alias("price_path"), X.npi_path().alias("npi_path")).agg(F.count(F.lit(1)).alias("n")))
query("primary_taxonomy", "select npi, primary_taxonomy_code as code, primary_taxonomy_rule as rule from nppes")(lambda spark, sf: _primary(spark, sf))


def _primary(spark: SparkSession, sf: str) -> DataFrame:
    """The rule over the registry's codes and switches; the switches, which the table doesn't keep, follow from what it says of them."""
    on = lambda c: F.when((F.col("primary_taxonomy_rule") == "switch_Y") & (c == F.col("primary_taxonomy_code")), "Y").otherwise("N")
    rows = table(spark, sf, "nppes").select("npi", X.primary_code(F.col("taxonomy_codes"), F.transform("taxonomy_codes", on)).alias("x"))
    return rows.select("npi", "x.code", "x.rule")


query(
    "display_names",
    "select npi, nullif(case when entity_type_code = '2' then org_name else concat_ws(' ', nullif(trim(first_name), ''), nullif(trim(middle_name), ''), nullif(trim(last_name), '')) end, '') as name from nppes",
)(lambda spark, sf: table(spark, sf, "nppes").select("npi", X.display_name(F.col("entity_type_code"), F.col("org_name"), F.col("first_name"), F.col("middle_name"), F.col("last_name")).alias("name")))
query(
    "rate_units",
    """select negotiated_type, case negotiated_type when 'negotiated' then 'dollars' when 'derived' then 'dollars' when 'fee schedule' then 'dollars' when 'percentage' then 'percent_of_billed_charges'
when 'per diem' then 'dollars_per_day' else 'unknown' end as unit, count(*) as n from rates group by 1""",
)(lambda spark, sf: table(spark, sf, "rates").groupBy("negotiated_type", X.rate_unit(F.col("negotiated_type")).alias("unit")).agg(F.count(F.lit(1)).alias("n")))
query(
    "file_identity",
    """select split_part(u, '?', 1) as file_key, left(sha1(split_part(u, '?', 1)), 12) as file_id, regexp_extract(split_part(u, '?', 1), '([^/]*)$', 1) as name, 'files.example.org' as host
from (select distinct 'https://files.example.org/a/' || file_name || '?signed=1' as u from rates_npi)""",
)(
    lambda spark, sf: table(spark, sf, "rates_npi").select(F.concat(F.lit("https://files.example.org/a/"), "file_name", F.lit("?signed=1")).alias("u")).distinct()
    .select(X.file_key(F.col("u")).alias("file_key"), X.file_id(F.col("u")).alias("file_id"), X.base_name(F.col("u")).alias("name"), X.host(F.col("u")).alias("host"))
)
query(
    "percentile_bands",
    f"select *, case when pct_below is null then null when pct_below < 20 then 0 when pct_below < 40 then 1 when pct_below < 60 then 2 when pct_below < 80 then 3 when pct_below < 95 then 4 else 5 end as band from ({SQL['npi_profile']})",
)(lambda spark, sf: QUERIES["npi_profile"](spark, sf).withColumn("band", X.percentile_band(F.col("pct_below"))))

BUSY_NPI = "(select npi from rates_npi_dedup where snapshot_date = (select max(snapshot_date) from rates_npi_dedup) and npi is not null group by 1 order by count(*) desc, 1 limit 1)"


@query(
    "source_rows",
    f"""with {FILES} select s.file_id, f.file_name, f.file_sha256, s.billing_code, s.negotiated_rate_raw, format('in_network[{{}}].negotiated_rates[{{}}].negotiated_prices[{{}}]', s.i, s.j, s.k) as price_path,
case when s.m is not null then format('provider_references[{{}}].provider_groups[{{}}].npi[{{}}]', s.m, s.n, s.p) end as npi_path from rates_npi s left join files f on f.file_id = s.file_id where s.npi = {BUSY_NPI}""",
)
def source_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every source of the rates of the NPI with most rates."""
    rows = table(spark, sf, "rates_npi")
    mine = rows.filter(F.col("npi") == busiest(spark, sf, "npi")).drop("file_name", "file_sha256")
    files = B.files_of(rows).select("file_id", "file_name", "file_sha256")
    return mine.join(files, "file_id", "left").select("file_id", "file_name", "file_sha256", "billing_code", "negotiated_rate_raw", X.price_path().alias("price_path"), X.npi_path().alias("npi_path"))


_TABLES = ("rates", "provider_groups", "rates_npi", "rates_npi_dedup", "nppes", "anomalies", "in_network", "provider_references")
query("table_counts", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in _TABLES))(
    lambda spark, sf: B.stacked([table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in _TABLES])
)
query(
    "files_dim",
    f"""with {FILES}, nets as (select file_id, array_to_string(list_sort(list(distinct v)), ',') as networks from (select file_id, unnest(network_name) as v from rates_npi) where v is not null group by 1)
select file_id, file_name, is_in_state_file, file_last_updated_on, networks from files left join nets using (file_id)""",
)(lambda spark, sf: _files_dim(spark, sf))


def _files_dim(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "rates_npi")
    nets = rows.select("file_id", F.explode("network_name").alias("v")).filter("v is not null").groupBy("file_id").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("networks"))
    return B.files_of(rows).join(nets, "file_id", "left").select("file_id", "file_name", "is_in_state_file", "file_last_updated_on", "networks")


query(
    "flat_export",
    """select r.file_id, r.i, r.j, r.k, r.r, r.billing_code, r.negotiated_rate_raw, array_to_string(r.service_code, '|') as service_code, array_to_string(r.billing_code_modifier, '|') as billing_code_modifier, g.npi, g.tin_type, g.tin_value
from rates r left join provider_groups g using (file_id, provider_group_id)""",
)(
    lambda spark, sf: I.flat_export(table(spark, sf, "rates"), table(spark, sf, "provider_groups"))
    .select("file_id", "i", "j", "k", "r", "billing_code", "negotiated_rate_raw", "service_code", "billing_code_modifier", "npi", "tin_type", "tin_value")
)

# ---- extraction -----------------------------------------------------------------------------------------------------------

_obj, _list = "json_type({0}) = 'OBJECT'", "case coalesce(json_type({0}), 'NULL') when 'ARRAY' then json_extract({0}, '$[*]') when 'NULL' then [] else [{0}] end"
_n = "case coalesce(json_type({0}), 'NULL') when 'ARRAY' then range(json_array_length({0})::bigint) when 'NULL' then [] else [0] end"
RATES_JSON = f"""items as (select row_number() over () as rid, file_id, i, negotiated_rates::json as v from in_network where json_valid(negotiated_rates) and coalesce(negotiation_arrangement, '') <> 'capitation'),
rate as (select * from (select rid, file_id, i, unnest({_list.format("v")}) as x, unnest({_n.format("v")}) as j from items) where {_obj.format("x")}),
price as (select * from (select rid, file_id, i, j, unnest({_list.format("x->'$.negotiated_prices'")}) as y, unnest({_n.format("x->'$.negotiated_prices'")}) as k from rate) where {_obj.format("y")}),
refs as (select rid, file_id, i, j, unnest({_list.format("x->'$.provider_references'")}) as g, unnest({_n.format("x->'$.provider_references'")}) as r from rate),
inl as (select * from (select rid, file_id, i, j, unnest({_list.format("x->'$.provider_groups'")}) as g, unnest({_n.format("x->'$.provider_groups'")}) as n from rate) where {_obj.format("g")}),
grp as (select rid, file_id, i, j, r, g->>'$' as gid from refs union all select rid, file_id, i, j, null, format('inline:{{}}:{{}}:{{}}', i, j, n) from inl)"""
query(
    "extract_rates",
    f"""with {RATES_JSON} select p.file_id, p.i, p.j, p.k, r, gid as provider_group_id, y->>'$.negotiated_type' as negotiated_type, y->>'$.negotiated_rate' as negotiated_rate_raw,
case when json_type(y->'$.negotiated_rate') in ('DOUBLE', 'UBIGINT', 'BIGINT') then try_cast(y->>'$.negotiated_rate' as double) end as negotiated_rate, count(*) as n from price p join grp g on p.rid = g.rid and p.j = g.j group by all""",
)(
    lambda spark, sf: E.rate_rows(table(spark, sf, "in_network")).groupBy("file_id", "i", "j", "k", "r", "provider_group_id", "negotiated_type", "negotiated_rate_raw", "negotiated_rate").agg(F.count(F.lit(1)).alias("n"))
)
_CODES_SQL = "('90837', '90834', '90832')"
_told = "case coalesce(json_type({0}), 'NULL') when 'NULL' then '' when 'OBJECT' then 'object' when 'ARRAY' then 'array' else {0}->>'$' end"
_shape = "case coalesce(json_type({0}), 'NULL') when 'NULL' then 'null' when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'BOOLEAN' then 'boolean' when 'VARCHAR' then 'text' else 'number' end"
_scalar_or_null = "coalesce(json_type({0}), 'NULL') not in ('ARRAY', 'NULL')"
_none = "(json_type({0}) is null or json_type({0}) = 'NULL' or (json_type({0}) = 'ARRAY' and json_array_length({0}) = 0))"


def _unknown(rows: str, obj: str, at: str, level: str) -> str:
    known = ", ".join(f"'{k}'" for k in E.KNOWN[level])
    return f"select file_id, 'unknown_key', key, {at} || '.' || key, '' from (select *, unnest(json_keys({obj})) as key from {rows} where {_obj.format(obj)}) where key not in ({known})"


ODD_SQL = f"""item as (select row_number() over () as rid, file_id, i, negotiated_rates::json as v from in_network where json_valid(negotiated_rates)),
el as (select *, format('in_network[{{}}].negotiated_rates[{{}}]', i, j) as pos from (select rid, file_id, i, unnest({_list.format("v")}) as x, unnest({_n.format("v")}) as j from item)),
ob as (select * from el where {_obj.format("x")}),
pr as (select *, pos || '.negotiated_prices[' || k || ']' as here from (select *, unnest({_list.format("x->'$.negotiated_prices'")}) as y, unnest({_n.format("x->'$.negotiated_prices'")}) as k from ob)),
gr as (select *, pos || '.provider_groups[' || n || ']' as here from (select *, unnest({_list.format("x->'$.provider_groups'")}) as g, unnest({_n.format("x->'$.provider_groups'")}) as n from ob)),
gn as (select *, here || '.npi[' || p || ']' as spot from (select *, unnest(json_extract(g->'$.npi', '$[*]')) as w, unnest(range(json_array_length(g->'$.npi')::bigint)) as p from gr where {_obj.format("g")} and json_type(g->'$.npi') = 'ARRAY')),
odd as (
select file_id, 'malformed_json' as type, null as key, format('in_network[{{}}].negotiated_rates', i) as json_path, '' as detail from in_network where not json_valid(negotiated_rates) and trim(negotiated_rates) <> ''
union all select file_id, 'not_a_list', null, format('in_network[{{}}].negotiated_rates', i), {_shape.format("v")} from item where {_scalar_or_null.format("v")}
union all select file_id, 'not_an_object', null, pos, {_shape.format("x")} from el where coalesce(json_type(x), 'NULL') <> 'OBJECT'
union all {_unknown("el", "x", "pos", "rate")}
{"".join(f"union all select file_id, 'not_a_list', null, pos || '.{c}', {_shape.format(f"x->'$.{c}'")} from ob where {_scalar_or_null.format(f"x->'$.{c}'")} " for c in ("negotiated_prices", "provider_references", "provider_groups"))}
union all select file_id, 'rate_without_prices', null, pos, '' from ob where {_none.format("x->'$.negotiated_prices'")}
union all select file_id, 'rate_without_providers', null, pos, '' from ob where {_none.format("x->'$.provider_references'")} and {_none.format("x->'$.provider_groups'")}
union all select file_id, 'not_an_object', null, here, {_shape.format("g")} from gr where coalesce(json_type(g), 'NULL') <> 'OBJECT'
union all {_unknown("gr", "g", "here", "group")}
union all select file_id, 'missing_tin', 'tin', here, '' from gr where {_obj.format("g")} and (coalesce(json_type(g->'$.tin'), 'NULL') <> 'OBJECT' or len(json_keys(g->'$.tin')) = 0)
union all select file_id, 'missing_npi', 'npi', here, {_told.format("(g->'$.npi')")} from gr where {_obj.format("g")} and (coalesce(json_type(g->'$.npi'), 'NULL') <> 'ARRAY' or json_array_length(g->'$.npi') = 0)
union all select file_id, 'npi_not_10_digits', 'npi', spot, {_told.format("w")} from gn where not regexp_full_match({_told.format("w")}, '[0-9]{{10}}')
union all select file_id, 'not_an_object', null, here, {_shape.format("y")} from pr where coalesce(json_type(y), 'NULL') <> 'OBJECT'
union all {_unknown("pr", "y", "here", "price")}
union all select file_id, 'rate_not_a_number', 'negotiated_rate', here, {_told.format("(y->'$.negotiated_rate')")} from pr where {_obj.format("y")} and coalesce(json_type(y->'$.negotiated_rate'), 'NULL') not in ('DOUBLE', 'UBIGINT', 'BIGINT', 'HUGEINT')
union all select file_id, 'unknown_negotiated_type', 'negotiated_type', here, {_told.format("(y->'$.negotiated_type')")} from pr where {_obj.format("y")} and coalesce(y->>'$.negotiated_type', '') not in ('negotiated', 'derived', 'fee schedule', 'percentage', 'per diem')
{"".join(f"union all select file_id, 'not_a_list', null, here || '.{c}', {_shape.format(f"y->'$.{c}'")} from pr where {_obj.format('y')} and {_scalar_or_null.format(f"y->'$.{c}'")} " for c in ("service_code", "billing_code_modifier"))}),
pgs as (select file_id, m, unnest(provider_groups) as g, unnest(range(len(provider_groups))) as n from provider_references),
refodd as (
select file_id, 'missing_provider_group_id' as type, 'provider_group_id' as key, format('provider_references[{{}}]', m) as json_path, '' as detail from provider_references where provider_group_id is null
union all select file_id, 'remote_provider_reference', 'location', format('provider_references[{{}}]', m), location from provider_references where location is not null
union all select file_id, 'missing_tin', 'tin', format('provider_references[{{}}].provider_groups[{{}}]', m, n), '' from pgs where g is not null and (g.tin is null or coalesce(g.tin.type, g.tin.value, g.tin.business_name) is null)
union all select file_id, 'missing_npi', 'npi', format('provider_references[{{}}].provider_groups[{{}}]', m, n), '' from pgs where g is not null and (g.npi is null or len(g.npi) = 0)
union all select file_id, 'npi_not_10_digits', 'npi', format('provider_references[{{}}].provider_groups[{{}}].npi[{{}}]', m, n, p), coalesce(npi, '') from (
  select file_id, m, n, unnest(g.npi) as npi, unnest(range(len(g.npi))) as p from pgs where g is not null) where not coalesce(regexp_full_match(npi, '[0-9]{{10}}'), false))"""
_odd = ["file_id", "type", "key", "json_path", "detail"]
query("extract_oddities", f"with {ODD_SQL} select *, count(*) as n from odd group by all")(
    lambda spark, sf: E.oddities(table(spark, sf, "in_network")).groupBy(*_odd).agg(F.count(F.lit(1)).alias("n"))
)
query("reference_oddities", f"with {ODD_SQL} select *, count(*) as n from refodd group by all")(
    lambda spark, sf: E.reference_oddities(table(spark, sf, "provider_references")).groupBy(*_odd).agg(F.count(F.lit(1)).alias("n"))
)

# ---- capitation -----------------------------------------------------------------------------------------------------------

_target = f"(s->>'$.billing_code') in {_CODES_SQL} and (s->>'$.billing_code_type') = '{CODE_TYPE}'"
CAP_SQL = f"""cap as (select row_number() over () as rid, file_id, i, negotiated_rates, covered_services from in_network where negotiation_arrangement = 'capitation'),
svc as (select rid, file_id, i, unnest({_list.format("covered_services::json")}) as s, unnest({_n.format("covered_services::json")}) as c from cap where json_valid(covered_services)),
own as (select rid, count(*) as n_covered_services, array_to_string(coalesce(list_sort(list(distinct s->>'$.billing_code') filter (where {_obj.format("s")} and {_target})), []), ',') as covered_target_codes from svc group by 1),
crate as (select * from (select rid, file_id, i, unnest({_list.format("negotiated_rates::json")}) as x, unnest({_n.format("negotiated_rates::json")}) as j from cap where json_valid(negotiated_rates)) where {_obj.format("x")}),
cprice as (select * from (select rid, file_id, i, j, unnest({_list.format("x->'$.negotiated_prices'")}) as y, unnest({_n.format("x->'$.negotiated_prices'")}) as k from crate) where {_obj.format("y")}),
cgrp as (select rid, j, r, g->>'$' as gid from (select rid, j, unnest({_list.format("x->'$.provider_references'")}) as g, unnest({_n.format("x->'$.provider_references'")}) as r from crate)
  union all select rid, j, null, format('inline:{{}}:{{}}:{{}}', i, j, n) from (select rid, i, j, unnest({_list.format("x->'$.provider_groups'")}) as g, unnest({_n.format("x->'$.provider_groups'")}) as n from crate) where {_obj.format("g")}),
caprate as (select p.file_id, p.i, p.j, p.k, r, gid as provider_group_id, y->>'$.negotiated_type' as negotiated_type, y->>'$.negotiated_rate' as negotiated_rate_raw,
  case when json_type(y->'$.negotiated_rate') in ('DOUBLE', 'UBIGINT', 'BIGINT', 'HUGEINT') then try_cast(y->>'$.negotiated_rate' as double) end as negotiated_rate, coalesce(covered_target_codes, '') as covered_target_codes, coalesce(n_covered_services, 0) as n_covered_services
  from cprice p join cgrp g on p.rid = g.rid and p.j = g.j left join own on own.rid = p.rid)"""
_joined = lambda df: df.withColumn("covered_target_codes", F.array_join("covered_target_codes", ","))
query("capitation_items", f"with {CAP_SQL} select file_id, i, coalesce(covered_target_codes, '') as covered_target_codes, coalesce(n_covered_services, 0) as n_covered_services from cap left join own using (rid)")(
    lambda spark, sf: _joined(E.capitation_items(table(spark, sf, "in_network"), CODES, CODE_TYPE))
)
query(
    "covered_services",
    f"""with {CAP_SQL} select file_id, i, c, s->>'$.billing_code_type' as billing_code_type, s->>'$.billing_code_type_version' as billing_code_type_version, s->>'$.billing_code' as billing_code,
s->>'$.description' as description, coalesce({_target}, false) as is_target_code from svc where {_obj.format("s")}""",
)(lambda spark, sf: E.covered_services(table(spark, sf, "in_network"), CODES, CODE_TYPE))
_cap = ["file_id", "i", "j", "k", "r", "provider_group_id", "negotiated_type", "negotiated_rate_raw", "negotiated_rate", "covered_target_codes", "n_covered_services"]
query("capitation_rates", f"with {CAP_SQL} select {', '.join(_cap)} from caprate")(lambda spark, sf: _joined(E.capitation_rates(table(spark, sf, "in_network"), CODES, CODE_TYPE)).select(*_cap))

GROUPS_SQL = f"""grps as (select file_id, m, provider_group_id, n, g.tin.type as tin_type, g.tin.value as tin_value, unnest(g.npi) as npi, unnest(range(len(g.npi)))::int as p
  from (select file_id, m, provider_group_id, unnest(provider_groups) as g, unnest(range(len(provider_groups)))::int as n from provider_references where provider_group_id is not null)
  union all select file_id, null, format('inline:{{}}:{{}}:{{}}', i, j, n), n, g->>'$.tin.type', g->>'$.tin.value', w->>'$', p from (
    select file_id, i, j, n, g, unnest({_list.format("g->'$.npi'")}) as w, unnest({_n.format("g->'$.npi'")})::int as p from (
      select file_id, i, j, unnest({_list.format("x->'$.provider_groups'")}) as g, unnest({_n.format("x->'$.provider_groups'")})::int as n from (
        select * from (select file_id, i, unnest({_list.format("v")}) as x, unnest({_n.format("v")}) as j from (select file_id, i, negotiated_rates::json as v from in_network where json_valid(negotiated_rates))) where {_obj.format("x")})) where {_obj.format("g")}))"""
_groups = ["file_id", "m", "provider_group_id", "n", "tin_type", "tin_value", "npi", "p"]
query("group_rows", f"with {GROUPS_SQL} select {', '.join(_groups)} from grps")(
    lambda spark, sf: E.group_rows(table(spark, sf, "in_network"), table(spark, sf, "provider_references")).select(*_groups)
)
query(
    "capitation",
    S.PREFIX + f""", {CAP_SQL}, {GROUPS_SQL}
select c.file_id, c.i, c.j, c.k, c.negotiated_rate, c.covered_target_codes, g.npi, g.tin_value as tin, p.provider_name, p.practice_city, t.tag_type, t.tag_name
from caprate c join grps g on g.file_id = c.file_id and g.provider_group_id = c.provider_group_id left join providers p on p.npi = g.npi left join tins t on t.tin = g.tin_value""",
)(lambda spark, sf: _capitation(spark, sf))


def _capitation(spark: SparkSession, sf: str) -> DataFrame:
    """Capitation rates per NPI with provider and tags, by rate."""
    items = table(spark, sf, "in_network")
    rates = _joined(E.capitation_rates(items, CODES, CODE_TYPE))
    rows = rates.join(E.group_rows(items, table(spark, sf, "provider_references")).drop("m", "n", "p", "network_name"), ["file_id", "provider_group_id"]).withColumnRenamed("tin_value", "tin")
    rows = rows.join(S.providers(spark, sf).select("npi", "provider_name", "practice_city"), "npi", "left").join(S.tins(spark, sf).select("tin", "tag_type", "tag_name"), "tin", "left")
    rows = rows.select("file_id", "i", "j", "k", "negotiated_rate", "covered_target_codes", "npi", "tin", "provider_name", "practice_city", "tag_type", "tag_name")
    return rows.orderBy(F.col("negotiated_rate").asc_nulls_last(), "file_id", "i", "j", "k")


query(
    "reference_groups",
    """select file_id, m, provider_group_id, n, g.tin.type as tin_type, g.tin.value as tin_value, unnest(g.npi) as npi, unnest(range(len(g.npi)))::int as p
from (select file_id, m, provider_group_id, unnest(provider_groups) as g, unnest(range(len(provider_groups)))::int as n from provider_references where provider_group_id is not null)""",
)(lambda spark, sf: E.reference_groups(table(spark, sf, "provider_references")).select("file_id", "m", "provider_group_id", "n", "tin_type", "tin_value", "npi", "p"))
query(
    "unknown_price_keys",
    f"""with {RATES_JSON} select key, count(*) as n from (select unnest(json_keys(y)) as key from price) where key not in ('negotiated_type', 'negotiated_rate', 'expiration_date', 'service_code', 'billing_class',
'setting', 'billing_code_modifier', 'additional_information') group by 1""",
)(
    lambda spark, sf: E.oddities(table(spark, sf, "in_network").filter(~E.is_capitation())).filter("type = 'unknown_key' and json_path like '%negotiated_prices[%'")
    .groupBy("key").agg(F.count(F.lit(1)).alias("n"))
)
_matched = f"billing_code in {_CODES_SQL} and billing_code_type = '{CODE_TYPE}'"
_per = lambda name, what, src: f"union all select file_id, '{name}', {what} from {src} group by 1 "
query(
    "file_counts",
    f"""with {RATES_JSON.replace("from in_network where", f"from in_network where {_matched} and")}, {ODD_SQL}, {CAP_SQL}, {GROUPS_SQL},
rrow as (select p.file_id, p.i, p.j, p.k, gid, y->>'$.negotiated_rate' as raw, json_type(y->'$.negotiated_rate') as t from price p join grp g on p.rid = g.rid and p.j = g.j),
named as (select distinct file_id, gid as provider_group_id from rrow union select distinct file_id, provider_group_id from caprate),
long as (select file_id, 'n_provider_references' as name, count(*) as n from provider_references group by 1
{_per("n_provider_group_npi_rows_total", "count(*)", "grps")}{_per("n_in_network_items", "count(*)", "in_network")}{_per("n_items_matched", "count(*)", f"in_network where {_matched} and coalesce(negotiation_arrangement, '') <> 'capitation'")}
{_per("n_price_rows", "count(distinct (i, j, k))", "rrow")}{_per("n_zero_price_rows", "count(distinct (i, j, k))", "rrow where t in ('DOUBLE', 'UBIGINT', 'BIGINT', 'HUGEINT') and try_cast(raw as double) = 0")}{_per("n_rate_rows", "count(*)", "rrow")}
{_per("n_groups_referenced", "count(*)", "named")}{_per("n_provider_group_npi_rows_kept", "count(*)", "grps semi join named using (file_id, provider_group_id)")}
{_per("n_capitation_items", "count(*)", "cap")}{_per("n_capitation_items_with_target_codes", "count(*)", "(select cap.file_id from cap join own using (rid) where covered_target_codes <> '')")}{_per("n_capitation_rows", "count(*)", "caprate")}
{_per("n_capitation_covered_services", "count(*)", f"svc where {_obj.format('s')}")}{_per("n_anomalies", "count(*)", "(select file_id from odd union all select file_id from refodd union all select n.file_id from named n anti join grps using (file_id, provider_group_id) where n.provider_group_id is not null)")})
select file_id, {", ".join(f"coalesce(sum(n) filter (where name = '{c}'), 0)::bigint as {c}" for c in E.COUNTERS)} from long group by 1""",
)(lambda spark, sf: E.file_counts(table(spark, sf, "in_network"), table(spark, sf, "provider_references"), CODES, CODE_TYPE))
query("undefined_log", f"with {RATES_JSON}, {GROUPS_SQL} select distinct file_id, 'undefined_provider_group' as type, gid as key from grp where gid is not null and not exists (select 1 from grps where grps.file_id = grp.file_id and grps.provider_group_id = grp.gid) and exists (select 1 from price where price.rid = grp.rid and price.j = grp.j)")(
    lambda spark, sf: E.undefined_log(E.rate_rows(table(spark, sf, "in_network")), E.group_rows(table(spark, sf, "in_network"), table(spark, sf, "provider_references"))).select("file_id", "type", "key")
)

# ---- report, registry, trace ------------------------------------------------------------------------------------------------

_cell = lambda *cs: "concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, '')" for c in cs) + ")"
_by = lambda title, *cs, src="pr": f"select '{title}' as section, {_cell(*cs, 'n')} as cells from (select {', '.join(cs)}, count(*) as n from {src} group by all)"
_top = lambda title, c: f"select '{title}', {_cell(c, 'n')} from (select {c}, count(*) as n from pr group by all order by n desc, {c} nulls last limit 15)"
query(
    "profile_report",
    f"""with pr as (select distinct file_id, i, j, k, billing_code, negotiated_type, rate_unit, billing_class, setting, negotiation_arrangement, array_to_string(list_sort(service_code), ',') as service_code,
  array_to_string(list_sort(billing_code_modifier), ',') as billing_code_modifier, is_zero_rate from rates), zr as (select * from pr where is_zero_rate), bad as (select npi from provider_groups where not coalesce(regexp_full_match(npi, '[0-9]{{10}}'), false)),
fc as ({SQL["file_counts"]})
{_by("prices by type, unit and class", "negotiated_type", "rate_unit", "billing_class")} union all {_by("prices by code, unit and class", "billing_code", "rate_unit", "billing_class")}
union all {_by("prices by arrangement", "negotiation_arrangement")} union all {_by("prices by setting", "setting")} union all {_top("largest sets of places", "service_code")} union all {_top("largest sets of modifiers", "billing_code_modifier")}
union all {_by("zero prices", "rate_unit", "billing_class", src="zr")} union all {_by("anomalies", "step", "type", src="anomalies")} union all {_by("npis that are none", "npi", src="bad")}
union all select 'capitation', concat_ws('|', covered_target_codes, unit, n, coalesce(lo, ''), coalesce(hi, '')) from (select covered_target_codes, case negotiated_type when 'negotiated' then 'dollars' when 'derived' then 'dollars' when 'fee schedule' then 'dollars'
  when 'percentage' then 'percent_of_billed_charges' when 'per diem' then 'dollars_per_day' else 'unknown' end as unit, count(*) as n, printf('%.2f', min(negotiated_rate)) as lo, printf('%.2f', max(negotiated_rate)) as hi from ({SQL["capitation_rates"]}) group by 1, 2)
union all select 'counts per file', {_cell("file_id", *E.COUNTERS)} from fc""",
)(lambda spark, sf: B.stacked_sections(_sections(spark, sf)))


def _sections(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = lambda name: table(spark, sf, name)
    cap = _joined(E.capitation_rates(t("in_network"), CODES, CODE_TYPE))
    out = B.profile_sections(t("rates"), t("anomalies"), t("provider_groups"), cap, E.file_counts(t("in_network"), t("provider_references"), CODES, CODE_TYPE))
    out["capitation"] = out["capitation"].withColumns({c: F.format_string("%.2f", c) for c in ("min_rate", "max_rate")})
    return out


_TAXONOMY = "select distinct primary_taxonomy_code as code from nppes where primary_taxonomy_code is not null and primary_taxonomy_code not like '9Z%'"
query(
    "taxonomy_log",
    f"""with tax as ({_TAXONOMY}) select npi, 'taxonomy_code_not_listed' as type, primary_taxonomy_code as detail from nppes where primary_taxonomy_code is not null and primary_taxonomy_code not in (select code from tax)
union all select npi, 'ambiguous_primary_taxonomy', array_to_string(taxonomy_codes, ',') from nppes where primary_taxonomy_rule = 'ambiguous'""",
)(lambda spark, sf: B.registry_log(table(spark, sf, "nppes"), _taxonomy(spark, sf))[1])


def _taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    """A list of the codes in use but for one family."""
    codes = table(spark, sf, "nppes").select(F.col("primary_taxonomy_code").alias("code")).filter("code is not null and code not like '9Z%'").distinct()
    return codes.select("code", *[F.concat(F.lit(f"{c} of "), "code").alias(c) for c in ("grouping", "classification", "specialization", "display_name")])


query(
    "taxonomy_names",
    f"with tax as ({_TAXONOMY}) select npi, case when code is not null then 'display_name of ' || code end as display_name from nppes left join tax on code = primary_taxonomy_code",
)(lambda spark, sf: B.registry_log(table(spark, sf, "nppes"), _taxonomy(spark, sf))[0].select("npi", "display_name"))
query(
    "trace_rows",
    """with f as (select file_id, count(*) as size from rates_npi group by 1) select file_id, size, i, j, k, r, m, n, p, npi from rates_npi join f using (file_id)
order by size, file_id, i nulls last, j nulls last, k nulls last, r nulls last, m nulls last, n nulls last, p nulls last limit 20""",
)(lambda spark, sf: (lambda t: B.trace_rows(t, t.groupBy("file_id").agg(F.count(F.lit(1)).alias("size"))).select("file_id", "size", *"ijkrmnp", "npi"))(table(spark, sf, "rates_npi")))
