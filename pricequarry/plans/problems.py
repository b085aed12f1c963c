"""Registered queries of the general data-processing operators, each over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricequarry.operators.skew import heavy_keys, skewed_key_stats
from pricequarry.operators.snapshots import snapshot_changes
from pricequarry.session import table
from pricequarry.sources import dirty_csv, drift, nested

OFF_TIE = 1e-7  # both engines round away from ties
KEYS = ["tin_value", "npi", "billing_code", "billing_class"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of billing_code and tin_value that hold at least 3% of all rows of rates_npi."""
    found = heavy_keys(table(spark, sf_dir, "rates_npi"), ["billing_code", "tin_value"], "negotiated_rate", share=0.03)
    return found.select("key_field", "key_value")


def p1_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and rate statistics per billing_code and per tin_value."""
    s = skewed_key_stats(table(spark, sf_dir, "rates_npi"), ["billing_code", "tin_value"], "negotiated_rate", distinct="npi")
    return s.select(
        "key_field", "key_value", "n_rows", F.col("n_values").alias("n_rates"), F.round(F.col("avg_value") + OFF_TIE, 4).alias("avg_rate"),
        F.col("min_value").alias("min_rate"), F.col("max_value").alias("max_rate"), F.round(F.col("std_value") + OFF_TIE, 3).alias("std_rate"), F.col("n_distinct").alias("n_npis"),
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of fields between one file of a feed and the one before."""
    return drift.schema_changes(table(spark, sf_dir, "feed_rows")).select("file_id", "change", "old_field", "new_field")


def p2_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union schema: JSON types and promoted type of each field of each record kind."""
    f = drift.field_types(table(spark, sf_dir, "feed_rows"))
    has = lambda x: F.array_contains("types", x)
    promoted = F.when(has("array"), "array<string>").when(F.size("types") != 1, "string").when(has("number"), "double").when(has("boolean"), "boolean").otherwise("string")
    return f.select("record_kind", "field", F.array_join("types", ",").alias("types"), promoted.alias("promoted"), "n_files", "n_values")


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates records of all feeds as one table, renamed fields in one column."""
    rows = table(spark, sf_dir, "feed_rows")
    return drift.unified(rows, "rates", renames=drift.schema_changes(rows))


def p2_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomalies records of all feeds as one table, renamed fields in one column."""
    rows = table(spark, sf_dir, "feed_rows")
    return drift.unified(rows, "anomalies", renames=drift.schema_changes(rows))


def p2_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every filled cell of the two unified tables, before renamed fields are put together: row, field and value by its type."""
    rows = table(spark, sf_dir, "feed_rows").select("row_no", "feed", "record_kind", "file_id", "file_date", "body")
    out = []
    for kind in ("rates", "anomalies"):
        wide = drift.unified(rows, kind)
        cells = []
        for f in wide.schema:
            if f.name not in rows.columns:
                c, t = F.col(f"`{f.name}`"), f.dataType.simpleString()
                num, txt, size = (c if t == "double" else F.lit(None)).cast("double"), (c if t in ("string", "boolean") else F.lit(None)).cast("string"), F.when(c.isNotNull(), F.size(c)) if t == "array<string>" else F.lit(None)
                cells.append(F.struct(F.lit(f.name).alias("field"), num.alias("num"), txt.alias("txt"), size.cast("int").alias("n_items")))
        flat = wide.select("row_no", "record_kind", F.explode(F.array(*cells)).alias("x")).select("row_no", "record_kind", "x.*")
        out.append(flat.filter("num is not null or txt is not null or n_items is not null"))
    return out[0].unionByName(out[1])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child of in_network and provider_references with its position path."""
    return nested.children(table(spark, sf_dir, "in_network"), table(spark, sf_dir, "provider_references"))


def p3_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat price table."""
    return nested.price_table(table(spark, sf_dir, "in_network"))


def p3_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat reference table."""
    return nested.reference_table(table(spark, sf_dir, "in_network"))


def p3_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat covered-service table."""
    return nested.service_table(table(spark, sf_dir, "in_network"))


def p3_npis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat NPI table."""
    return nested.npi_table(table(spark, sf_dir, "in_network"), table(spark, sf_dir, "provider_references"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of groups, parents of the NPIs."""
    return nested.group_table(table(spark, sf_dir, "in_network"), table(spark, sf_dir, "provider_references"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added, removed and changed in negotiated_rate between consecutive snapshots."""
    c = snapshot_changes(table(spark, sf_dir, "rates_npi_dedup"), "snapshot_date", KEYS, "negotiated_rate", "loaded_at")
    return c.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), *KEYS, "change")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of raw_lines that can't be loaded, with the first reason that applies."""
    return dirty_csv.rejected(table(spark, sf_dir, "raw_lines"))


def p6_nppes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry rows that were loaded."""
    return dirty_csv.loaded(table(spark, sf_dir, "raw_lines"), "nppes")


def p6_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomaly rows that were loaded."""
    return dirty_csv.loaded(table(spark, sf_dir, "raw_lines"), "anomalies")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_stats, p2_found, p2_fields, p2_rates, p2_anomalies, p2_cells, p3_found, p3_prices, p3_references, p3_services, p3_npis, p3_groups, p5_found, p6_found, p6_nppes, p6_anomalies)
}

_FIELD = r'("(?:[^"]|"")*"|[^",]*)'
_LINES = rf"""
with raw as (select line_id, record_kind, regexp_replace(coalesce(line, ''), '\r\z', '') as s from raw_lines where record_kind in ('nppes', 'anomalies')),
split as (
  select *, regexp_full_match(s, '(?s){_FIELD}(,{_FIELD})*') as whole,
         list_transform(regexp_extract_all(',' || s, '(?s),{_FIELD}', 1),
                        lambda x: case when starts_with(x, '"') then replace(x[2:-2], '""', '"') else x end) as f
  from raw)
"""
_DATE = r"(regexp_full_match({c}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') and try_strptime({c}, '%m/%d/%Y') is not null)"
_BAD_N = (
    r"case when not regexp_full_match(f[1], '[ \t]*[0-9]{10}[ \t]*') then 'npi' when f[2] not in ('1', '2') then 'entity_type_code'"
    r" when not regexp_full_match(f[10], '([0-9]{5}([0-9]{4})?)?') then 'practice_zip'"
    f" when not {_DATE.format(c='f[11]')} then 'enumeration_date' when f[12] <> '' and not {_DATE.format(c='f[12]')} then 'last_update_date' end"
)
_BAD_A = (
    r"case when f[1] not in ('index', 'extract', 'nppes') then 'step' when not regexp_full_match(f[2], '[0-9a-f]{12}') then 'file_id'"
    r" when regexp_matches(f[6], '[\x00-\x09\x0B-\x1F\x7F-\x{9F}\x{FFFD}]') then 'detail' end"
)
_REASON = (
    "case when not whole then 'broken_quoting' when len(f) <> if(record_kind = 'nppes', 12, 6) then 'wrong_column_count'"
    f" when record_kind = 'nppes' then 'bad_value:' || ({_BAD_N}) else 'bad_value:' || ({_BAD_A}) end"
)


def _loaded_sql(kind: str) -> str:
    cols = ["trim(f[1], ' ' || chr(9))" if kind == "nppes" and n == 0 else f"f[{n + 1}]" for n in range(len(dirty_csv.KINDS[kind]))]
    cols = ", ".join((f"try_strptime({c}, '%m/%d/%Y')::date" if x.kind == "date" else f"nullif({c}, '')") + f" as {x.name}" for c, x in zip(cols, dirty_csv.KINDS[kind], strict=True))
    return f"{_LINES} select line_id, {cols} from split where record_kind = '{kind}' and ({_REASON}) is null"


def _items(v: str) -> str:
    return f"unnest(case json_type({v}) when 'ARRAY' then json_extract({v}, '$[*]') when 'NULL' then [] else [{v}] end)"


def _nth(v: str) -> str:
    return f"unnest(case json_type({v}) when 'ARRAY' then range(json_array_length({v})::bigint) when 'NULL' then [] else [0] end)"


_OBJ = "json_type({0}) = 'OBJECT'"
_SCALAR = "json_type({0}) not in ('OBJECT', 'ARRAY', 'NULL')"
_P3 = f"""
with rate as (
  select * from (select file_id, i, {_items("negotiated_rates::json")} as x, {_nth("negotiated_rates::json")} as j from in_network
                 where json_valid(negotiated_rates)) where {_OBJ.format("x")}),
grp as (
  select * from (select file_id, i, j, {_items("x->'$.provider_groups'")} as g, {_nth("x->'$.provider_groups'")} as n from rate)
  where {_OBJ.format("g")}),
price as (select file_id, i, j, {_items("x->'$.negotiated_prices'")} as v, {_nth("x->'$.negotiated_prices'")} as k from rate),
ref as (select file_id, i, j, {_items("x->'$.provider_references'")} as v, {_nth("x->'$.provider_references'")} as k from rate),
inp as (select file_id, i, j, n, {_items("g->'$.npi'")} as v, {_nth("g->'$.npi'")} as p from grp),
svc as (select file_id, i, {_items("covered_services::json")} as v, {_nth("covered_services::json")} as c from in_network where json_valid(covered_services)),
pg as (select file_id, m, unnest(provider_groups) as g, unnest(range(len(provider_groups))) as n from provider_references),
np as (select file_id, m, n, unnest(g.npi) as v, unnest(range(len(g.npi))) as p from pg)
"""
_P3_FOUND = f"""{_P3}
select distinct file_id, child_kind, child_path, child_key from (
select file_id, 'price' as child_kind, format('in_network[{{}}].negotiated_rates[{{}}].negotiated_prices[{{}}]', i, j, k) as child_path, '' as child_key
  from price where {_OBJ.format("v")}
union all select file_id, 'reference', format('in_network[{{}}].negotiated_rates[{{}}].provider_references[{{}}]', i, j, k), v->>'$' from ref where {_SCALAR.format("v")}
union all select file_id, 'inline_npi', format('in_network[{{}}].negotiated_rates[{{}}].provider_groups[{{}}].npi[{{}}]', i, j, n, p), v->>'$' from inp where {_SCALAR.format("v")}
union all select file_id, 'covered_service', format('in_network[{{}}].covered_services[{{}}]', i, c), coalesce(v->>'$.billing_code', '') from svc where {_OBJ.format("v")}
union all select file_id, 'npi', format('provider_references[{{}}].provider_groups[{{}}].npi[{{}}]', m, n, p), v from np where v is not null)
"""

_FEED = """
with rec as (select row_no, feed, record_kind, file_id, cast(file_date as varchar) as file_date, body::json as b from feed_rows where json_valid(body) and json_type(body::json) = 'OBJECT'),
top as (select row_no, feed, record_kind, file_id, file_date, b, key, json_extract(b, '$."' || key || '"') as x from (select *, unnest(json_keys(b)) as key from rec)),
sub as (select * from top where json_type(x) = 'OBJECT'),
leaf as (
  select row_no, feed, record_kind, file_id, file_date, b, key as field, x from top where json_type(x) <> 'OBJECT'
  union all select row_no, feed, record_kind, file_id, file_date, b, key || '.' || k2, json_extract(x, '$."' || k2 || '"') from (select *, unnest(json_keys(x)) as k2 from sub)),
typed as (
  select *, case json_type(x) when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' when 'NULL' then null else 'number' end as t,
         case when json_type(x) = 'NULL' then null when json_type(x) = 'ARRAY' then x::varchar else x->>'$' end as v,
         case when json_exists(b, '$.i') or json_exists(b, '$.j') then concat_ws('|', b->>'$.i', b->>'$.j', b->>'$.k', b->>'$.r') else b->>'$.row' end as rec_key
  from leaf)"""
_P2_FIELDS = f"""{_FEED}
select record_kind, field, array_to_string(ts, ',') as types, case when list_contains(ts, 'array') then 'array<string>' when len(ts) <> 1 then 'string' when ts[1] = 'number' then 'double' when ts[1] = 'boolean' then 'boolean'
       else 'string' end as promoted, n_files, n_values
from (select record_kind, field, coalesce(list_sort(list(distinct t) filter (where t is not null)), []) as ts, count(distinct (feed, file_id)) as n_files, count(v) as n_values from typed group by 1, 2)"""
_P2_CELLS = f"""{_FEED}, prom as (select record_kind, field, promoted from ({_P2_FIELDS}))
select row_no, record_kind, replace(field, '.', '__') || case when lower(field) in ('row_no', 'feed', 'record_kind', 'file_id', 'file_date')
  or exists (select 1 from prom q where q.record_kind = typed.record_kind and lower(q.field) = lower(typed.field) and q.field < typed.field) then '_field' else '' end as field,
case when promoted = 'double' then v::double end as num, case when promoted in ('string', 'boolean') then v end as txt,
case when promoted = 'array<string>' then case when json_type(x) = 'ARRAY' then json_array_length(x) else 1 end end::int as n_items
from typed join prom using (record_kind, field) where json_type(x) <> 'NULL'"""
_P2_FOUND = f"""{_FEED},
file as (select *, row_number() over (partition by feed, record_kind order by file_date, file_id) as seq from (select distinct feed, record_kind, file_id, cast(file_date as varchar) as file_date from feed_rows)),
h as (select feed, record_kind, seq, any_value(file_id) as file_id, field, list_sort(list(distinct t) filter (where t is not null)) as ts from typed join file using (feed, record_kind, file_id, file_date) group by feed, record_kind, seq, field),
plus as (select feed, record_kind, seq, file_id, field from h a where seq > 1 and not exists (select 1 from h b where b.feed = a.feed and b.record_kind = a.record_kind and b.field = a.field and b.seq = a.seq - 1)),
minus as (select a.feed, a.record_kind, f.seq, f.file_id, a.field from h a join file f on f.feed = a.feed and f.record_kind = a.record_kind and f.seq = a.seq + 1
  where not exists (select 1 from h b where b.feed = a.feed and b.record_kind = a.record_kind and b.field = a.field and b.seq = a.seq + 1)),
val as (select distinct feed, record_kind, seq, rec_key, field, v from typed join file using (feed, record_kind, file_id, file_date) where v is not null and rec_key is not null),
pair as (
  select p.feed, p.record_kind, p.seq, p.file_id, m.field as old_field, p.field as new_field, count(*) as n, count_if(x.v = y.v) as same
  from plus p join minus m using (feed, record_kind, seq) join val x on x.feed = p.feed and x.record_kind = p.record_kind and x.seq = p.seq - 1 and x.field = m.field
  join val y on y.feed = p.feed and y.record_kind = p.record_kind and y.seq = p.seq and y.field = p.field and y.rec_key = x.rec_key group by all having count_if(x.v = y.v) >= 2 and count_if(x.v = y.v) >= 0.9 * count(*)),
one as (select * from pair qualify row_number() over (partition by feed, record_kind, seq, old_field order by same desc, old_field, new_field) = 1),
ren as (select * from one qualify row_number() over (partition by feed, record_kind, seq, new_field order by same desc, old_field, new_field) = 1),
prev as (select *, lag(ts) over (partition by feed, record_kind, field order by seq) as before from h where ts is not null)
select file_id, 'added' as change, '' as old_field, field as new_field from plus p where not exists (select 1 from ren r where r.feed = p.feed and r.record_kind = p.record_kind and r.seq = p.seq and r.new_field = p.field)
union all select file_id, 'removed', field, '' from minus m where not exists (select 1 from ren r where r.feed = m.feed and r.record_kind = m.record_kind and r.seq = m.seq and r.old_field = m.field)
union all select file_id, 'renamed', old_field, new_field from ren
union all select file_id, 'type_changed', field, '' from prev where before is not null and ts <> before"""
_P3_PRICES = f"""{_P3} select distinct file_id, format('in_network[{{}}].negotiated_rates[{{}}].negotiated_prices[{{}}]', i, j, k) as child_path, format('in_network[{{}}].negotiated_rates[{{}}]', i, j) as parent_path,
v->>'$.negotiated_type' as negotiated_type, v->>'$.negotiated_rate' as negotiated_rate, v->>'$.expiration_date' as expiration_date, v->>'$.billing_class' as billing_class, v->>'$.setting' as setting,
v->>'$.service_code' as service_code, v->>'$.billing_code_modifier' as billing_code_modifier, v->>'$.additional_information' as additional_information from price where {_OBJ.format("v")}"""

_RATE_AT, _GROUP_AT = "format('in_network[{}].negotiated_rates[{}]', i, j)", "format('provider_references[{}].provider_groups[{}]', m, n)"
_INLINE_AT = "format('in_network[{}].negotiated_rates[{}].provider_groups[{}]', i, j, n)"
_P3_REFERENCES = f"{_P3} select distinct file_id, {_RATE_AT} || '.provider_references[' || k || ']' as child_path, {_RATE_AT} as parent_path, v->>'$' as provider_group_id from ref where {_SCALAR.format('v')}"
_P3_SERVICES = f"""{_P3} select distinct file_id, format('in_network[{{}}].covered_services[{{}}]', i, c) as child_path, format('in_network[{{}}]', i) as parent_path, v->>'$.billing_code_type' as billing_code_type,
v->>'$.billing_code_type_version' as billing_code_type_version, v->>'$.billing_code' as billing_code, v->>'$.description' as description from svc where {_OBJ.format("v")}"""
_P3_NPIS = f"""{_P3} select distinct * from (
select file_id, {_INLINE_AT} || '.npi[' || p || ']' as child_path, {_INLINE_AT} as parent_path, 'inline_npi' as kind, v->>'$' as npi from inp where {_SCALAR.format("v")}
union all select file_id, {_GROUP_AT} || '.npi[' || p || ']', {_GROUP_AT}, 'npi', v from np where v is not null)"""
_P3_GROUPS = f"""{_P3} select distinct * from (
select file_id, {_INLINE_AT} as child_path, {_RATE_AT} as parent_path, 'inline_group' as kind, g->>'$.tin.type' as tin_type, g->>'$.tin.value' as tin_value, g->>'$.tin.business_name' as tin_business_name from grp
union all select file_id, {_GROUP_AT}, format('provider_references[{{}}]', m), 'group', g.tin.type, g.tin.value, g.tin.business_name from pg where g is not null)"""

SQL = {
    "p1_found": """
select key_field, key_value from (
  select 'billing_code' as key_field, billing_code as key_value, count(*) as n from rates_npi where billing_code is not null group by 2
  union all select 'tin_value', tin_value, count(*) from rates_npi where tin_value is not null group by 2)
where n * 100 >= 3 * (select count(*) from rates_npi)""",
    "p1_stats": """
select key_field, key_value, count(*) as n_rows, count(negotiated_rate) as n_rates, round(avg(negotiated_rate) + 1e-7, 4) as avg_rate,
       min(negotiated_rate) as min_rate, max(negotiated_rate) as max_rate, round(stddev_samp(negotiated_rate) + 1e-7, 3) as std_rate, count(distinct npi) as n_npis
from (select 'billing_code' as key_field, billing_code as key_value, negotiated_rate, npi from rates_npi
      union all select 'tin_value', tin_value, negotiated_rate, npi from rates_npi)
where key_value is not null group by 1, 2""",
    "p2_found": _P2_FOUND,
    "p2_fields": _P2_FIELDS,
    "p2_cells": _P2_CELLS,
    "p3_found": _P3_FOUND,
    "p3_prices": _P3_PRICES,
    "p3_references": _P3_REFERENCES,
    "p3_services": _P3_SERVICES,
    "p3_npis": _P3_NPIS,
    "p3_groups": _P3_GROUPS,
    "p5_found": """
with last as (
  select cast(snapshot_date as date) as d, tin_value, npi, billing_code, billing_class, arg_max_null(negotiated_rate, (loaded_at, coalesce(negotiated_rate, -1e300))) as v
  from rates_npi_dedup where snapshot_date is not null group by all),
days as (select d, lead(d) over (order by d) as nd from (select distinct d from last)),
a as (select nd as d, tin_value, npi, billing_code, billing_class, v from last join days using (d) where nd is not null),
b as (select * from last where d > (select min(d) from last))
select strftime(coalesce(a.d, b.d), '%Y-%m-%d') as snapshot_date, coalesce(a.tin_value, b.tin_value) as tin_value, coalesce(a.npi, b.npi) as npi,
       coalesce(a.billing_code, b.billing_code) as billing_code, coalesce(a.billing_class, b.billing_class) as billing_class,
       case when a.d is null then 'added' when b.d is null then 'removed' else 'changed' end as change
from a full join b on a.d = b.d and a.tin_value is not distinct from b.tin_value and a.npi is not distinct from b.npi
  and a.billing_code is not distinct from b.billing_code and a.billing_class is not distinct from b.billing_class
where a.d is null or b.d is null or (a.v is null) <> (b.v is null) or abs(a.v - b.v) >= 0.005 - 1e-9""",
    "p6_found": f"{_LINES} select line_id, {_REASON} as reason from split where ({_REASON}) is not null",
    "p6_nppes": _loaded_sql("nppes"),
    "p6_anomalies": _loaded_sql("anomalies"),
}
