"""Items of price files as typed tables, with positions to their source and a log of what is odd about them.

Input are rows (file_id, position, raw JSON of the item), from the JSON source or a table. The JSON is read by the nested
flattener, which keeps number text; everything after it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.scalar import RATE_UNITS, rate_unit, valid_npi
from pricequarry.sources.nested import Number, as_text, dump, parse
from pricequarry.sources.nested import listed_at as listed

# The keys known at each level of an item.
KNOWN = {
    "item": "negotiation_arrangement name billing_code_type billing_code_type_version billing_code description negotiated_rates bundled_codes covered_services".split(),
    "rate": "provider_references provider_groups negotiated_prices".split(),
    "price": "negotiated_type negotiated_rate expiration_date service_code billing_class setting billing_code_modifier additional_information".split(),
    "group": "npi tin".split(),
    "tin": "type value business_name".split(),
    "reference": "provider_group_id network_name provider_groups location".split(),
    "service": "billing_code_type billing_code_type_version billing_code description".split(),
}
RATE_DDL = (
    "file_id string, i long, j long, k long, r long, provider_group_id string, negotiated_type string, raw string, is_number boolean, expiration_date string, billing_class string,"
    " setting string, service_code array<string>, billing_code_modifier array<string>, additional_information string"
)
RATE_SCHEMA = pa.schema(
    [("file_id", pa.string()), *[(c, pa.int64()) for c in "ijkr"], ("provider_group_id", pa.string()), ("negotiated_type", pa.string()), ("raw", pa.string()), ("is_number", pa.bool_())]
    + [(c, pa.string()) for c in ("expiration_date", "billing_class", "setting")] + [(c, pa.list_(pa.string())) for c in ("service_code", "billing_code_modifier")] + [("additional_information", pa.string())]
)
ODD_SCHEMA = pa.schema([(c, pa.string()) for c in ("file_id", "type", "key", "json_path", "detail")])


def texts(v: object) -> list[str | None] | None:
    return None if v is None else [as_text(x) for x in listed(v)]


def shape(v: object) -> str:
    if v is None:
        return "null"
    return "boolean" if isinstance(v, bool) else "number" if isinstance(v, Number) else {dict: "object", list: "array"}.get(type(v), "text")


def told(v: object) -> str:
    """A value as a detail of the log: its text, '' for null, the shape of objects and lists."""
    return shape(v) if isinstance(v, (dict, list)) else as_text(v) or ""


def item_rates(file_id: str, i: int, rates: object) -> Iterator[tuple]:
    """Every price for every group it is listed for: references by position, then groups that stand inside, without one."""
    for j, rate in enumerate(listed(rates)):
        if not isinstance(rate, dict):
            continue
        groups: list[tuple[int | None, str | None]] = [(r, as_text(g)) for r, g in enumerate(listed(rate.get("provider_references")))]
        groups += [(None, f"inline:{i}:{j}:{n}") for n, g in enumerate(listed(rate.get("provider_groups"))) if isinstance(g, dict)]
        for k, price in enumerate(listed(rate.get("negotiated_prices"))):
            if not isinstance(price, dict):
                continue
            raw = price.get("negotiated_rate")
            t = lambda name, price=price: as_text(price.get(name))
            own = (t("negotiated_type"), as_text(raw), isinstance(raw, Number), t("expiration_date"), t("billing_class"), t("setting"))
            own += (texts(price.get("service_code")), texts(price.get("billing_code_modifier")), t("additional_information"))
            for r, g in groups:
                yield (file_id, i, j, k, r, g, *own)


def item_oddities(file_id: str, i: int, rates: object) -> Iterator[tuple]:
    """(file_id, type, key, json_path, detail) of what an item's rates hold that they shouldn't."""
    top = f"in_network[{i}].negotiated_rates"

    def keys(obj: object, level: str, path: str) -> Iterator[tuple]:
        if not isinstance(obj, dict):
            yield file_id, "not_an_object", None, path, shape(obj)
        else:
            for key in obj.keys() - set(KNOWN[level]):
                yield file_id, "unknown_key", key, f"{path}.{key}", ""

    if rates is not None and not isinstance(rates, list):
        yield file_id, "not_a_list", None, top, shape(rates)
    for j, rate in enumerate(listed(rates)):
        at = f"{top}[{j}]"
        yield from keys(rate, "rate", at)
        if not isinstance(rate, dict):
            continue
        for name, kind in (("negotiated_prices", "rate_without_prices"), ("provider_references", None), ("provider_groups", None)):
            v = rate.get(name)
            if v is not None and not isinstance(v, list):
                yield file_id, "not_a_list", None, f"{at}.{name}", shape(v)
            if kind and not listed(v):
                yield file_id, kind, None, at, ""
        if not listed(rate.get("provider_references")) and not listed(rate.get("provider_groups")):
            yield file_id, "rate_without_providers", None, at, ""
        for n, group in enumerate(listed(rate.get("provider_groups"))):
            here = f"{at}.provider_groups[{n}]"
            yield from keys(group, "group", here)
            if isinstance(group, dict):
                yield from group_oddities(file_id, group, here)
        for k, price in enumerate(listed(rate.get("negotiated_prices"))):
            here = f"{at}.negotiated_prices[{k}]"
            yield from keys(price, "price", here)
            if isinstance(price, dict):
                if not isinstance(price.get("negotiated_rate"), Number):
                    yield file_id, "rate_not_a_number", "negotiated_rate", here, told(price.get("negotiated_rate"))
                if as_text(price.get("negotiated_type")) not in RATE_UNITS:
                    yield file_id, "unknown_negotiated_type", "negotiated_type", here, told(price.get("negotiated_type"))
                for name in ("service_code", "billing_code_modifier"):
                    if price.get(name) is not None and not isinstance(price[name], list):
                        yield file_id, "not_a_list", None, f"{here}.{name}", shape(price[name])


def group_oddities(file_id: str, group: dict, path: str) -> Iterator[tuple]:
    if not isinstance(group.get("tin"), dict) or not group["tin"]:
        yield file_id, "missing_tin", "tin", path, ""
    npis = group.get("npi")
    if not isinstance(npis, list) or not npis:
        yield file_id, "missing_npi", "npi", path, told(npis)
    for p, npi in enumerate(npis if isinstance(npis, list) else []):
        s = told(npi)
        if not (len(s) == 10 and s.isascii() and s.isdigit()):
            yield file_id, "npi_not_10_digits", "npi", f"{path}.npi[{p}]", s


def item_groups(file_id: str, i: int, rates: object) -> Iterator[tuple]:
    """The NPIs of the groups that stand inside an item's rates, under the id that the rates carry."""
    for j, rate in enumerate(listed(rates)):
        for n, g in enumerate(listed(rate.get("provider_groups")) if isinstance(rate, dict) else []):
            if isinstance(g, dict):
                tin = g.get("tin") if isinstance(g.get("tin"), dict) else {}
                own = tuple(as_text(tin.get(k)) for k in KNOWN["tin"])
                for p, npi in enumerate(listed(g.get("npi"))):
                    yield (file_id, f"inline:{i}:{j}:{n}", n, *own, p, as_text(npi))


def _rows(items: DataFrame, columns: Sequence[str], each, schema: pa.Schema, ddl: str) -> DataFrame:
    """What ``each`` makes of (file_id, i, the parsed columns...) of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for f, i, *texts_ in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.extend(each(f, i, *map(parse, texts_)))
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return items.select("file_id", F.col("i").cast("long"), *columns).mapInArrow(run, ddl)


def is_capitation() -> Column:
    return F.coalesce(F.col("negotiation_arrangement"), F.lit("")) == "capitation"


def _valued(rows: DataFrame) -> DataFrame:
    value = F.when(F.col("is_number"), F.col("raw").try_cast("double"))
    rows = rows.withColumn("negotiated_rate", value).withColumnRenamed("raw", "negotiated_rate_raw").withColumn("rate_unit", rate_unit(F.col("negotiated_type")))
    return rows.withColumn("is_zero_rate", F.col("negotiated_rate") == 0).drop("is_number")


def rate_rows(items: DataFrame) -> DataFrame:
    """Grain (file, i, j, k, r): price rows with exact text and value of the rate; text that is no JSON number has no value.

    Capitation items, which have no price per service, are left out: ``capitation_rates`` has them.
    """
    return _valued(_rows(items.filter(~is_capitation()), ["negotiated_rates"], item_rates, RATE_SCHEMA, RATE_DDL))


def oddities(items: DataFrame) -> DataFrame:
    """(file_id, type, key, json_path, detail): the anomaly log of the items' rates, of text too that is no JSON."""
    log = _rows(items, ["negotiated_rates"], item_oddities, ODD_SCHEMA, ", ".join(f"{f.name} string" for f in ODD_SCHEMA))
    read = _rows(items.filter("trim(negotiated_rates) not in ('', 'null')"), ["negotiated_rates"], lambda f, i, v: [] if v is not None else [(f, "malformed_json", None, f"in_network[{i}].negotiated_rates", "")], ODD_SCHEMA, ", ".join(f"{f.name} string" for f in ODD_SCHEMA))
    return log.unionByName(read)


def of_codes(items: DataFrame, codes: Sequence[str], code_type: str) -> DataFrame:
    """Items of the configured codes; the type must agree too."""
    return items.filter(F.col("billing_code").isin(list(codes)) & (F.col("billing_code_type") == code_type))


def _targets(services: object, codes: Sequence[str], code_type: str) -> list[str]:
    rows = [s for s in listed(services) if isinstance(s, dict)]
    return sorted({c for s in rows if (c := as_text(s.get("billing_code"))) in codes and as_text(s.get("billing_code_type")) == code_type})


CAPITATED = [("covered_target_codes", pa.list_(pa.string())), ("n_covered_services", pa.int64())]
CAPITATED_DDL = "covered_target_codes array<string>, n_covered_services long"


def capitation_items(items: DataFrame, codes: Sequence[str], code_type: str) -> DataFrame:
    """(file_id, i, covered_target_codes, n_covered_services) of capitation items of any code."""

    def each(f: str, i: int, services: object) -> Iterator[tuple]:
        yield f, i, _targets(services, codes, code_type), len(listed(services))

    schema = pa.schema([("file_id", pa.string()), ("i", pa.int64()), *CAPITATED])
    return _rows(items.filter(is_capitation()), ["covered_services"], each, schema, f"file_id string, i long, {CAPITATED_DDL}")


def capitation_rates(items: DataFrame, codes: Sequence[str], code_type: str) -> DataFrame:
    """The price rows of capitation items of any code, with what they cover of the configured codes."""

    def each(f: str, i: int, rates: object, services: object) -> Iterator[tuple]:
        own = (_targets(services, codes, code_type), len(listed(services)))
        for row in item_rates(f, i, rates):
            yield (*row, *own)

    rows = _rows(items.filter(is_capitation()), ["negotiated_rates", "covered_services"], each, pa.schema([*RATE_SCHEMA, *CAPITATED]), f"{RATE_DDL}, {CAPITATED_DDL}")
    return _valued(rows)


def covered_services(items: DataFrame, codes: Sequence[str], code_type: str) -> DataFrame:
    """(file_id, i, c, billing_code_type, billing_code_type_version, billing_code, description, is_target_code) of capitation items."""

    def each(f: str, i: int, services: object) -> Iterator[tuple]:
        for c, s in enumerate(listed(services)):
            if isinstance(s, dict):
                kind, version, code, text = (as_text(s.get(k)) for k in KNOWN["service"])
                yield f, i, c, kind, version, code, text, code in codes and kind == code_type

    schema = pa.schema([("file_id", pa.string()), ("i", pa.int64()), ("c", pa.int64()), *[(k, pa.string()) for k in KNOWN["service"]], ("is_target_code", pa.bool_())])
    ddl = f"file_id string, i long, c long, {', '.join(f'{k} string' for k in KNOWN['service'])}, is_target_code boolean"
    return _rows(items.filter(is_capitation()), ["covered_services"], each, schema, ddl)


def canonical_json(text: str | None) -> str | None:
    """Sorted keys, no spaces, number text as it stands: equal values have equal text."""
    v = parse(text)
    return None if v is None else dump(v)


TIN = [f"tin_{k}" for k in KNOWN["tin"]]


def reference_groups(references: DataFrame) -> DataFrame:
    """(file_id, m, provider_group_id, network_name, n, tin..., p, npi): the NPIs of the groups of each reference."""
    g = references.filter("provider_group_id is not null").select("file_id", "m", "provider_group_id", "network_name", F.posexplode("provider_groups").alias("n", "g"))
    tin = [F.col(f"g.tin.{c}").alias(f"tin_{c}") for c in KNOWN["tin"]]
    return g.filter("g is not null").select("file_id", "m", "provider_group_id", "network_name", "n", *tin, F.posexplode("g.npi").alias("p", "npi"))


def group_rows(items: DataFrame, references: DataFrame) -> DataFrame:
    """``reference_groups`` and, under the ids that rates carry, the groups that stand inside rates, which have no m and no network."""
    schema = pa.schema([("file_id", pa.string()), ("provider_group_id", pa.string()), ("n", pa.int32()), *[(c, pa.string()) for c in TIN], ("p", pa.int32()), ("npi", pa.string())])
    ddl = f"file_id string, provider_group_id string, n int, {', '.join(f'{c} string' for c in TIN)}, p int, npi string"
    return reference_groups(references).unionByName(_rows(items, ["negotiated_rates"], item_groups, schema, ddl), allowMissingColumns=True)


def reference_oddities(references: DataFrame) -> DataFrame:
    """The anomaly log of provider references: without an id, elsewhere, without TIN or NPIs, NPIs that are none."""
    at = F.format_string("provider_references[%d]", "m")
    log = lambda rows, kind, key, path, detail="": rows.select("file_id", F.lit(kind).alias("type"), F.lit(key).alias("key"), path.alias("json_path"), (detail if not isinstance(detail, str) else F.lit(detail)).alias("detail"))
    groups = references.select("file_id", "m", F.posexplode("provider_groups").alias("n", "g")).filter("g is not null")
    here = F.concat(at, F.format_string(".provider_groups[%d]", "n"))
    npis = groups.select("file_id", "m", "n", F.posexplode("g.npi").alias("p", "npi"))
    parts = [
        log(references.filter("provider_group_id is null"), "missing_provider_group_id", "provider_group_id", at),
        log(references.filter("location is not null"), "remote_provider_reference", "location", at, F.col("location")),
        log(groups.filter("g.tin is null or coalesce(g.tin.type, g.tin.value, g.tin.business_name) is null"), "missing_tin", "tin", here),
        log(groups.filter("g.npi is null or size(g.npi) = 0"), "missing_npi", "npi", here),
        log(npis.filter(~valid_npi(F.col("npi"))), "npi_not_10_digits", "npi", F.concat(here, F.format_string(".npi[%d]", "p")), F.coalesce("npi", F.lit(""))),
    ]
    return reduce(DataFrame.unionByName, parts)


def undefined_log(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """The anomaly log of groups that rates name but nothing defines, one row each."""
    gone = rates.filter("provider_group_id is not null").select("file_id", "provider_group_id").distinct().join(groups, ["file_id", "provider_group_id"], "left_anti")
    path = F.lit("in_network[*].negotiated_rates[*].provider_references")
    return gone.select("file_id", F.lit("undefined_provider_group").alias("type"), F.col("provider_group_id").alias("key"), path.alias("json_path"), F.lit("").alias("detail"))


COUNTERS = (
    "n_provider_references", "n_provider_group_npi_rows_total", "n_in_network_items", "n_items_matched", "n_price_rows", "n_zero_price_rows", "n_rate_rows", "n_groups_referenced",
    "n_provider_group_npi_rows_kept", "n_capitation_items", "n_capitation_items_with_target_codes", "n_capitation_rows", "n_capitation_covered_services", "n_anomalies",
)


def file_counts(items: DataFrame, references: DataFrame, codes: Sequence[str], code_type: str) -> DataFrame:
    """COUNTERS of each file: what it holds, what of it has the configured codes, what was made of it."""
    one = lambda name: F.count(F.lit(1)).alias(name)
    paid = of_codes(items.filter(~is_capitation()), codes, code_type)
    rates, capitated, groups = rate_rows(paid), capitation_rates(items, codes, code_type), group_rows(items, references)
    named = rates.select("file_id", "provider_group_id").unionByName(capitated.select("file_id", "provider_group_id")).distinct()
    prices = rates.groupBy("file_id", "i", "j", "k").agg(F.any_value("is_zero_rate").alias("zero"))
    odd = reduce(DataFrame.unionByName, [oddities(items), reference_oddities(references), undefined_log(named, groups)])
    every = [
        references.groupBy("file_id").agg(one("n_provider_references")), groups.groupBy("file_id").agg(one("n_provider_group_npi_rows_total")),
        items.groupBy("file_id").agg(one("n_in_network_items"), F.count_if(is_capitation()).alias("n_capitation_items")), paid.groupBy("file_id").agg(one("n_items_matched")),
        prices.groupBy("file_id").agg(one("n_price_rows"), F.count_if("zero").alias("n_zero_price_rows")), rates.groupBy("file_id").agg(one("n_rate_rows")),
        named.groupBy("file_id").agg(one("n_groups_referenced")), groups.join(named, ["file_id", "provider_group_id"], "left_semi").groupBy("file_id").agg(one("n_provider_group_npi_rows_kept")),
        capitation_items(items, codes, code_type).groupBy("file_id").agg(F.count_if(F.size("covered_target_codes") > 0).alias("n_capitation_items_with_target_codes")),
        capitated.groupBy("file_id").agg(one("n_capitation_rows")), covered_services(items, codes, code_type).groupBy("file_id").agg(one("n_capitation_covered_services")),
        odd.groupBy("file_id").agg(one("n_anomalies")),
    ]
    # one row per file and counter, then one per file: a single shuffle of counts instead of a join for each
    long = reduce(DataFrame.unionByName, [e.select("file_id", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in e.columns[1:]])).alias("x")) for e in every])
    return long.select("file_id", "x.*").groupBy("file_id").agg(*[F.coalesce(F.sum(F.when(F.col("name") == c, F.col("n"))), F.lit(0)).alias(c) for c in COUNTERS])
