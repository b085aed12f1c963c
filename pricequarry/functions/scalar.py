"""Column expressions that several plans share. All are built-in expressions: no Python at run time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that holds; a rule that is null doesn't."""
    out = F.when(F.coalesce(rules[0][0], F.lit(False)), rules[0][1])
    for cond, label in rules[1:]:
        out = out.when(F.coalesce(cond, F.lit(False)), label)
    return out.otherwise(F.lit(default))


def lookup(key: Column, values: Mapping[str, str], default: str | None = None) -> Column:
    """The mapped value of a text key; ``default`` for other keys and null."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(key, F.lit("\0"))), F.lit(default))


# Unit of each kind of negotiated price.
RATE_UNITS = {"negotiated": "dollars", "derived": "dollars", "fee schedule": "dollars", "percentage": "percent_of_billed_charges", "per diem": "dollars_per_day"}


def rate_unit(negotiated_type: Column) -> Column:
    return lookup(negotiated_type, RATE_UNITS, "unknown")


def valid_npi(npi: Column) -> Column:
    """Ten ASCII digits and nothing else; null is not valid."""
    return F.coalesce(npi.rlike(r"\A[0-9]{10}\z"), F.lit(False))


def iso_date(text: Column) -> Column:
    """The date that text of the form yyyy-m-d begins with, else null; a bare year is no date."""
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), text.try_cast("date"))


def expired(text: Column, snapshot: Column) -> Column:
    return F.coalesce(iso_date(text) < snapshot, F.lit(False))


def place_group(codes: Column) -> Column:
    """What kind of place a list of place codes covers."""
    has = lambda *xs: F.arrays_overlap(F.array_compact(codes), F.array(*[F.lit(x) for x in xs]))
    return first_match([(has("11") & has("22", "19"), "all_settings"), (has("11"), "non_facility"), (has("22", "19"), "facility")], "unspecified")


def sorted_union(lists: Column) -> Column:
    """Distinct non-null elements of many lists in order; null if there is none."""
    every = F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.array_compact(lists)))))
    return F.when(F.size(every) > 0, every)


def zero_padded(text: Column, width: int) -> Column:
    """Left-padded with zeros; longer text stays whole."""
    t = F.trim(text)
    return F.when(F.length(t) >= width, t).otherwise(F.lpad(t, width, "0"))


def literal_contains(text: Column, part: str) -> Column:
    """Whether upper-cased text contains the upper-cased part; % and _ have no meaning, null doesn't contain it."""
    return F.coalesce(F.upper(text).contains(part.strip().upper()), F.lit(False))


def file_key(url: Column) -> Column:
    """A signed URL without its query."""
    return F.split_part(url, F.lit("?"), F.lit(1))


def file_id(url: Column) -> Column:
    return F.left(F.sha1(file_key(url)), F.lit(12))


def base_name(url: Column) -> Column:
    return F.regexp_extract(file_key(url), r"([^/]*)\z", 1)


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def price_path(i: str = "i", j: str = "j", k: str = "k") -> Column:
    return F.format_string("in_network[%d].negotiated_rates[%d].negotiated_prices[%d]", i, j, k)


def npi_path(m: str = "m", n: str = "n", p: str = "p") -> Column:
    """Null where the group stands inside its price, without a position of its own."""
    return F.when(F.col(m).isNotNull(), F.format_string("provider_references[%d].provider_groups[%d].npi[%d]", m, n, p))


def primary_code(codes: Column, switches: Column) -> Column:
    """(code, rule) of parallel code and switch lists: the one switched on, else the only one; else none."""
    pairs = F.filter(F.arrays_zip(codes.alias("c"), switches.alias("s")), lambda x: F.coalesce(x["c"], F.lit("")) != "")
    on = F.filter(pairs, lambda x: F.coalesce(x["s"], F.lit("")) == "Y")
    code = F.when(F.size(on) == 1, F.try_element_at(on, F.lit(1))["c"]).when((F.size(on) == 0) & (F.size(pairs) == 1), F.try_element_at(pairs, F.lit(1))["c"])
    rule = F.when(F.coalesce(F.size(pairs), F.lit(0)) == 0, "none").when(F.size(on) == 1, "switch_Y").when((F.size(on) == 0) & (F.size(pairs) == 1), "only_code")
    return F.struct(code.alias("code"), rule.otherwise("ambiguous").alias("rule"))


def display_name(entity: Column, org: Column, *parts: Column) -> Column:
    """An organisation's name, or a person's parts joined; null if nothing is left."""
    return F.nullif(F.when(entity == "2", org).otherwise(F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])), F.lit(""))


BANDS = (20.0, 40.0, 60.0, 80.0, 95.0)


def percentile_band(pct: Column) -> Column:
    """0 to 5, by the limits in BANDS; null stays null."""
    out = F.when(pct.isNull(), F.lit(None).cast("int"))
    for n, limit in enumerate(BANDS):
        out = out.when(pct < limit, n)
    return out.otherwise(len(BANDS))


def finite(v: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
