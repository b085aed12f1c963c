"""Deeply nested records as related flat tables.

A record's text is read as a stream of triples (path, ordinals, value): the path names the repeated ancestors, the ordinals
hold the position in each. Only declared paths are descended; what lies below or beside them is one leaf, and no more than a
leaf is ever held as a value, however large the record. Triples are grouped by their nearest repeated ancestor, which is one
child row, and its leaves are pivoted into that row's attributes; each kind of rows is then a table of its own. That paths are
declared also makes a lone value in place of a list a list of one, and like named keys elsewhere in a record give no rows. All
of it happens within the record: no shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact


class Number(str):
    """The text of a JSON number, as it stands in the source."""

    __slots__ = ()


def parse(text: str | None) -> object:
    """The JSON value with exact number text; None for null, blank or malformed text."""
    if not text or text.isspace():
        return None
    try:
        return json.loads(text, parse_int=Number, parse_float=Number, parse_constant=Number)
    except (ValueError, RecursionError):
        return None


def listed_at(v: object) -> list:
    """A list as it is, null as an empty one, any other value as a list of one."""
    return v if isinstance(v, list) else [] if v is None else [v]


@dataclass(frozen=True)
class Repeated:
    """A repeated path below a record: its kind, whether its elements are objects, what to read as key."""

    kind: str
    objects: bool
    key: str | None = None  # a field of the object; scalars are their own key


def dump(v: object) -> str:
    """JSON text with sorted keys and no spaces, numbers as they stood."""
    if isinstance(v, Number):
        return str(v)
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{dump(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(dump, v)) + "]"
    return json.dumps(v, ensure_ascii=False)


def as_text(v: object) -> str | None:
    """Text as it is, numbers and truth values as they stood, objects and lists as JSON; null, and what is nested too deeply
    to be written, is None."""
    if v is None:
        return None
    if v is True or v is False:
        return "true" if v else "false"
    if isinstance(v, str):
        return str(v)
    try:
        return dump(v)
    except RecursionError:
        return None


SPACE = re.compile(r"[ \t\r\n]*")
KEY = re.compile(r'"((?:[^"\\\x00-\x1f]|\\.)*)"[ \t\r\n]*:[ \t\r\n]*')
AFTER = re.compile(r"[ \t\r\n]*([,\]}])[ \t\r\n]*")
BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]')
SCAN = json.JSONDecoder(parse_int=Number, parse_float=Number, parse_constant=Number).scan_once
SELF, TWICE = "\0self", "\0twice"


def leaf_at(text: str, at: int) -> tuple[object, int]:
    """The value that begins at ``at`` and where it ends; one nested too deeply for the decoder is its own text."""
    try:
        return SCAN(text, at)
    except StopIteration:
        raise ValueError(f"no value at {at}") from None
    except RecursionError:
        depth = 0
        for m in BRACKETS.finditer(text, at):
            depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(m.group(), 0)
            if not depth:
                return text[at : m.end()], m.end()
        raise ValueError(f"a value that begins at {at} isn't closed") from None


def _after(text: str, at: int, closing: str) -> tuple[int, bool]:
    m = AFTER.match(text, at)
    if not m or m.group(1) not in ("," + closing):
        raise ValueError(f"neither ',' nor '{closing}' at {at}")
    return m.end() if m.group(1) == "," else m.end(1), m.group(1) != ","


class Walk:
    """Reads triples (repeated path, ordinals, leaf below it, value) from the text of a record, in document order.

    The element itself comes as leaf SELF before what is below it. A repeated key that stands twice in an object is announced
    as TWICE before its second list, which replaces the first.
    """

    def __init__(self, repeated: Mapping[str, Repeated]) -> None:
        self.repeated = repeated

    def triples(self, text: str, path: str) -> Iterator[tuple[str, tuple[int, ...], str, object]]:
        at = yield from self._listed(text, SPACE.match(text).end(), path, ())
        if SPACE.match(text, at).end() < len(text):
            raise ValueError(f"text after the value at {at}")

    def _listed(self, text: str, at: int, path: str, ordinals: tuple[int, ...]):
        if text[at : at + 1] != "[":
            return (yield from self._element(text, at, path, (*ordinals, 0)))
        at = SPACE.match(text, at + 1).end()
        if text[at : at + 1] == "]":
            return at + 1
        n, ended = 0, False
        while not ended:
            at = yield from self._element(text, at, path, (*ordinals, n))
            at, ended = _after(text, at, "]")
            n += 1
        return at

    def _element(self, text: str, at: int, path: str, here: tuple[int, ...]):
        rule = self.repeated[path]
        if not rule.objects or text[at : at + 1] != "{":
            v, at = leaf_at(text, at)
            if not rule.objects and v is not None and not isinstance(v, (dict, list)):
                yield path, here, SELF, v
            return at
        yield path, here, SELF, None
        at = SPACE.match(text, at + 1).end()
        if text[at : at + 1] == "}":
            return at + 1
        ended, met = False, set()
        while not ended:
            if not (m := KEY.match(text, at)):
                raise ValueError(f"no key at {at}")
            key = json.loads(f'"{m.group(1)}"') if "\\" in m.group(1) else m.group(1)
            below = f"{path}.{key}"
            if below in self.repeated:
                if below in met:
                    yield below, here, TWICE, None
                met.add(below)
                at = yield from self._listed(text, m.end(), below, here)
            else:
                v, at = leaf_at(text, m.end())
                yield path, here, key, v
            at, ended = _after(text, at, "}")
        return at


OUT = pa.schema(
    [
        pa.field("record", pa.int64()),
        pa.field("path", pa.string()),
        pa.field("kind", pa.string()),
        pa.field("ordinals", pa.list_(pa.int32())),
        pa.field("key", pa.string()),
        pa.field("attributes", pa.map_(pa.string(), pa.string())),
    ]
)


UNREADABLE = "unreadable"


def child_rows(text: str | None, repeated: Mapping[str, Repeated], path: str) -> list[tuple]:
    """(path, kind, ordinals, key, attributes) of every repeated element, in document order; of text that isn't JSON one row of
    the kind UNREADABLE, with the reason as key."""
    if not text or text.isspace():
        return []
    rows: dict[tuple, list] = {}
    try:
        for at, ordinals, leaf, v in Walk(repeated).triples(text, path):
            rule = repeated[at]
            if leaf == SELF:
                rows[at, ordinals] = [at, rule.kind, list(ordinals), "" if rule.objects else as_text(v) or "", {}]
            elif leaf == TWICE:
                for k in [k for k in rows if (k[0] == at or k[0].startswith(f"{at}.")) and k[1][: len(ordinals)] == ordinals]:
                    del rows[k]
            else:
                row = rows[at, ordinals]
                row[4][leaf] = as_text(v)
                if leaf == rule.key:
                    row[3] = as_text(v) or ""
    except ValueError as e:
        return [(path, UNREADABLE, [], str(e), {})]
    return [tuple(r) for r in rows.values()]


def flatten(df: DataFrame, ids: Sequence[str], column: str, path: str, repeated: Mapping[str, Repeated]) -> DataFrame:
    """One row per repeated element of the JSON text in ``column``: ids, path, kind, ordinals, key, attributes.

    Null or blank text gives no row, malformed text one of the kind 'unreadable' with the reason as key; nulls and elements of
    the wrong shape give none but keep their position; of a key that stands twice in an object the last counts; a record that
    stands twice gives its rows twice. Number text is kept as it stands; a leaf nested too deeply for the decoder is its text.
    """
    names = [f"id{n}" for n in range(len(ids))]
    df = exact(df, [*ids, column])
    src = df.select(*[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(ids, names, strict=True)], F.col(f"`{column}`").alias("body"))
    schema = pa.schema([*[pa.field(n, pa.string()) for n in names], *list(OUT)[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, at, rows = batch.column(len(names)).to_pylist(), [], []
            for n, text in enumerate(bodies):
                for row in child_rows(text, repeated, path):
                    at.append(n)
                    rows.append(row)
                if len(rows) >= 20_000:
                    yield build(batch, at, rows)
                    at, rows = [], []
            if rows:
                yield build(batch, at, rows)

    def build(batch: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
        take = pa.array(at, pa.int32())
        own = [batch.column(n).take(take) for n in range(len(names))]
        cols = [pa.array([r[n] for r in rows], f.type) for n, f in enumerate(list(OUT)[1:-1])]
        maps = pa.array([list(r[4].items()) for r in rows], OUT.field("attributes").type)
        return pa.RecordBatch.from_arrays([*own, *cols, maps], schema=schema)

    ddl = ", ".join(f"{n} string" for n in names) + ", path string, kind string, ordinals array<int>, key string, attributes map<string,string>"
    return src.mapInArrow(run, ddl).select(*[F.col(n).alias(c) for n, c in zip(names, ids, strict=True)], "path", "kind", "ordinals", "key", "attributes")


# What repeats in an item of a price file and in a provider reference.
RATES = {
    "negotiated_rates": Repeated("rate", True),
    "negotiated_rates.negotiated_prices": Repeated("price", True),
    "negotiated_rates.provider_references": Repeated("reference", False),
    "negotiated_rates.provider_groups": Repeated("inline_group", True),
    "negotiated_rates.provider_groups.npi": Repeated("inline_npi", False),
}
GROUPS = {"provider_groups": Repeated("group", True), "provider_groups.npi": Repeated("npi", False)}
SERVICES = {"covered_services": Repeated("covered_service", True, "billing_code")}


def full_path(root: str, index: str) -> F.Column:
    """`root[i].a[0].b[1]` of the columns path and ordinals and of the record's own position."""
    steps = F.zip_with(F.split("path", r"\."), "ordinals", lambda s, n: F.concat(s, F.lit("["), n.cast("string"), F.lit("]")))
    own = F.concat(F.lit(f"{root}["), F.coalesce(F.col(index).cast("string"), F.lit("")), F.lit("]"))
    return F.concat_ws(".", own, F.array_join(steps, "."))


def item_children(in_network: DataFrame) -> DataFrame:
    """Rates, prices, references, inline groups and NPIs and covered services of in_network, with path and parent's path."""
    both = flatten(in_network, ["file_id", "i"], "negotiated_rates", "negotiated_rates", RATES).unionByName(
        flatten(in_network, ["file_id", "i"], "covered_services", "covered_services", SERVICES)
    )
    out = both.withColumn("child_path", full_path("in_network", "i"))
    return out.select("file_id", "i", "kind", "child_path", parent_path().alias("parent_path"), "ordinals", "key", "attributes")


def parent_path() -> F.Column:
    return F.regexp_replace("child_path", r"\.[^.]*\z", "")


def group_npis(provider_references: DataFrame) -> DataFrame:
    """Groups and NPIs of provider_references.provider_groups, with path and parent's path: null groups and NPIs give no row but
    keep their position."""
    provider_references = exact(provider_references, ["file_id", "m", "provider_group_id", "provider_groups"])
    src = provider_references.withColumn("provider_groups", F.to_json("provider_groups"))
    out = flatten(src, ["file_id", "m", "provider_group_id"], "provider_groups", "provider_groups", GROUPS)
    out = out.withColumn("child_path", full_path("provider_references", "m"))
    return out.select("file_id", "m", "provider_group_id", "kind", "child_path", parent_path().alias("parent_path"), "ordinals", "key", "attributes")


def children(in_network: DataFrame, provider_references: DataFrame) -> DataFrame:
    """(file_id, child_kind, child_path, child_key) of every child, repeated rows once."""
    kinds = ["price", "reference", "inline_npi", "covered_service"]
    items = item_children(in_network).filter(F.col("kind").isin(kinds)).select("file_id", F.col("kind").alias("child_kind"), "child_path", F.col("key").alias("child_key"))
    npis = group_npis(provider_references).filter("kind = 'npi'").select("file_id", F.lit("npi").alias("child_kind"), "child_path", F.col("key").alias("child_key"))
    return items.unionByName(npis).distinct()


def pivoted(rows: DataFrame, kinds: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One table of the rows of some kinds: position path, parent's path and the named attributes as columns, repeated rows once."""
    return rows.filter(F.col("kind").isin(list(kinds))).select("file_id", "child_path", "parent_path", *[F.col("attributes")[x].alias(x) for x in names], "kind", "key").distinct()


def price_table(in_network: DataFrame) -> DataFrame:
    """The price rows with their attributes as columns (lists as JSON text), keyed by position path."""
    names = ["negotiated_type", "negotiated_rate", "expiration_date", "billing_class", "setting", "service_code", "billing_code_modifier", "additional_information"]
    return pivoted(item_children(in_network), ["price"], names).drop("kind", "key")


def reference_table(in_network: DataFrame) -> DataFrame:
    """The references of rates to groups: the id, and the path of the rate it stands in."""
    return pivoted(item_children(in_network), ["reference"], []).drop("kind").withColumnRenamed("key", "provider_group_id")


def service_table(in_network: DataFrame) -> DataFrame:
    """The covered services of items."""
    return pivoted(item_children(in_network), ["covered_service"], ["billing_code_type", "billing_code_type_version", "billing_code", "description"]).drop("kind", "key")


def npi_table(in_network: DataFrame, provider_references: DataFrame) -> DataFrame:
    """The NPIs of groups, inside rates and in references, with the path of the group (see ``group_table``)."""
    rows = item_children(in_network).select(*CHILD).unionByName(group_npis(provider_references).select(*CHILD))
    return pivoted(rows, ["inline_npi", "npi"], []).withColumnRenamed("key", "npi")


def group_table(in_network: DataFrame, provider_references: DataFrame) -> DataFrame:
    """The groups inside rates and in references with their TIN."""
    rows = item_children(in_network).select(*CHILD).unionByName(group_npis(provider_references).select(*CHILD))
    out = pivoted(rows, ["inline_group", "group"], ["tin"]).drop("key")
    part = lambda x: F.get_json_object("tin", f"$.{x}").alias(f"tin_{x}")
    return out.select("file_id", "child_path", "parent_path", "kind", part("type"), part("value"), part("business_name"))


CHILD = ["file_id", "kind", "child_path", "parent_path", "key", "attributes"]
