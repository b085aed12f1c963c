"""JSON records whose fields drift from file to file: one consistent table per record kind, and a log of every change.

Records are read in parallel into (record, field, type, value) rows; per file they are reduced to a header (field -> set of
types), which is folded in file order through the promotion lattice

    null < boolean < string,  null < number < string,  scalar < array

to the union schema. Headers are compared by windows over (feed, kind, field), so a feed with very many files is a stream of
small rows, never one object. A removed and an added field of the same file are one renamed field if the records common to
both files (by key) carry their values on; only values of such fields are joined, spread over records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricequarry.functions.columns import distinct_names, exact
from pricequarry.session import cut
from pricequarry.sources.nested import Number, as_text, listed_at, parse

GROUP = ["feed", "record_kind"]
FILE = [*GROUP, "file_date", "file_id"]


def json_type(v: object) -> str | None:
    if v is None:
        return None
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, Number):
        return "number"
    return "array" if isinstance(v, list) else "string"


def leaves(record: object, prefix: str = "") -> Iterator[tuple[str, object]]:
    """Fields of an object; those of objects inside as object.field, the objects themselves not."""
    if isinstance(record, dict):
        for k, v in record.items():
            if isinstance(v, dict):
                yield from leaves(v, f"{prefix}{k}.")
            else:
                yield f"{prefix}{k}", v


MOST_FILES = 100_000  # files whose fields in question are sent to the tasks; of more, records are joined with them


def record_fields(
    df: DataFrame, body: str = "body", keys: Sequence[Sequence[str]] = (("i", "j", "k", "r"), ("row",)), only: DataFrame | None = None
) -> DataFrame:
    """(feed, record_kind, file_date, file_id, rec_key, field, type, value), one row per field of each record; with ``only`` (feed,
    record_kind, file_id, fields) just of these files and fields.

    rec_key: the values of the first of ``keys`` of which the record has any, else null. Null, malformed or non-object bodies
    give no rows. A field name that stands twice in an object has its last value.
    """
    df = exact(df, [*FILE, body])
    ids = [F.col(c).cast("string").alias(c) for c in FILE]
    rows = df.select(*ids, F.col(body).alias("_body"), F.lit(None).cast("array<string>").alias("fields"))
    if only is not None:
        some = F.broadcast(only) if only.count() <= MOST_FILES else only
        rows = rows.drop("fields").join(some, [*GROUP, "file_id"]).select(*FILE, "_body", "fields")
    names = [*FILE, "rec_key", "field", "type", "value"]
    schema = pa.schema([pa.field(n, pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            cols: list[list] = [[], [], [], []]
            for n, (text, asked) in enumerate(zip(batch.column(len(FILE)).to_pylist(), batch.column(len(FILE) + 1).to_pylist(), strict=True)):
                record = parse(text)
                if not isinstance(record, dict):
                    continue
                key = next((json_key([record.get(x) for x in k]) for k in keys if any(x in record for x in k)), None)
                for field, v in leaves(record):
                    if asked is not None and field not in asked:
                        continue
                    at.append(n)
                    for c, x in zip(cols, (key, field, json_type(v), as_text(v)), strict=True):
                        c.append(x)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(take) for n in range(len(FILE))], *[pa.array(c, pa.string()) for c in cols]], schema=schema)

    ddl = ", ".join(f"{n} string" for n in names)
    return rows.mapInArrow(run, ddl)


def json_key(values: list) -> str:
    return "\x1f".join(as_text(v) or "" for v in values)


def file_order(files: DataFrame) -> DataFrame:
    """The files of each feed and record kind by date (then id), numbered from 1, each with the one that follows."""
    w = Window.partitionBy(*GROUP).orderBy("file_date", "file_id")
    return files.select(*FILE, F.row_number().over(w).alias("seq"), F.lead("file_id").over(w).alias("next_file"))


def headers(df: DataFrame, body: str = "body") -> DataFrame:
    """Per file and field the sorted set of JSON types of its non-null values (empty: only nulls); a row without field per file.

    Tasks reduce their records to one row per file and field before anything is shuffled.
    """
    ids = [F.col(c).cast("string").alias(c) for c in FILE]
    schema = pa.schema([*[pa.field(n, pa.string()) for n in (*FILE, "field")], pa.field("types", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, dict[str | None, set[str]]] = {}
            for *own, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                fields = seen.setdefault(tuple(own), {None: set()})
                record = parse(text)
                if isinstance(record, dict):
                    for field, v in leaves(record):
                        types = fields.setdefault(field, set())
                        if v is not None:
                            types.add(json_type(v))
            rows = [(*own, field, sorted(types)) for own, fields in seen.items() for field, types in fields.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    ddl = ", ".join(f"{n} string" for n in (*FILE, "field")) + ", types array<string>"
    parts = df.select(*ids, F.col(body)).mapInArrow(run, ddl)
    return parts.groupBy(*FILE, "field").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"))


def _matched(pairs: pa.Table) -> pa.Table:
    """The renames among the qualifying pairs of one file: each old field's best new one, of these each new field's best old
    one, and again among the fields that are left."""
    ranked = sorted(zip((-n for n in pairs["n_same"].to_pylist()), pairs["old_field"].to_pylist(), pairs["new_field"].to_pylist(), range(len(pairs)), strict=True))
    keep: list[int] = []
    while ranked:
        by_old: dict[str, tuple] = {}
        for p in ranked:
            by_old.setdefault(p[1], p)
        by_new: dict[str, tuple] = {}
        for p in sorted(by_old.values()):
            by_new.setdefault(p[2], p)
        keep += [p[3] for p in by_new.values()]
        old = {p[1] for p in by_new.values()}
        ranked = [p for p in ranked if p[1] not in old and p[2] not in by_new]
    return pairs.take(pa.array(keep, pa.int64())).drop_columns(["n_same"])


def schema_changes(df: DataFrame, body: str = "body", agree: float = 0.9, at_least: int = 2) -> DataFrame:
    """(feed, record_kind, file_id, change, old_field, new_field) of each file against the one before, by file_date.

    change: 'added', 'removed', 'renamed' or 'type_changed' (types differ from the latest earlier file in which the field has
    non-null values). A rename needs ``at_least`` records whose old and new values are both non-null, of which a share of
    ``agree`` is equal; among rivals for a name the one with most equal values wins, and losers are matched among themselves until
    no pair is left. The first file of a feed has no changes.
    Repeated records count once; late files stand where their date puts them.
    """
    df = exact(df, [*FILE, body])
    seen = cut(headers(df, body))  # one row per file and field: small, and read by all that follows
    files = file_order(seen.filter("field is null"))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"f.{c}")) for c in FILE]
    head = seen.filter("field is not null").alias("h").join(files.alias("f"), same).select("h.*", "seq", "next_file")
    w = Window.partitionBy(*GROUP, "field").orderBy("seq")
    known = F.when(F.size("types") > 0, F.col("types"))
    head = (
        head.withColumn("before", F.lag("seq").over(w))
        .withColumn("after", F.lead("seq").over(w))
        .withColumn("types_before", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    )
    head = cut(head)
    added = head.filter((F.col("seq") > 1) & (F.coalesce(F.col("before"), F.lit(0)) < F.col("seq") - 1))
    added = added.select(*GROUP, "file_id", F.col("field").alias("new_field"), "seq")
    removed = head.filter(F.col("next_file").isNotNull() & (F.coalesce(F.col("after"), F.lit(0)) != F.col("seq") + 1))
    removed = removed.select(*GROUP, F.col("file_id").alias("last_file"), F.col("next_file").alias("file_id"), F.col("field").alias("old_field"), (F.col("seq") + 1).alias("seq"))
    changed = head.filter(known.isNotNull() & F.col("types_before").isNotNull() & (F.col("types") != F.col("types_before")))
    changed = changed.select(*GROUP, "file_id", F.lit("type_changed").alias("change"), F.col("field").alias("old_field"), F.lit("").alias("new_field"))

    # only fields of files that lose one and gain another can be renamed
    both = [*GROUP, "file_id"]
    losing = removed.join(added.select(*both).distinct(), both, "left_semi")
    gaining = added.join(removed.select(*both).distinct(), both, "left_semi")
    asked = losing.select(*both, F.col("last_file").alias("in_file"), F.col("old_field").alias("field"), F.lit(True).alias("is_old"))
    asked = asked.unionByName(gaining.select(*both, F.col("file_id").alias("in_file"), F.col("new_field").alias("field"), F.lit(False).alias("is_old")))
    wanted = cut(asked.groupBy(*GROUP, F.col("in_file").alias("file_id")).agg(F.collect_set("field").alias("fields")))
    values = record_fields(df, body, only=wanted).filter("value is not null and rec_key is not null")
    values = values.select(*GROUP, F.col("file_id").alias("in_file"), "rec_key", "field", "value")
    hits = values.join(asked, [*GROUP, "in_file", "field"]).select(*both, "rec_key", "is_old", "field", "value").distinct()
    side = lambda old: F.collect_list(F.when(F.col("is_old") == old, F.struct("field", "value")))
    # one row per record: its lists are as long as the fields in question
    met = hits.groupBy(*both, "rec_key").agg(side(True).alias("old"), side(False).alias("new"))
    met = met.select(*both, F.explode("old").alias("o"), "new").select(*both, "o", F.explode("new").alias("n"))
    met = met.select(*both, F.col("o.field").alias("old_field"), F.col("n.field").alias("new_field"), F.col("o.value").alias("x"), F.col("n.value").alias("y"))
    pairs = met.groupBy(*both, "old_field", "new_field")
    pairs = pairs.agg(F.count(F.lit(1)).alias("n_both"), F.count_if(F.col("x") == F.col("y")).alias("n_same"))
    pairs = pairs.filter((F.col("n_same") >= at_least) & (F.col("n_same") >= agree * F.col("n_both")))
    # a file's pairs are few: fields removed and added at once whose values agree
    pairs = pairs.select(*both, "old_field", "new_field", "n_same").groupBy(*both).applyInArrow(_matched, ", ".join(f"{c} string" for c in (*both, "old_field", "new_field")))
    renamed = cut(pairs.select(*both, F.lit("renamed").alias("change"), "old_field", "new_field"))

    plus = added.join(renamed.drop("old_field", "change"), [*both, "new_field"], "left_anti")
    minus = removed.join(renamed.drop("new_field", "change"), [*both, "old_field"], "left_anti")
    plus = plus.select(*both, F.lit("added").alias("change"), F.lit("").alias("old_field"), "new_field")
    minus = minus.select(*both, F.lit("removed").alias("change"), "old_field", F.lit("").alias("new_field"))
    return plus.unionByName(minus).unionByName(renamed).unionByName(changed)


LATTICE = {frozenset(): "string", frozenset(["boolean"]): "boolean", frozenset(["number"]): "double"}


def promote(types: frozenset[str]) -> str:
    """The least type of the lattice that holds every given JSON type."""
    return "array<string>" if "array" in types else LATTICE.get(types, "string")


def field_types(df: DataFrame, body: str = "body") -> DataFrame:
    """(record_kind, field, types, n_files, n_values): the union schema before promotion."""
    head = record_fields(df, body).groupBy("record_kind", "field", "feed", "file_id").agg(F.collect_set("type").alias("types"), F.count("value").alias("n"))
    return head.groupBy("record_kind", "field").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"), F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_values")
    )


def unified(df: DataFrame, kind: str, body: str = "body", renames: DataFrame | None = None, max_fields: int = 5000) -> DataFrame:
    """The records of one kind as one table: the columns of ``df`` but the body, then every field under its promoted type.

    Fields of nested objects are named object.field with the dot as ``__``. A scalar in an array column is a list of one; text
    that is no number can't occur in a double column, since the lattice would have made it text. With ``renames`` (the log of
    ``schema_changes``) fields that were renamed into each other form one column, under the name with most values, first
    non-null value. Only the names of fields come to the driver; more than ``max_fields`` raises, while any number of renames
    is taken. Repeated records stay.
    """
    mine = distinct_names(df).filter(F.col("record_kind") == kind)
    found = field_types(mine, body).limit(max_fields + 1).collect()
    if len(found) > max_fields:
        raise ValueError(f"more than {max_fields} different fields: the drift log, not a wide table, is the answer here")
    types = {r.field: frozenset(r.types) for r in found}
    count = {r.field: r.n_values for r in found}
    head = {x: x for x in types}

    def root(x: str) -> str:
        while head[x] != x:
            x = head[x]
        return x

    if renames is not None:
        log = renames.filter((F.col("record_kind") == kind) & (F.col("change") == "renamed")).select("old_field", "new_field").distinct()
        for a, b in log.toLocalIterator():  # a part at a time; what is kept is bounded by the fields
            if a in head and b in head and root(a) != root(b):
                low, high = sorted((root(a), root(b)), key=lambda x: (count[x], x))
                head[low] = high
    classes: dict[str, list[str]] = {}
    for x in sorted(types, key=lambda x: (-count[x], x)):
        classes.setdefault(root(x), []).append(x)
    schema = {c: promote(frozenset().union(*(types[x] for x in xs))) for c, xs in sorted(classes.items())}
    owner = {x: c for c, xs in classes.items() for x in xs}

    own = [c for c in mine.columns if c != body]
    fmt = pa.schema([pa.field("doc", pa.map_(pa.string(), pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = []
            for text in batch.column(len(own)).to_pylist():
                doc: dict[str, str] = {}
                for field, v in leaves(parse(text)):
                    if v is not None and (c := owner[field]) not in doc:
                        doc[c] = json.dumps([as_text(x) for x in listed_at(v)]) if schema[c] == "array<string>" else as_text(v)
                docs.append(list(doc.items()))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in range(len(own))], pa.array(docs, fmt.field("doc").type)], names=[*own, "_doc"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mine.schema if f.name != body) + ", _doc map<string,string>"
    wide = mine.select(*own, body).mapInArrow(run, ddl)
    cols = []
    taken = {c.lower() for c in own}
    for c, kind_of in schema.items():
        v = F.col("_doc")[c]
        v = F.from_json(v, "array<string>") if kind_of == "array<string>" else v.try_cast(kind_of)
        name = c.replace(".", "__")
        while name.lower() in taken:  # another column or a field that differs in case only
            name += "_field"
        taken.add(name.lower())
        cols.append(v.alias(name))
    return wide.select(*own, *cols)
