"""CSV records of mixed quality: valid rows are loaded, the others kept with the reason for which they fail.

Every record is read permissively under the typed schema of its kind, with its raw text retained where a column is missing, is one
too many or can't be cast. What is read whole, holds no quote and meets the conditions of its columns is loaded as it is. Only
the rest is classified again, as text, by quoting, column count and cast checks, in this order; some of it turns out valid, such
as records with quoted fields. All of it is built-in expressions, one stage, no shuffle.

Quoting is judged on what is left when each quoted stretch, from a quote to the next, becomes one mark. A quote that is left
has no partner. A mark may stand beside commas, the ends and other marks (a doubled quote inside a field is where two
stretches meet), but not beside text. The commas that are left are the separators. Each step is a pattern without nested
repetition, so that no text, however long, exhausts the matcher's stack.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact

CORRUPT = "_corrupt_record"
# Noncharacters. The CSV reader drops NUL at the ends of a field, and U+FFFF ends its input: both are kept apart while it reads.
SPECIAL, STAND_INS = "\x00\uffff", "\ufdd0\ufdd1"
NO_NULL = "\ufdd2"  # what the reader takes for null: nothing
MARK = "\ufffe"  # stands for a quoted stretch


@dataclass(frozen=True)
class Field:
    """A column and the SQL condition, on ``{c}``, that its text must meet ('' stands for an empty field)."""

    name: str
    valid: str = "true"

    kind = "string"

    def read_well(self, at: str) -> str:
        """The condition on the typed value at ``at``."""
        return self.valid.format(c=f"coalesce({at}, '')")

    def typed(self, text: Column) -> Column:
        """The typed value of valid text; empty text is null."""
        return F.nullif(text, F.lit(""))


@dataclass(frozen=True)
class DateField(Field):
    """A column of real dates as MM/DD/YYYY; null where it may be empty and is."""

    optional: bool = False

    kind = "date"

    def __post_init__(self) -> None:
        shape = r"(rlike({c}, '\\A[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}\\z') and try_to_timestamp({c}, 'MM/dd/yyyy') is not null)"
        object.__setattr__(self, "valid", f"({{c}} = '' or {shape})" if self.optional else shape)

    def read_well(self, at: str) -> str:
        return f"coalesce({at} between date'0001-01-01' and date'9999-12-31', {str(self.optional).lower()})"

    def typed(self, text: Column) -> Column:
        return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("MM/dd/yyyy")).cast("date")


# The two record kinds, their columns in order, and what the columns must hold.
NPPES = (
    Field("npi", r"rlike({c}, '\\A[ \\t]*[0-9]{{10}}[ \\t]*\\z')"),
    Field("entity_type_code", "{c} in ('1', '2')"),
    Field("org_name"),
    Field("last_name"),
    Field("first_name"),
    Field("credential"),
    Field("practice_address_1"),
    Field("practice_city"),
    Field("practice_state"),
    Field("practice_zip", r"rlike({c}, '\\A([0-9]{{5}}([0-9]{{4}})?)?\\z')"),
    DateField("enumeration_date"),
    DateField("last_update_date", optional=True),
)
ANOMALIES = (
    Field("step", "{c} in ('index', 'extract', 'nppes')"),
    Field("file_id", r"rlike({c}, '\\A[0-9a-f]{{12}}\\z')"),
    Field("type"),
    Field("key"),
    Field("json_path"),
    Field("detail", r"not rlike({c}, '[\\x00-\\x09\\x0B-\\x1F\\x7F-\\x9F\\uFFFD\\uFDD0]')"),
)
KINDS = {"nppes": NPPES, "anomalies": ANOMALIES}


def quoting(line: Column) -> tuple[Column, Column]:
    """(quoting is whole, number of columns) of a record."""
    return judged(marked(line))


def marked(line: Column) -> Column:
    return F.regexp_replace(F.translate(line, MARK, ""), '"[^"]*"', MARK)


def judged(left: Column) -> tuple[Column, Column]:
    whole = ~left.contains('"') & ~left.rlike(f"[^,{MARK}]{MARK}|{MARK}[^,{MARK}]")
    return whole, F.length(left) - F.length(F.replace(left, F.lit(","), F.lit(""))) + 1


TEXT = {
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": NO_NULL, "maxCharsPerColumn": "-1",
    "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE",
}
TYPED = TEXT | {"nullValue": "", "dateFormat": "MM/dd/yyyy"}


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """With further columns, through a generator of one row: they are computed once, not once for every condition that uses them."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return rows.select("*", made.alias("_made")).select(*rows.columns, "_made.*")


def classified(df: DataFrame, id_col: str, line: str, kind_col: str, kinds: Mapping[str, Sequence[Field]] = KINDS) -> DataFrame:
    """(id, kind, raw, read_<kind>..., fine, text_<kind>..., reason): every record once. ``read``: as read under the typed schema;
    ``fine``: loaded so; ``text``: read again as text; reason null: valid.

    A null line counts as an empty one: a single empty column. One final carriage return is not data. A kind that isn't known
    is rejected as 'unknown_kind'.
    """
    raw = F.regexp_replace(F.coalesce(F.col("line"), F.lit("")), r"\r\z", "")
    rows = exact(df, [id_col, line, kind_col]).toDF("id", "line", "kind").select("id", F.coalesce("kind", F.lit("")).alias("kind"), raw.alias("raw"))
    quotes = F.length("raw") - F.length(F.replace("raw", F.lit('"'), F.lit("")))

    def read(kind: str, fields: Sequence[Field], options: dict, typed: bool) -> Column:
        ddl = ", ".join([*(f"`{f.name}` {f.kind if typed else 'string'}" for f in fields), f"`{CORRUPT}` string"])
        return F.from_csv(F.translate("raw", SPECIAL, STAND_INS), ddl, options)

    # a quote without a partner would spoil the reader's state for the next line: such a record is kept from it
    rows = once(rows, **{f"read_{k}": F.when((F.col("kind") == k) & (quotes % 2 == 0), read(k, fields, TYPED, True)) for k, fields in kinds.items()})
    fine = F.lit(False)
    for k, fields in kinds.items():
        whole = F.col(f"read_{k}").isNotNull() & F.col(f"read_{k}.{CORRUPT}").isNull() & ~F.col("raw").contains('"')
        conditions = [F.expr(f.read_well(f"read_{k}.`{f.name}`")) for f in fields if f.valid != "true"]
        fine = F.when(F.col("kind") == k, reduce(Column.__and__, [whole, *conditions])).otherwise(fine)
    rows = once(rows, fine=fine)
    rows = once(rows, left=F.when(~F.col("fine"), marked(F.col("raw"))))
    whole, columns = judged(F.col("left"))
    rows = once(rows, whole=whole, columns=columns)
    rows = once(rows, **{f"text_{k}": F.when((F.col("kind") == k) & F.col("whole"), read(k, fields, TEXT, False)) for k, fields in kinds.items()})
    reason = F.lit("unknown_kind")
    for k, fields in kinds.items():
        mine = F.when(F.col("fine"), F.lit(None).cast("string")).when(~F.col("whole"), F.lit("broken_quoting")).when(F.col("columns") != len(fields), F.lit("wrong_column_count"))
        for f in fields:
            if f.valid != "true":
                mine = mine.when(~F.expr(f.valid.format(c=f"coalesce(text_{k}.`{f.name}`, '')")), F.lit(f"bad_value:{f.name}"))
        reason = F.when(F.col("kind") == k, mine).otherwise(reason)
    return rows.withColumn("reason", reason)


def rejected(df: DataFrame, id_col: str = "line_id", line: str = "line", kind_col: str = "record_kind") -> DataFrame:
    """(id, reason) of every record that can't be loaded, from one pass over the records."""
    return classified(df, id_col, line, kind_col).filter("reason is not null").select(F.col("id").alias(id_col), "reason")


def loaded(df: DataFrame, kind: str, id_col: str = "line_id", line: str = "line", kind_col: str = "record_kind") -> DataFrame:
    """The valid records of a kind under its schema: dates as dates, codes and ids as text (an id may begin with 0), empty fields
    as null, nppes.npi without blanks."""
    fields = KINDS[kind]
    ok = classified(df, id_col, line, kind_col, {kind: fields}).filter("reason is null")
    clean = lambda c: F.translate(c, STAND_INS, SPECIAL)
    cols = []
    for f in fields:
        mine = F.col(f"read_{kind}.{f.name}")
        mine = F.nullif(clean(mine), F.lit("")) if f.kind == "string" else mine
        cols.append(F.when(F.col("fine"), mine).otherwise(f.typed(clean(F.col(f"text_{kind}.{f.name}")))).alias(f.name))
    out = ok.select(F.col("id").alias(id_col), *cols)
    return out.withColumn("npi", F.btrim("npi", F.lit(" \t"))) if kind == "nppes" else out
