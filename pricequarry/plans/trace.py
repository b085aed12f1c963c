"""From a stored value back to its place in the source."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.sources.nested import as_text, listed_at, parse

STEP = re.compile(r"\.?([A-Za-z_][\w-]*)|\[(\d+)\]")


def path_steps(path: str) -> list[str | int]:
    """`a[1].b.c[2]` as ['a', 1, 'b', 'c', 2]; anything else raises."""
    out: list[str | int] = []
    at = 0
    while at < len(path):
        m = STEP.match(path, at)
        if not m or (at == 0) == path.startswith(".", at) and m.group(1):
            raise ValueError(f"not a path: {path!r}")
        out.append(m.group(1) if m.group(1) else int(m.group(2)))
        at = m.end()
    if not out or isinstance(out[0], int):
        raise ValueError(f"not a path: {path!r}")
    return out


def resolve(root: object, steps: list[str | int]) -> object:
    """The value at the end of the steps; a lone value stands for a list of one; KeyError if there is none."""
    v = root
    for s in steps:
        if isinstance(s, int):
            vs = listed_at(v)
            if s >= len(vs):
                raise KeyError(s)
            v = vs[s]
        elif isinstance(v, dict) and s in v:
            v = v[s]
        else:
            raise KeyError(s)
    return v


def verified(rows: DataFrame, items: DataFrame, checks: dict[str, str]) -> DataFrame:
    """(file_id, i, j, k, field, stored, found, matches): stored columns against the text of their source item.

    ``rows`` have file_id, i, j, k and the stored columns; ``items`` (file_id, i, raw) hold the JSON of negotiated_rates.
    ``checks`` maps a stored column to the price's key. Rows whose item or place is gone have found null. Only items that
    rows point to are read.
    """
    stored = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in checks])
    asked = rows.select("file_id", "i", "j", "k", stored.alias("stored")).distinct()
    both = asked.join(items.select("file_id", "i", "raw"), ["file_id", "i"], "left")
    schema = pa.schema([("file_id", pa.string()), ("i", pa.int64()), ("j", pa.int64()), ("k", pa.int64()), ("field", pa.string()), ("stored", pa.string()), ("found", pa.string()), ("matches", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                root = parse(r["raw"])
                for field, value in (s.values() for s in r["stored"]):
                    try:
                        found = as_text(resolve(root, [r["j"], "negotiated_prices", r["k"], checks[field]]))
                    except KeyError:
                        found = None
                    out.append((r["file_id"], r["i"], r["j"], r["k"], field, value, found, value == found))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 8, schema, strict=True)], schema=schema)

    ids = [F.col(c).cast("long").alias(c) for c in "ijk"]
    return both.select("file_id", *ids, "stored", "raw").mapInArrow(run, "file_id string, i long, j long, k long, field string, stored string, found string, matches boolean")
