"""Columns by exact name, whatever else a table holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact(df: DataFrame, names: Iterable[str | None]) -> DataFrame:
    """Only the named columns, in this order. Other columns may have the same names, or differ in case only: the first that
    agrees in case is taken, else the first that agrees without. A missing column raises."""
    wanted = list(dict.fromkeys(n for n in names if n))
    have = df.columns
    lower = [c.lower() for c in have]
    at = []
    for n in wanted:
        if n not in have and n.lower() not in lower:
            raise ValueError(f"no column {n!r} among {have}")
        at.append(have.index(n) if n in have else lower.index(n.lower()))
    if all(lower.count(lower[i]) == 1 for i in at):
        return df.select(*[F.col(f"`{have[i]}`").alias(n) for i, n in zip(at, wanted, strict=True)])
    placed = df.toDF(*[f"_c{i}" for i in range(len(have))])
    return placed.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(at, wanted, strict=True)])


def distinct_names(df: DataFrame) -> DataFrame:
    """The same table, columns whose name stands twice (in any case) told apart by a number."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = seen[c.lower()] = seen.get(c.lower(), 0) + 1
        out.append(c if n == 1 else f"{c}_{n}")
    return df.toDF(*out) if out != df.columns else df
