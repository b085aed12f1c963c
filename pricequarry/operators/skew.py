"""Per-key aggregation where a few keys hold most rows.

Plan: one pass builds a mergeable frequent-items sketch of every key field (``approx_top_k``, partial per task). Its error is
bounded by 3.5 rows in ``tracked`` of all rows, far below ``heavy_share``, so every key over the share is among the
candidates, of which there are at most ``1 / heavy_share`` or so: that bound is what makes broadcasting them safe. Rows of
heavy keys are found by a broadcast join and aggregated per (key, salt) first; all other rows take an ordinary shuffle on the
key; the two results are united. No task receives the raw rows of a heavy key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact

KEY = "key_value"


def heavy_hitters(df: DataFrame, fields: Sequence[str], share: float, tracked: int = 8192) -> DataFrame:
    """Candidates (key_field, key_value, n_all) whose estimated count reaches ``share`` of all rows, from one pass.

    Null keys are never candidates but count towards ``n_all``. An empty table gives no row. Fields are compared as text.
    """
    if not 7.0 / tracked < share <= 1:
        raise ValueError("the sketch must resolve the share: 7 / tracked < share <= 1")
    df = exact(df, fields)
    k = math.ceil(2 / share)
    aggs = [F.count(F.lit(1)).alias("n_all")]
    for x in fields:
        aggs.append(F.expr(f"approx_top_k(`{x}`, {k}, {tracked}) FILTER (WHERE `{x}` IS NOT NULL)").alias(f"top_{x}"))
    one = df.select(*[F.col(f"`{x}`").cast("string").alias(x) for x in fields]).agg(*aggs)

    def named(x: str) -> Column:
        return F.transform(F.col(f"`top_{x}`"), lambda t: F.struct(F.lit(x).alias("key_field"), t["item"].alias(KEY), t["count"].alias("estimate")))

    lists = F.array(*[named(x) for x in fields])
    rows = one.select("n_all", F.explode(F.flatten(lists)).alias("c"))
    slack = 7.0 / tracked
    return rows.filter((F.col("c.estimate") >= (share - slack) * F.col("n_all")) & F.col(f"c.{KEY}").isNotNull()).select(
        "c.key_field", f"c.{KEY}", "n_all"
    )


def _moments(distinct: str | None) -> list[Column]:
    """Counts, extremes, mean and mean squared distance from it; Spark merges the partial results of tasks as central moments."""
    v = F.col("v")
    out = [
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n_values"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
    ]
    return [*out, F.count_distinct("d").alias("n_distinct")] if distinct else out


def _merged(salted: DataFrame, by: Sequence[str], distinct: str | None) -> DataFrame:
    """One row per key from its salts: means and squared distances are merged pair by pair, in the order of the salts, so that
    nothing cancels; a key has as many rows to merge as there are salts."""
    part = F.when(F.col("n_values") > 0, F.struct("salt", F.col("n_values").cast("double").alias("n"), "mean", "m2"))

    def chan(x: Column, y: Column) -> Column:
        n, apart = x["n"] + y["n"], y["mean"] - x["mean"]
        return F.struct(n.alias("n"), (x["mean"] + apart * y["n"] / n).alias("mean"), (x["m2"] + y["m2"] + apart * apart * x["n"] * y["n"] / n).alias("m2"))

    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_values", *(["n_distinct"] if distinct else []))]
    out = salted.groupBy(*by).agg(*sums, F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.array_sort(F.collect_list(part)).alias("parts"))
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = F.aggregate("parts", zero, chan)
    out = out.withColumn("whole", F.when(F.size("parts") > 0, whole))
    return out.select("*", "whole.mean", "whole.m2").drop("parts", "whole")


def skewed_key_stats(
    df: DataFrame, fields: Sequence[str], value: str, distinct: str | None = None, heavy_share: float = 0.01, salts: int = 64, tracked: int = 8192
) -> DataFrame:
    """Count and statistics of ``value`` per value of each key field, whatever the skew of the keys.

    Returns (key_field, key_value, is_heavy, n_all, n_rows, n_values, avg_value, min_value, max_value, std_value[, n_distinct]).
    ``n_distinct`` counts the non-null values of ``distinct`` that occur with the key. Null keys form no row; null values
    count in n_rows only; a key without any value has null statistics; repeated rows count as often as they stand. NaN
    values count as null. Salting is by a hash of ``distinct`` (else of the value), so that partial results are reproducible.
    """
    df = exact(df, [*fields, value, distinct])
    heavy = heavy_hitters(df, fields, heavy_share, tracked)
    out = []
    for x in fields:
        v = F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None).cast("double"))
        cols = [F.col(f"`{x}`").cast("string").alias(KEY), v.alias("v")]
        if distinct:
            cols.append(F.col(f"`{distinct}`").cast("string").alias("d"))
        rows = df.select(*cols).filter(F.col(KEY).isNotNull())
        hot = F.broadcast(heavy.filter(F.col("key_field") == x).select(KEY, "n_all"))
        salt = F.pmod(F.xxhash64("d" if distinct else "v"), F.lit(salts)).alias("salt")
        # all rows of a pair (key, d) share a salt, so that distinct values add up over salts
        mine = rows.join(hot, KEY).groupBy(KEY, "n_all", salt).agg(*_moments(distinct))
        mine = _merged(mine, [KEY, "n_all"], distinct).withColumn("is_heavy", F.lit(True))
        rest = rows.join(hot.drop("n_all"), KEY, "left_anti").groupBy(KEY).agg(*_moments(distinct))
        rest = rest.withColumn("n_all", F.lit(None).cast("long")).withColumn("is_heavy", F.lit(False))
        out.append(mine.unionByName(rest).withColumn("key_field", F.lit(x)))
    every = reduce(DataFrame.unionByName, out)
    spread = F.when(F.col("n_values") > 1, F.sqrt(F.greatest("m2", F.lit(0.0)) / (F.col("n_values") - 1)))
    keep = ["key_field", KEY, "is_heavy", "n_all", "n_rows", "n_values", F.col("mean").alias("avg_value"), "min_value", "max_value", spread.alias("std_value")]
    return every.select(*keep, *(["n_distinct"] if distinct else []))


def heavy_keys(df: DataFrame, fields: Sequence[str], value: str, share: float) -> DataFrame:
    """(key_field, key_value, n_rows): the non-null values that hold at least ``share`` of all rows, by exact count.

    The rows of ``skewed_key_stats`` that reach the share; light keys can't. An empty table gives no row; ties are all kept.
    """
    need = F.ceil(F.lit(str(share)).cast("decimal(10,9)") * F.col("n_all").cast("decimal(20,0)"))
    stats = skewed_key_stats(df, fields, value, heavy_share=share / 2)
    return stats.filter(F.col("n_rows") >= need).select("key_field", KEY, "n_rows")
