"""Percentiles of very large columns per group, from mergeable relative-error sketches.

A sketch is a stack of relative compactors. A full compactor sorts its buffer, keeps the protected tail, and sends every other
value of some sections next to it, at double weight, one level up. How many sections take part follows the trailing ones of
its compaction count, so that values near the protected tail are compacted ever more rarely: the rank error is then a fraction
of the distance to that tail, not of n. Tasks build one sketch per group from whole Arrow batches; sketches are merged level
by level, over tasks in rounds of bounded fan-in, then over days, units or whatever else is to be combined.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact
from pricequarry.session import cut

# Fixed values of the published analysis of relative compactors: sections at the start, and the standard deviation of a rank
# as a share of n, relative (times the distance to the protected tail) and at most.
SECTIONS = 3
RELATIVE = (0.0512 / SECTIONS) ** 0.5
ABSOLUTE = 0.084
FAN_IN = 64


class Compactor:
    __slots__ = ("buffer", "coin", "count", "pending", "sections", "size", "size_f")

    def __init__(self, k: int) -> None:
        self.size_f, self.size, self.sections, self.count, self.coin = float(k), k, SECTIONS, 0, 0
        self.buffer = np.empty(0)
        self.pending: list[np.ndarray] = []

    @property
    def capacity(self) -> int:
        return 2 * self.sections * self.size

    def __len__(self) -> int:
        return len(self.buffer) + sum(map(len, self.pending))

    def add(self, values: np.ndarray) -> None:
        if len(values):
            self.pending.append(values)

    def settle(self) -> np.ndarray:
        if self.pending:
            self.buffer = np.sort(np.concatenate([self.buffer, *self.pending]))
            self.pending = []
        return self.buffer

    def grow(self) -> None:
        while self.count >= 1 << (self.sections - 1) and self.size > 4:
            size_f = self.size_f / 2**0.5
            size = 2 * round(size_f / 2)
            if size < 4:
                return
            self.size_f, self.size, self.sections = size_f, size, self.sections * 2

    def compact(self, high: bool, flip: int) -> np.ndarray:
        """Every other value of what isn't protected, for the level above."""
        b = self.settle()
        ones = (~self.count & (self.count + 1)).bit_length() - 1
        keep = self.capacity // 2 + (self.sections - min(ones + 1, self.sections)) * self.size
        n = len(b) - keep
        n -= n % 2
        if n <= 0:
            return np.empty(0)
        self.coin = 1 - self.coin if self.count & 1 else flip
        part = b[:n] if high else b[len(b) - n :]
        self.buffer = b[n:] if high else b[: len(b) - n]
        up = part[self.coin :: 2]
        self.count += 1
        self.grow()
        return up


class RelativeSketch:
    """Quantiles whose rank error is multiplicative at one tail: the high one, or the low one."""

    def __init__(self, k: int = 32, high: bool = True, seed: int = 0) -> None:
        if k < 4 or k % 2:
            raise ValueError("k must be even and at least 4")
        self.k, self.high, self.n = k, high, 0
        self.low, self.top = np.inf, -np.inf
        self.levels = [Compactor(k)]
        self.seed = seed & 0xFFFFFFFF

    def _flip(self) -> int:
        self.seed = (self.seed * 1664525 + 1013904223) & 0xFFFFFFFF
        return self.seed >> 31

    def update(self, values: np.ndarray) -> None:
        """NaN is ignored."""
        values = values[~np.isnan(values)]
        if len(values):
            self.n += len(values)
            self.low, self.top = min(self.low, float(values.min())), max(self.top, float(values.max()))
            self.levels[0].add(values)
            self._compress()

    def _compress(self) -> None:
        h = 0
        while h < len(self.levels):
            level = self.levels[h]
            if len(level) >= level.capacity:
                up = level.compact(self.high, self._flip())
                if len(up):
                    if h + 1 == len(self.levels):
                        self.levels.append(Compactor(self.k))
                    self.levels[h + 1].add(up)
            h += 1

    def merge(self, other: RelativeSketch) -> RelativeSketch:
        if (other.k, other.high) != (self.k, self.high):
            raise ValueError("only sketches of equal k and tail can be merged")
        self.n += other.n
        self.low, self.top = min(self.low, other.low), max(self.top, other.top)
        while len(self.levels) < len(other.levels):
            self.levels.append(Compactor(self.k))
        for mine, theirs in zip(self.levels, other.levels, strict=False):
            mine.count |= theirs.count
            mine.grow()
            mine.add(theirs.settle())
        self._compress()
        return self

    def weighted(self) -> tuple[np.ndarray, np.ndarray]:
        """Retained values in order, and the number of values up to and with each."""
        v = np.concatenate([x.settle() for x in self.levels])
        w = np.concatenate([np.full(len(x.buffer), 1 << h, np.int64) for h, x in enumerate(self.levels)])
        order = np.argsort(v, kind="stable")
        return v[order], np.cumsum(w[order])

    def quantiles(self, ranks: Sequence[float]) -> list[float]:
        """The least retained value whose rank reaches each share of n; NaN for an empty sketch."""
        if not self.n:
            return [float("nan")] * len(ranks)
        v, c = self.weighted()
        out = []
        for r in ranks:
            if r <= 0 or r >= 1:
                out.append(self.low if r <= 0 else self.top)
            else:
                out.append(float(v[min(int(np.searchsorted(c, r * self.n - 1e-9)), len(v) - 1)]))
        return out

    def deviation(self, rank: float) -> float:
        """Standard deviation of the estimated rank, as a share of n: 0 while nothing was compacted."""
        if len(self.levels) == 1:
            return 0.0
        return min(RELATIVE / self.k * ((1 - rank) if self.high else rank), ABSOLUTE / self.k)

    def dump(self) -> bytes:
        parts = [struct.pack("<i?qddIi", self.k, self.high, self.n, self.low, self.top, self.seed, len(self.levels))]
        for x in self.levels:
            b = x.settle()
            parts.append(struct.pack("<dqqqii", x.size_f, x.size, x.sections, x.count, x.coin, len(b)))
            parts.append(b.astype("<f8").tobytes())
        return b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> RelativeSketch:
        head = struct.Struct("<i?qddIi")
        k, high, n, low, top, seed, levels = head.unpack_from(data)
        out = cls(k, high, seed)
        out.n, out.low, out.top, out.levels = n, low, top, []
        at, each = head.size, struct.Struct("<dqqqii")
        for _ in range(levels):
            x = Compactor(k)
            x.size_f, x.size, x.sections, x.count, x.coin, m = each.unpack_from(data, at)
            at += each.size
            x.buffer = np.frombuffer(data, "<f8", m, at).copy()
            at += 8 * m
            out.levels.append(x)
        return out


def merged(dumps: Sequence[bytes]) -> RelativeSketch:
    out = RelativeSketch.load(dumps[0])
    for d in dumps[1:]:
        out.merge(RelativeSketch.load(d))
    return out


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A round of merging rows (keys..., task, sketch): those of a group whose ``task`` lies in one range of FAN_IN become one, whose
    task is the number of the range."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sketches.schema if f.name in keys)
    names = [f.name for f in sketches.schema if f.name in keys]

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task", kind="stable")
        dumps = group["sketch"].tolist()
        return pd.DataFrame([[*key, group["task"].iloc[0] // FAN_IN, merged(sorted(dumps)).dump()]], columns=[*names, "task", "sketch"])

    return sketches.groupBy(*names, F.expr(f"task div {FAN_IN}").alias("range")).applyInPandas(
        lambda key, group: merge(key[:-1], group), f"{ddl}, task long, sketch binary"
    )


def sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = 32, high: bool = True, most_groups: int = 20_000) -> DataFrame:
    """(keys..., sketch): one sketch of the non-null, non-NaN values per group; null keys are a group; an empty table has none."""
    if {"task", "sketch"} & set(keys):
        raise ValueError("keys can't be named task or sketch")
    df = exact(df, [*keys, value])
    src = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in keys], F.col(f"`{value}`").cast("double").alias("_v"), F.spark_partition_id().cast("long").alias("_task"))
    src = src.filter("_v is not null and not isnan(_v)")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, RelativeSketch] = {}
        task = flush = 0

        def out() -> pa.RecordBatch:
            cols = [pa.array([g[i] for g in held], pa.string()) for i in range(len(keys))]
            cols += [pa.array([n] * len(held), pa.int64()) for n in (task, flush)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([s.dump() for s in held.values()], pa.binary())], names=[*keys, "task", "flush", "sketch"])

        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column(len(keys) + 1)[0].as_py()
            pdf = batch.to_pandas()
            code = pdf.groupby(list(keys), dropna=False, sort=False).ngroup().to_numpy() if keys else np.zeros(len(pdf), int)
            order = np.argsort(code, kind="stable")
            bounds = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0, True])
            values = pdf["_v"].to_numpy(np.float64)[order]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                row = pdf.iloc[order[a]]
                g = tuple(None if pd.isna(row[c]) else row[c] for c in keys)
                if g not in held:
                    held[g] = RelativeSketch(k, high, seed=task * 2654435761 + len(held))
                held[g].update(values[a:b])
            if len(held) > most_groups:
                yield out()
                held.clear()
                flush += 1
        if held:
            yield out()

    ddl = ", ".join(f"`{c}` string" for c in keys) + (", " if keys else "") + "task long, flush long, sketch binary"
    made = cut(src.mapInArrow(build, ddl))
    # a task with very many groups gives several sketches of one: each counts as a task of its own
    most = made.agg(F.max("task").alias("t"), F.max("flush").alias("f")).first()
    tasks, flushes = (most.t or 0) + 1, (most.f or 0) + 1
    made = made.withColumn("task", F.col("task") + F.col("flush") * tasks).drop("flush")
    return _merged_all(made, keys, tasks * flushes)


def _merged_all(made: DataFrame, keys: Sequence[str], tasks: int) -> DataFrame:
    """One sketch per ``keys`` from rows whose ``task`` is below ``tasks``."""
    while True:
        made = merge_sketches(made, keys)
        tasks = -(-tasks // FAN_IN)
        if tasks == 1:
            return made.drop("task")


def combine(made: DataFrame, keys: Sequence[str], over: Sequence[str], label: str = "*") -> DataFrame:
    """The sketches with ``over`` merged away, under ``label`` in those columns; the rows of ``made`` aren't part of it."""
    rest = [c for c in keys if c not in over]
    most = made.groupBy(*rest).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    # as many numbers as the largest group has sketches: a range of FAN_IN numbers has about as many sketches
    rows = made.withColumn("task", F.pmod(F.xxhash64(*keys), F.lit(most)).cast("long"))
    one = _merged_all(rows, rest, most)
    return one.select(*[F.lit(label).alias(c) if c in over else F.col(c) for c in keys], "sketch")


def percentiles(made: DataFrame, keys: Sequence[str], ranks: Sequence[float], deviations: float = 3.0) -> DataFrame:
    """(keys..., n, min, max, q, value, low, high): per group and rank the estimate, and the values between which the exact
    one lies but for ``deviations`` standard deviations of the rank."""
    ranks = list(ranks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, d in enumerate(batch.column(len(keys)).to_pylist()):
                s = RelativeSketch.load(d)
                slack = [deviations * s.deviation(r) + (1 / s.n if len(s.levels) > 1 else 0) for r in ranks]
                v, lo, hi = s.quantiles(ranks), s.quantiles([r - e for r, e in zip(ranks, slack, strict=True)]), s.quantiles([r + e for r, e in zip(ranks, slack, strict=True)])
                rows += [(i, s.n, s.low, s.top, *x) for x in zip(ranks, v, lo, hi, strict=True)]
            take = pa.array([r[0] for r in rows], pa.int32())
            nums = [pa.array([r[j] for r in rows], pa.int64() if j == 1 else pa.float64()) for j in range(1, 8)]
            yield pa.RecordBatch.from_arrays([*[batch.column(j).take(take) for j in range(len(keys))], *nums], names=[*keys, "n", "min", "max", "q", "value", "low", "high"])

    ddl = ", ".join(f"`{c}` string" for c in keys) + ", n long, min double, max double, q double, value double, low double, high double"
    return made.select(*keys, "sketch").mapInArrow(read, ddl)
