"""What changed between consecutive full snapshots of a table.

A state in a folder holds two tables. The dictionary gives every key an ordinal within its shard (a hash of the key), once and
for all: keys that a further snapshot brings are numbered after those that are there, wherever its date stands among the
others. Ordinals are cut into containers of 65,536; per snapshot and container the state has a compressed bitmap of the ordinals
present (a sorted 16-bit array while sparse, packed bits when dense) and a vector of values aligned with them. AND-NOT of the
bitmaps of two dates gives additions and removals, AND the common keys, whose vectors are compared. A further snapshot reads
itself, the dictionary and the containers of its neighbours in time, nothing else of the history. Only ordinals and values go
to Python, a container of one snapshot at a time; keys come back by a join on (shard, ordinal).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact
from pricequarry.session import cut, exists, fresh_folder

CONTAINER = 1 << 16
SPARSE = 4096


class Bitmap:
    """A set of 16-bit numbers: a sorted array up to 4,096 of them, else packed bits."""

    __slots__ = ("bits", "few")

    def __init__(self, few: np.ndarray | None = None, bits: np.ndarray | None = None) -> None:
        self.few, self.bits = few, bits

    @classmethod
    def of(cls, numbers: np.ndarray) -> Bitmap:
        few = np.unique(numbers).astype(np.uint16)
        if len(few) <= SPARSE:
            return cls(few=few)
        flags = np.zeros(CONTAINER, np.bool_)
        flags[few] = True
        return cls(bits=np.packbits(flags))

    def _bits(self) -> np.ndarray:
        if self.bits is not None:
            return self.bits
        flags = np.zeros(CONTAINER, np.bool_)
        flags[self.few] = True
        return np.packbits(flags)

    def has(self, numbers: np.ndarray) -> np.ndarray:
        if self.few is not None:
            return np.isin(numbers, self.few, assume_unique=True)
        return (self.bits[numbers >> 3] >> (7 - (numbers & 7)).astype(np.uint8)) & 1 == 1

    def numbers(self) -> np.ndarray:
        return self.few if self.few is not None else np.flatnonzero(np.unpackbits(self.bits)).astype(np.uint16)

    def and_not(self, other: Bitmap) -> np.ndarray:
        if self.few is not None:
            return self.few[~other.has(self.few)]
        return np.flatnonzero(np.unpackbits(self.bits & ~other._bits())).astype(np.uint16)

    def dump(self) -> bytes:
        return b"f" + self.few.astype("<u2").tobytes() if self.few is not None else b"b" + self.bits.tobytes()

    @classmethod
    def load(cls, data: bytes) -> Bitmap:
        return cls(few=np.frombuffer(data, "<u2", offset=1)) if data[:1] == b"f" else cls(bits=np.frombuffer(data, np.uint8, offset=1))

    def both(self, other: Bitmap) -> np.ndarray:
        if self.few is not None:
            return self.few[other.has(self.few)]
        return np.flatnonzero(np.unpackbits(self.bits & other._bits())).astype(np.uint16)


def _encoded(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The bitmap and the vector of one container of one snapshot."""
    group = group.sort_values("low")
    low, values = group["low"].to_numpy(np.int64), group["value"].to_numpy(np.float64, na_value=np.nan)
    return pd.DataFrame([[*key, Bitmap.of(low).dump(), values.astype("<f8").tobytes()]], columns=["snap", "shard", "container", "bitmap", "vector"])


EMPTY = (Bitmap.of(np.empty(0, np.int64)), np.empty(0))
FOUND = pa.schema([("snap", pa.date32()), ("shard", pa.int32()), ("ordinal", pa.int64()), ("change", pa.string())])


def container_changes(before: tuple[Bitmap, np.ndarray], after: tuple[Bitmap, np.ndarray], tolerance: float) -> list[tuple[str, np.ndarray]]:
    """(change, ordinals in the container) between the same container of two snapshots."""
    (old, x), (new, y) = before, after
    common = new.both(old)
    u, v = x[np.searchsorted(old.numbers(), common)], y[np.searchsorted(new.numbers(), common)]
    differ = (np.isnan(u) != np.isnan(v)) | (np.abs(u - v) >= tolerance - 1e-10)
    return [("added", new.and_not(old)), ("removed", old.and_not(new)), ("changed", common[differ])]


class SnapshotState:
    """The dictionary and the containers of all snapshots taken so far, in a folder that all executors share.

    ``shards`` is settled when a state is begun, by default from the size of its first snapshots, and kept from then on.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], tolerance: float = 0.005, shards: int | None = None) -> None:
        self.spark, self.folder, self.keys, self.tolerance, self.shards = spark, folder.rstrip("/"), list(keys), tolerance, shards
        self.ks = [f"k{i}" for i in range(len(keys))]
        if exists(spark, f"{self.folder}/meta"):
            meta = spark.read.json(f"{self.folder}/meta").first()
            if list(meta["keys"]) != self.keys:
                raise ValueError(f"a state of other keys: {list(meta['keys'])}")
            self.shards = meta["shards"]

    def _read(self, name: str) -> DataFrame | None:
        path = f"{self.folder}/{name}"
        return self.spark.read.parquet(path) if exists(self.spark, path) else None

    def dates(self) -> list[dt.date]:
        """The dates taken so far, in order."""
        stored = self._read("containers")
        return sorted(r.snap for r in stored.select("snap").distinct().collect()) if stored is not None else []

    def _begin(self, rows: DataFrame) -> None:
        if self.shards is None:
            size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            self.shards = max(64, 1 << min(16, (size >> 28).bit_length()))
        meta = self.spark.createDataFrame([(self.shards, self.keys)], "shards int, keys array<string>")
        meta.coalesce(1).write.json(f"{self.folder}/meta")

    def add(self, rows: DataFrame) -> None:
        """Takes the snapshots of ``rows`` (snap, k0..., value), one row per key and date (``latest_rows``). A date that is there
        already is replaced. Keys keep their ordinals."""
        if not exists(self.spark, f"{self.folder}/meta"):
            self._begin(rows)
        per_key = rows.groupBy(*self.ks).agg(F.min("snap").alias("first"), F.collect_list(F.struct("snap", "value")).alias("versions"))
        per_key = per_key.withColumn("shard", F.pmod(F.xxhash64(*self.ks), F.lit(self.shards)).cast("int"))
        known = self._read("keys")
        if known is None:
            fresh, placed = per_key, None
            offset = None
        else:
            same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("shard", *self.ks)]
            both = cut(per_key.alias("a").join(known.alias("b"), same, "left").select("a.*", "b.ordinal"))
            fresh, placed = both.filter("ordinal is null").drop("ordinal"), both.filter("ordinal is not null")
            offset = known.groupBy("shard").agg((F.max("ordinal") + 1).alias("offset"))  # a row per shard
        place = F.row_number().over(Window.partitionBy("shard").orderBy("first", *self.ks)).cast("long") - 1
        fresh = fresh.withColumn("ordinal", place)
        if offset is not None:
            fresh = fresh.join(F.broadcast(offset), "shard", "left").withColumn("ordinal", F.col("ordinal") + F.coalesce("offset", F.lit(0))).drop("offset")
        fresh = cut(fresh)
        fresh.select("shard", "ordinal", *self.ks).write.mode("append").parquet(f"{self.folder}/keys")
        numbered = fresh if placed is None else fresh.unionByName(placed)
        versions = numbered.select("shard", "ordinal", F.explode("versions").alias("x")).select(
            F.col("x.snap").alias("snap"), "shard", F.expr(f"ordinal div {CONTAINER}").alias("container"), F.expr(f"ordinal % {CONTAINER}").cast("int").alias("low"), F.col("x.value").alias("value")
        )
        made = versions.groupBy("snap", "shard", "container").applyInPandas(_encoded, "snap date, shard int, container long, bitmap binary, vector binary")
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snap").parquet(f"{self.folder}/containers")

    def changes(self, dates: Sequence[dt.date] | None = None) -> DataFrame:
        """(snapshot_date, keys..., change) for each pair of consecutive dates, or for those with one of ``dates`` in them."""
        every = self.dates()
        pairs = [(a, b) for a, b in zip(every, every[1:], strict=False) if dates is None or a in dates or b in dates]
        stored, known = self._read("containers"), self._read("keys")
        if not pairs or stored is None:
            ddl = f"snapshot_date date, {', '.join(f'`{k}` string' for k in self.keys)}, change string"
            return self.spark.createDataFrame([], ddl)
        steps = self.spark.createDataFrame(pairs, "before date, snap date")  # a row per date, so it is small
        blob = lambda p: [F.col("bitmap").alias(f"{p}_bitmap"), F.col("vector").alias(f"{p}_vector")]
        used = stored.filter(F.col("snap").isin(sorted({d for p in pairs for d in p})))
        new = used.join(F.broadcast(steps.select("snap")), "snap").select("snap", "shard", "container", *blob("new"))
        old = used.withColumnRenamed("snap", "before").join(F.broadcast(steps), "before").select("snap", "shard", "container", *blob("old"))
        met = new.join(old, ["snap", "shard", "container"], "full")
        tolerance = self.tolerance

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in (r for n in range(batch.num_rows) for r in batch.slice(n, 1).to_pylist()):
                    new, old = ((Bitmap.load(r[f"{p}_bitmap"]), np.frombuffer(r[f"{p}_vector"], "<f8")) if r[f"{p}_bitmap"] is not None else EMPTY for p in ("new", "old"))
                    for change, low in container_changes(old, new, tolerance):
                        n = len(low)
                        cols = [pa.array([r["snap"]] * n, pa.date32()), pa.array(np.full(n, r["shard"], np.int32)), pa.array(r["container"] * CONTAINER + low.astype(np.int64)), pa.array([change] * n, pa.string())]
                        yield pa.RecordBatch.from_arrays(cols, schema=FOUND)

        found = met.mapInArrow(run, "snap date, shard int, ordinal long, change string")
        named = found.join(known, ["shard", "ordinal"])
        return named.select(F.col("snap").alias("snapshot_date"), *[F.col(a).alias(b) for a, b in zip(self.ks, self.keys, strict=True)], "change")


def latest_rows(df: DataFrame, snapshot: str, keys: Sequence[str], value: str, loaded: str) -> DataFrame:
    """One row per (snapshot, key): the one loaded last; equal load times are settled by the larger value, nulls last.

    A map-side maximum, so that a key with many rows is reduced before the shuffle.
    """
    rank = F.struct(F.col(f"`{loaded}`").alias("at"), F.col(f"`{value}`").cast("double").alias("v"))
    cols = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    return (
        df.filter(F.col(f"`{snapshot}`").isNotNull())
        .select(F.col(f"`{snapshot}`").cast("date").alias("snap"), *cols, rank.alias("last"))
        .groupBy("snap", *[f"k{i}" for i in range(len(keys))])
        .agg(F.max("last").alias("last"))
        .select("snap", *[f"k{i}" for i in range(len(keys))], F.col("last.v").alias("value"))
    )


def snapshot_changes(
    df: DataFrame, snapshot: str, keys: Sequence[str], value: str, loaded: str, tolerance: float = 0.005, shards: int | None = None,
    state: SnapshotState | None = None, at_once: int = 16,
) -> DataFrame:
    """(snapshot_date, keys..., change) for each pair of consecutive snapshot dates.

    change: 'added', 'removed' or 'changed' (value null on one side only, or ``tolerance`` or more apart). Null key parts are
    equal to each other; NaN counts as null; rows without a snapshot date are ignored; repeated rows count once; a table that
    is empty or has a single date gives no row. Without a ``state`` the dates of ``df`` are all there is, in a state of their own
    in the shared folder; with one they are added to it, and the changes are those of the pairs they are part of. ``at_once``
    dates are taken together, so that no more values of a key are gathered, however long the history.
    """
    spark = df.sparkSession
    df = exact(df, [snapshot, *keys, value, loaded])
    kept = state or SnapshotState(spark, fresh_folder(spark, "snapshots"), keys, tolerance, shards)
    dates = [r[0] for r in df.select(F.col(f"`{snapshot}`").cast("date").alias("d")).filter("d is not null").distinct().orderBy("d").collect()]
    rows = latest_rows(df, snapshot, keys, value, loaded)
    for n in range(0, len(dates), at_once):
        part = dates[n : n + at_once]
        kept.add(rows.filter(F.col("snap").between(part[0], part[-1])) if len(dates) > at_once else rows)
    out = kept.changes(None if state is None else dates)
    return out.select("snapshot_date", *[F.col(f"`{k}`") for k in keys], "change")
