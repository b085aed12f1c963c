"""Texts into containers of a fixed number of tokens, whole wherever they fit.

Bounded-space best fit: each task packs its own documents as they come. A fixed number of containers is open; a bitset has a
bit for every free space that some open container has, so the container that fits best is the lowest bit from the item's size
on. Where none fits a new one is opened, and if too many are open then, the fullest closes. No shuffle, memory of the open
containers only; a task that is run again gives the same plan, and only its own last open containers stay partly filled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricequarry.functions.columns import exact


class Bins:
    """Open containers by free space. ``place`` gives (container, offset)."""

    def __init__(self, capacity: int, most_open: int = 64) -> None:
        if capacity < 1 or most_open < 1:
            raise ValueError("capacity and most_open must be positive")
        self.capacity, self.most_open = capacity, most_open
        self.by_free: dict[int, list[int]] = {}
        self.bits = 0
        self.n_open = self.n_made = 0

    def _put(self, free: int, bin_id: int) -> None:
        self.by_free.setdefault(free, []).append(bin_id)
        self.bits |= 1 << free
        self.n_open += 1

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_id = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.n_open -= 1
        return bin_id

    def new(self) -> int:
        self.n_made += 1
        return self.n_made - 1

    def place(self, size: int) -> tuple[int, int]:
        if not 0 < size <= self.capacity:
            raise ValueError("an item must fit a container")
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            free = self.capacity
            bin_id = self.new()
        if free > size:
            self._put(free - size, bin_id)
            if self.n_open > self.most_open:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        return bin_id, self.capacity - free


def pieces(n_tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(first token, tokens): the item whole, or, if longer than the capacity, full containers and a rest."""
    for start in range(0, n_tokens, capacity):
        yield start, min(capacity, n_tokens - start)


def tokenizer(path: str | None, name: str = "byte_bpe_50k.tiktoken"):
    """The public byte-level tokenizer; ``path`` of its rank file, by default from the installed collection."""
    import public_tokenizers as collection
    import tiktoken

    with open(path or collection.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=collection.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packing_plan(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, most_open: int = 64, tokenizer_path: str | None = None
) -> DataFrame:
    """(container_id, doc_id, piece, token_start, n_tokens, offset), one row per piece of a document.

    A document of at most ``capacity`` tokens is one piece; a longer one is cut into full containers and one rest, which is
    packed like others. Null, empty and token-less texts have one row with 0 tokens and no container. Repeated documents are
    packed each. An empty table gives no row. ``offset`` is where the piece begins in its container.
    """
    schema = pa.schema([("container_id", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("token_start", pa.int64()), ("n_tokens", pa.int32()), ("offset", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path).encode_ordinary
        bins = Bins(capacity, most_open)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 512):
                rows: list[tuple] = []
                for i, t in zip(ids[lo : lo + 512].to_pylist(), texts[lo : lo + 512].to_pylist(), strict=True):
                    n = len(encode(t)) if t else 0
                    if not n:
                        rows.append((None, i, 0, 0, 0, None))
                    for p, (start, size) in enumerate(pieces(n, capacity)):
                        container, offset = bins.place(size)
                        rows.append((base + container, i, p, start, size, offset))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows = exact(documents, [doc_id, text]).toDF("_id", "_text").select(F.col("_id").cast("long"), "_text")
    return rows.mapInArrow(run, "container_id long, doc_id long, piece int, token_start long, n_tokens int, offset int")


def fill(plan: DataFrame, capacity: int = 2048) -> DataFrame:
    """(n_documents, n_pieces, n_containers, n_tokens, fill): how full the containers of a plan are."""
    per = plan.filter("container_id is not null").groupBy("container_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pieces"), F.count(F.lit(1)).alias("n_containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_tokens"))
    return one.withColumn("fill", F.try_divide(F.col("n_tokens").cast("double"), F.col("n_containers") * F.lit(float(capacity))))
