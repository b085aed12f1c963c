"""Table sets committed as a whole, published with a manifest, and loaded only when they are what the manifest says."""

from __future__ import annotations

import contextlib
import datetime
import hashlib
import json
import os
import shutil
from collections.abc import Callable, Iterator, Mapping
from typing import Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = 1 << 20
MANIFEST = "latest.json"
REQUIRED = ("snapshot_date", "files", "schema_version")


@contextlib.contextmanager
def committed(final: str) -> Iterator[str]:
    """A folder to fill; it takes the place of ``final`` when the block ends well, and is deleted when it doesn't. If it can't be put
    in place, what was there before is put back."""
    staging = f"{final}.tmp"
    shutil.rmtree(staging, ignore_errors=True)
    os.makedirs(staging)
    try:
        yield staging
        open(os.path.join(staging, "_SUCCESS"), "w").close()
        old = f"{final}.old"
        if os.path.exists(final):  # else an earlier run ended between the two renames, and what it set aside is all there is
            shutil.rmtree(old, ignore_errors=True)
            os.rename(final, old)
        try:
            os.rename(staging, final)
        except BaseException:
            if os.path.exists(old):
                os.rename(old, final)
            raise
        shutil.rmtree(old, ignore_errors=True)
    except BaseException:
        shutil.rmtree(staging, ignore_errors=True)
        raise


def write_tables(tables: Mapping[str, DataFrame], final: str, partition_by: Mapping[str, list[str]] | None = None) -> None:
    """All tables or none, as zstd Parquet; a table without rows keeps its columns."""
    with committed(final) as folder:
        for name, df in tables.items():
            w = df.write.option("compression", "zstd")
            if partition_by and partition_by.get(name):
                w = w.partitionBy(*partition_by[name])
            w.parquet(os.path.join(folder, name))


def export_csv(df: DataFrame, path: str, single: bool = False) -> int:
    """Writes CSV with header and gives the number of rows, counted while they are written. Lists become text joined by '|',
    other nested values JSON. ``single``: one file, through one task; only for what a reader opens by hand."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    seen = Observation("export")
    out = df.select(*cols).observe(seen, F.count(F.lit(1)).alias("n"))
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).csv(path)
    return seen.get["n"]


def report(tables: Mapping[str, DataFrame]) -> str:
    """Small aggregates as fixed-width text, all their rows."""
    parts = []
    for title, df in tables.items():
        rows = [tuple("" if v is None else str(v) for v in r) for r in df.collect()]
        width = [max([len(c), *(len(r[n]) for r in rows)]) for n, c in enumerate(df.columns)]
        line = lambda r, width=width: "  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip()
        parts.append("\n".join([f"== {title}", line(df.columns), *map(line, rows)]))
    return "\n\n".join(parts) + "\n"


class Store(Protocol):
    def put(self, local: str, key: str) -> None: ...
    def get(self, key: str, local: str) -> None: ...
    def keys(self, prefix: str = "") -> list[str]: ...
    def delete(self, key: str) -> None: ...
    def size(self, key: str) -> int: ...


class FolderStore:
    """An object store in a folder; keys are relative paths that stay inside."""

    def __init__(self, root: str) -> None:
        self.root = os.path.abspath(root)

    def _path(self, key: str) -> str:
        p = os.path.abspath(os.path.join(self.root, key))
        if not p.startswith(self.root + os.sep):
            raise ValueError(f"key outside the store: {key}")
        return p

    def put(self, local: str, key: str) -> None:
        p = self._path(key)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        shutil.copyfile(local, f"{p}.part")
        os.replace(f"{p}.part", p)

    def get(self, key: str, local: str) -> None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        shutil.copyfile(self._path(key), f"{local}.part")
        os.replace(f"{local}.part", local)

    def keys(self, prefix: str = "") -> list[str]:
        found = [os.path.relpath(os.path.join(d, f), self.root) for d, _, fs in os.walk(self.root) for f in fs]
        return sorted(k for k in found if k.startswith(prefix))

    def delete(self, key: str) -> None:
        os.remove(self._path(key))

    def size(self, key: str) -> int:
        return os.path.getsize(self._path(key))


def digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while piece := f.read(PIECE):
            h.update(piece)
    return h.hexdigest()


def publish(folder: str, store: Store, snapshot_date: str, schema_version: int = 1, keep: int = 2, notify: Callable[[dict], None] | None = None, dry_run: bool = False) -> dict:
    """Uploads a committed folder under its date, checks the sizes, writes the manifest last, keeps the newest ``keep`` dates."""
    datetime.date.fromisoformat(snapshot_date)
    if not os.path.exists(os.path.join(folder, "_SUCCESS")):
        raise ValueError(f"{folder} isn't a committed table set")
    local = {os.path.relpath(os.path.join(d, f), folder): os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.startswith(".")}
    manifest = {
        "snapshot_date": snapshot_date, "schema_version": schema_version,
        "files": {k: {"bytes": os.path.getsize(p), "sha256": digest(p)} for k, p in sorted(local.items())},
    }
    if dry_run:
        return manifest
    for k, p in local.items():
        key = f"{snapshot_date}/{k}"
        store.put(p, key)
        if store.size(key) != manifest["files"][k]["bytes"]:
            raise OSError(f"{key} arrived with another size")
    text = f"{folder}.manifest"
    with open(text, "w") as f:
        json.dump(manifest, f)
    try:
        store.put(text, MANIFEST)
    finally:
        os.remove(text)
    dates = sorted({k.split("/")[0] for k in store.keys() if "/" in k}, reverse=True)
    for old in dates[keep:]:
        for k in store.keys(f"{old}/"):
            store.delete(k)
    if notify:
        notify(manifest)
    return manifest


def manifest_of(store: Store, cache: str) -> dict:
    local = os.path.join(cache, MANIFEST)
    store.get(MANIFEST, local)
    with open(local) as f:
        m = json.load(f)
    if lacking := [k for k in REQUIRED if k not in m]:
        raise ValueError(f"the manifest lacks {lacking}")
    return m


def load(store: Store, cache: str, schema_version: int = 1) -> str:
    """The folder of the published tables: files in the cache that match in size and hash are used, others fetched; whatever
    doesn't match then is an error."""
    m = manifest_of(store, cache)
    if m["schema_version"] != schema_version:
        raise ValueError(f"published with schema version {m['schema_version']}, not {schema_version}")
    folder = os.path.join(cache, m["snapshot_date"])
    for k, want in m["files"].items():
        local = os.path.join(folder, k)
        matches = lambda local=local, want=want: os.path.exists(local) and os.path.getsize(local) == want["bytes"] and digest(local) == want["sha256"]
        if not matches():
            store.get(f"{m['snapshot_date']}/{k}", local)
            if not matches():
                os.remove(local)
                raise OSError(f"{k} isn't what the manifest says")
    return folder
