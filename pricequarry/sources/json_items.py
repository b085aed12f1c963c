"""A Spark data source for very large JSON objects: the elements of named top-level lists as rows.

``spark.read.format("json_items").option("path", ...).option("lists", "in_network,provider_references").load()`` gives one row
per element of a named list and one per other top-level key, whatever the order of keys: (file, top_key, idx, raw, sha256,
n_bytes). ``raw`` is the element's own text, so numbers keep every digit. Files are opened by content, gzip or plain, and read
in pieces: a task's memory holds one element. One partition per file: neither gzip nor a JSON object can be split.

The options ``keys`` and ``positions`` name the top-level keys and list positions to read; other elements are passed over without
being built. Filters on top_key and idx do the same with the option ``pushdown``. It is off by default: Spark keeps what was pushed
with the loaded relation, so that a relation scanned twice in one query, with different filters, would read too little.
"""

from __future__ import annotations

import glob
import gzip
import hashlib
import io
import os
import re
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from pricequarry.session import local_path

SCHEMA = "file string, top_key string, idx long, raw string, sha256 string, n_bytes long"
PIECE = 1 << 20
GZIP = b"\x1f\x8b"
SPACE = re.compile(r"[ \t\r\n]*")
PLAIN = re.compile(r"[^\"\\]*")  # inside a string, up to what matters
FLAT = re.compile(r"[^\"{}\[\]]*")  # outside strings, up to what matters
SCALAR = re.compile(r"[^,\]}\s]*")


class JsonError(ValueError):
    """The text isn't the JSON object it should be."""


def is_url(path: str) -> bool:
    return re.match(r"https?://", path) is not None


class HashedFile(io.RawIOBase):
    """A file, or what a URL serves, whose bytes are hashed and counted as they are read."""

    def __init__(self, path: str) -> None:
        self.inner = urllib.request.urlopen(path) if is_url(path) else open(path, "rb")  # noqa: S310, SIM115
        self.hash, self.n = hashlib.sha256(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.inner.read(len(buffer))
        self.hash.update(data)
        self.n += len(data)
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.inner.close()
        super().close()


def open_text(path: str) -> tuple[io.TextIOBase, HashedFile]:
    """The text of a plain or gzip file, told apart by its first bytes, and the hasher of the bytes as stored."""
    source = HashedFile(path)
    buffered = io.BufferedReader(source, PIECE)
    zipped = buffered.peek(2)[:2] == GZIP
    return io.TextIOWrapper(gzip.GzipFile(fileobj=buffered) if zipped else buffered, "utf-8-sig"), source


class Scanner:
    """Reads JSON text in pieces and cuts out values as they stand; what was passed is dropped."""

    def __init__(self, text: io.TextIOBase) -> None:
        self.text, self.buffer, self.at, self.ended = text, "", 0, False

    def more(self) -> bool:
        if self.ended:
            return False
        piece = self.text.read(PIECE)
        self.ended = not piece
        self.buffer += piece
        return bool(piece)

    def peek(self) -> str:
        """The next character that is no space; '' at the end."""
        while True:
            self.at = SPACE.match(self.buffer, self.at).end()
            if self.at < len(self.buffer):
                return self.buffer[self.at]
            self.buffer, self.at = "", 0
            if not self.more():
                return ""

    def take(self, expected: str) -> str:
        c = self.peek()
        if not c or c not in expected:
            raise JsonError(f"expected one of {expected!r}, found {c!r}")
        self.at += 1
        return c

    def _advance(self, pattern: re.Pattern, i: int) -> int:
        while (end := pattern.match(self.buffer, i).end()) == len(self.buffer):
            if not self.more():
                return end
            i = end
        return end

    def _string(self, i: int) -> int:
        """Past the string that begins at i."""
        i += 1
        while True:
            i = self._advance(PLAIN, i)
            if i >= len(self.buffer):
                raise JsonError("a string isn't closed")
            if self.buffer[i] == '"':
                return i + 1
            i += 2
            while i > len(self.buffer):
                if not self.more():
                    raise JsonError("a string isn't closed")

    def value(self, keep: bool = True) -> str | None:
        """The text of the next value; None if it isn't to be kept, then its passed text isn't held either."""
        c = self.peek()
        self.buffer, self.at = self.buffer[self.at :], 0
        if not c:
            raise JsonError("the text ends too early")
        if c == '"':
            i = self._string(0)
        elif c in "{[":
            depth, i = 0, 0
            while True:
                c = self.buffer[i]
                if c == '"':
                    i = self._string(i)
                else:
                    depth += 1 if c in "{[" else -1
                    i += 1
                    if not depth:
                        break
                if not keep and i > PIECE:
                    self.buffer, i = self.buffer[i:], 0
                i = self._advance(FLAT, i)
                if i >= len(self.buffer):
                    raise JsonError("a value isn't closed")
        else:
            i = self._advance(SCALAR, 0)
            if not i:
                raise JsonError(f"unexpected {c!r}")
        out = self.buffer[:i] if keep else None
        self.at = i
        return out


def top_level(text: io.TextIOBase, lists: set[str], wanted: Callable[[str, int | None], bool] = lambda key, idx: True) -> Iterator[tuple[str, int | None, str]]:
    """(key, idx, raw) of a JSON object: each element of the named lists, each other value whole, with idx None.

    A named key whose value is no list is given whole. An unwanted value is passed over.
    """
    import json

    s = Scanner(text)
    s.take("{")
    if s.peek() == "}":
        s.take("}")
    else:
        while True:
            key = json.loads(s.value() or "")
            s.take(":")
            if key in lists and s.peek() == "[":
                s.take("[")
                if s.peek() == "]":
                    s.take("]")
                else:
                    idx = 0
                    while True:
                        raw = s.value(keep := wanted(key, idx))
                        if keep:
                            yield key, idx, raw
                        idx += 1
                        if s.take(",]") == "]":
                            break
            else:
                raw = s.value(keep := wanted(key, None))
                if keep:
                    yield key, None, raw
            if s.take(",}") == "}":
                break
    if s.peek():
        raise JsonError("text after the object")


class JsonItems(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_items"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ItemReader:
        return ItemReader(self.options)


class File(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)


class ItemReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options.get("path", "")
        self.lists = {x.strip() for x in options.get("lists", "").split(",") if x.strip()}
        named = lambda o: {x.strip() for x in options[o].split(",")} if options.get(o) else None
        self.keys: set[str] | None = named("keys")
        self.positions: set[int] | None = {int(x) for x in named("positions")} if named("positions") else None
        self.pushdown = options.get("pushdown", "false").lower() == "true"

    def pushFilters(self, filters):
        for f in filters:
            if not self.pushdown:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("top_key",):
                self.keys = values if self.keys is None else self.keys & values
            elif values is not None and f.attribute == ("idx",):
                self.positions = values if self.positions is None else self.positions & values
            yield f  # checked again by Spark

    def partitions(self) -> list[File]:
        out = []
        for p in self.path.split(","):
            if is_url(p):
                out.append(File(p))
                continue
            p = local_path(p)
            found = sorted(glob.glob(os.path.join(p, "*"))) if os.path.isdir(p) else sorted(glob.glob(p))
            out += [File(x) for x in found if os.path.isfile(x) and not os.path.basename(x).startswith(("_", "."))]
        if not out:
            raise FileNotFoundError(self.path)
        return out

    def read(self, partition: File):
        def wanted(key: str, idx: int | None) -> bool:
            return (self.keys is None or key in self.keys) and (self.positions is None or idx in self.positions)

        text, source = open_text(partition.value)
        try:
            for key, idx, raw in top_level(text, self.lists, wanted):
                yield partition.value, key, idx, raw, None, None
            while source.read(PIECE):
                pass
            if wanted("_file", None):
                yield partition.value, "_file", None, None, source.hash.hexdigest(), source.n
        finally:
            text.close()
            source.close()


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(JsonItems)
