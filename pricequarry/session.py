"""Session settings and the two ways in which the library cuts a lineage."""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own settings."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("pricequarry")
    b = b.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, also where it was set on a running session. Where it is unset,
    a local session (tests) gets a temporary one; on a cluster that is an error, as no folder of one machine would do."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc._jsc.sc().getCheckpointDir().get()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pricequarry-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder in the shared one that isn't there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """The path of a folder as the file system of every machine has it, for readers that open files themselves: a shared folder must
    be mounted for these."""
    if not re.match(r"[a-z][a-z0-9+.-]*:", path):
        return path
    if not path.startswith("file:"):
        raise ValueError(f"{path} is on no mounted file system")
    return "/" + path.removeprefix("file:").lstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in any file system that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read from there; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def retried(f: Callable[[], T], times: int = 3, on: tuple[type[BaseException], ...] = (OSError,), wait: float = 1.0) -> T:
    """The result of ``f``, tried again after errors that may pass, each time after twice the wait; other errors are raised at once.
    What tasks do, Spark tries again by itself; this is for what the driver does."""
    for n in range(times):
        try:
            return f()
        except on:
            if n + 1 == times:
                raise
            time.sleep(wait * 2**n)
    raise ValueError("times must be positive")
