"""Files that keep arriving: each is taken once, in the order of arrival, and replaces what its key had before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_files(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    """The rows of files that weren't there before, with the name of the file."""
    s = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).load(folder)
    return s.withColumn("source_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


def take_new(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hands over all that has arrived, batch by batch, and ends; the checkpoint remembers which files were taken."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into_table(path: str, partition: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch so that its partitions replace those in the table: a batch that runs again changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return write


def arrivals_per_window(stream: DataFrame, at: str, by: str, window: str = "1 day", lateness: str = "7 days") -> DataFrame:
    """Rows per window of their own time and per group; what is later than the watermark is left out of closed windows."""
    w = stream.withWatermark(at, lateness).groupBy(F.window(at, window).alias("w"), by)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
