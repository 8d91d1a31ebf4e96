"""Incremental work with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_threads(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 16, kept: str | None = "30 days") -> DataFrame:
    """A stream of the threads under a folder of JSON lines, each address once.

    What was seen is in the checkpoint's state for as long as ``kept`` after the file that brought it, so the state doesn't grow for ever; a
    thread that comes again later is left out by not_done against what was written.  None keeps all addresses.
    """
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    if kept is None:
        return files.dropDuplicates(["url"])
    timed = files.select("*", F.col("_metadata.file_modification_time").alias("arrived"))
    return timed.withWatermark("arrived", kept).dropDuplicatesWithinWatermark(["url"]).drop("arrived")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str):
    """Handles all that is there, batch by batch; a batch counts only once it is whole, and a restart goes on behind the last one."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to its own folder, so a batch that is handled again replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return handle
