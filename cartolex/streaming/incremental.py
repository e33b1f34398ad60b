"""Regions as they arrive: new files of a folder are read as a stream and each is processed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_regions(spark: SparkSession, folder: str, schema: T.StructType, files_at_once: int = 64) -> DataFrame:
    """A stream of the rows of Parquet files in a folder, with the file each came from."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    return stream.withColumn("_file", F.col("_metadata.file_name"))


def process(stream: DataFrame, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Run `step` over every micro-batch and write its rows under the batch's own number.

    The checkpoint remembers files that are done. A batch that is run again after a failure overwrites its folder, so
    rows are in the target once.
    """

    def one(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={number:08d}")

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
