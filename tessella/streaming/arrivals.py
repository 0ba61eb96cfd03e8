"""Sample files that arrive one after another, as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def arriving(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """Rows of the files of a folder, new files as they come."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(folder)


def counts_by_window(rows: DataFrame, time: str, group: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows of each group and time window; what comes later than ``late`` is not counted."""
    return rows.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), group).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), group, "n")


def once_only(rows: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Rows whose key was not seen within the time that late rows may take."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def each_batch(rows: DataFrame, run: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Runs a batch operator over every arriving batch and writes its result under the batch's number.

    A batch that runs again after a failure overwrites what it wrote, so each result is there once.
    """

    def write(batch: DataFrame, number: int) -> None:
        run(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
