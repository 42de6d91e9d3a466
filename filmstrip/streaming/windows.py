"""Windowed counts and sessions over event time, with watermarks for late rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filmstrip.session import work_folder


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 10) -> DataFrame:
    """A stream of the Parquet files under a path, a bounded number of files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _timed(events: DataFrame, ts: str) -> DataFrame:
    """Event time must be an instant; a time without a zone is one of the session's zone."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def rates(events: DataFrame, ts: str, key: str, late: str = "10 minutes", width: str = "60 seconds", slide: str | None = None) -> DataFrame:
    """Counts per key in windows of event time; rows more than `late` behind are dropped."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return _timed(events, ts).withWatermark(ts, late).groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def sessions(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a key: parted by gaps without an event."""
    return _timed(events, ts).withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Works off what is there, batch by batch, and ends; goes on from the checkpoint when called again."""
    q = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def to_files(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """What a stream gives for all that is there, as a table of Parquet files in the shared work folder, read back. In
    mode complete each batch replaces the result, in append and update it adds to it; each batch is written to a folder
    of its own, so one that is tried again doesn't count twice."""
    folder = f"{work_folder(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={number}")

    run_available(stream, each, f"{folder}/checkpoint", mode)
    spark = stream.sparkSession
    empty = spark.createDataFrame([], stream.schema)
    empty.write.mode("append").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch=-1")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
