"""Arrival rates of files over event-time windows, with a bound on lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jsonloom.operators.metrics import arrival_times
from jsonloom.sources.documents import stream_files


def arrival_rates(files: DataFrame, width: str, lateness: str, slide: str | None = None) -> DataFrame:
    """Files and bytes per window of the time in their names: ``window_start, window_end, files, bytes, files_per_second``.

    A file that is more than ``lateness`` behind the newest one of the batches before, and whose window is closed by that, is
    dropped; every other file counts in its window, also when it comes late.
    """
    timed = arrival_times(files).withWatermark("arrived_at", lateness)
    window = F.window("arrived_at", width, slide) if slide else F.window("arrived_at", width)
    counted = timed.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    seconds = (F.unix_micros("w.end") - F.unix_micros("w.start")) / 1e6
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "files", "bytes", (F.col("files") / seconds).alias("files_per_second")
    )


def start_rates(
    spark: SparkSession, source: str, sink: str, checkpoint: str, width: str, lateness: str, slide: str | None = None, glob: str = "*.json",
    interval: str | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """Write every window to ``sink`` (Parquet) once, when it is closed: when a file came that is ``lateness`` after its end."""
    rates = arrival_rates(stream_files(spark, source, glob, max_files), width, lateness, slide)
    writer = rates.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
