"""Metrics over files, tables and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.functions.scores import efficiency, overall_score, schema_complexity
from jsonloom.sources.documents import name_timestamp


def size_metrics(files: DataFrame) -> DataFrame:
    """Number and size of files, from :func:`list_files`."""
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.avg("length").alias("size_bytes_avg"),
        F.min("length").alias("size_bytes_min"), F.max("length").alias("size_bytes_max"),
        F.sum("length").alias("size_bytes_total"),
    )


def entities_per_document(records: DataFrame) -> DataFrame:
    """Records per document: ``(path, block_start, line_id, entities)``."""
    return records.groupBy("path", "block_start", "line_id").agg(F.count(F.lit(1)).alias("entities"))


def entity_metrics(records: DataFrame) -> DataFrame:
    return entities_per_document(records).agg(
        F.avg("entities").alias("entities_avg"), F.min("entities").alias("entities_min"),
        F.max("entities").alias("entities_max"), F.sum("entities").alias("entities_total"),
    )


def arrival_times(files: DataFrame, path: str = "path", fallback: str = "modificationTime") -> DataFrame:
    """Files with ``arrived_at``: the time in the file name, else the file time."""
    return files.withColumn("arrived_at", F.coalesce(name_timestamp(F.col(path)), F.col(fallback)))


def rates(metrics: DataFrame, seconds: Column, expected: Column, count: str = "files") -> DataFrame:
    """Add files per second and completion in percent (null without an expectation)."""
    rate = F.when(seconds > 0, F.col(count) / seconds).otherwise(F.lit(0.0))
    return metrics.withColumn("files_per_second", rate).withColumn(
        "completion_pct", F.when(expected > 0, 100.0 * F.col(count) / expected)
    )


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table. Parquet answers the count from its footers."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def table_totals(stats: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Totals over :func:`table_stats`; with ``sizes`` (table_name, bytes) also megabytes and bytes per record."""
    if sizes is None:
        return stats.agg(F.count(F.lit(1)).alias("tables"), F.sum("record_count").alias("total_records"))
    joined = stats.join(sizes, "table_name", "left")
    total = F.sum("record_count")
    return joined.agg(
        F.count(F.lit(1)).alias("tables"), total.alias("total_records"),
        (F.sum("bytes") / 1048576).alias("total_size_mb"),
        F.when(total > 0, F.sum("bytes") / total).alias("bytes_per_record"),
    )


def complexity(summary: DataFrame) -> DataFrame:
    """Schema complexity over a schema summary."""
    totals = summary.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("field_count").alias("fields"),
        F.sum(F.size("foreign_keys")).alias("foreign_keys"),
    )
    return totals.withColumn(
        "complexity", schema_complexity(F.col("tables"), F.col("fields"), F.col("foreign_keys"))
    )


def run_report(runs: DataFrame) -> DataFrame:
    """Efficiency and overall score per run: needs generation_rate, processing_rate, quality_score, errors."""
    scored = runs.withColumn(
        "efficiency", efficiency(F.col("generation_rate"), F.col("processing_rate"), F.col("quality_score"))
    )
    return scored.withColumn(
        "overall_score", overall_score(F.col("quality_score"), F.col("errors") == 0, F.col("efficiency"))
    )


def ingest_status(spark: SparkSession, batches: DataFrame) -> DataFrame:
    """Running totals of an ingest from its per-batch rows."""
    return batches.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed_count"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed_count"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped_count"),
        F.min("started_at").alias("running_since"),
        (F.unix_micros(F.max("finished_at")) - F.unix_micros(F.min("started_at"))).alias("_us"),
    ).withColumn("uptime_seconds", F.col("_us") / 1e6).drop("_us")
