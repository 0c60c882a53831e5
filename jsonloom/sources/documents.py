"""JSON document sources: one document per file or one per line, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.functions.json_values import one_object

# Position of a document in arrival order.
DOC_POSITION = ["file_order", "path", "block_start", "line_id"]

# name_YYYYMMDD_HHMMSS_ffffff.json, or a folder of that name around the file; fixed format
NAME_STAMP = r"(\d{8}_\d{6}_\d{6})(?:\.[^/]*)?(?:/[^/]*)?$"
NAME_STAMP_FORMAT = "yyyyMMdd_HHmmss_SSSSSS"


def name_timestamp(path: Column) -> Column:
    """Timestamp written in a file name, null when there is none."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(path, NAME_STAMP, 1), F.lit("")), F.lit(NAME_STAMP_FORMAT))


def few_listing_tasks(spark: SparkSession) -> None:
    """Have files listed by some tasks a core. Spark's own number, a task per path up to 10,000, costs each path a task and
    the driver that task's result."""
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * max(8, spark.sparkContext.defaultParallelism)))


def _reader(source, lines: bool, glob: str, recursive: bool):
    return source.format("text").option("wholetext", not lines).option("pathGlobFilter", glob).option(
        "recursiveFileLookup", recursive
    )


def file_order() -> Column:
    """Place of the file a row comes from in arrival order: the time in its name, else its own, in microseconds."""
    return F.unix_micros(F.coalesce(name_timestamp(F.col("_metadata.file_path")), F.col("_metadata.file_modification_time")))


def _located(raw: DataFrame) -> DataFrame:
    return raw.select(
        file_order().alias("file_order"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").cast("bigint").alias("block_start"),
        F.col("value").alias("text"),
    )


def number_lines(docs: DataFrame, lines: bool = True) -> DataFrame:
    """Add ``line_id``. Lines of one block stay together and in order, so (block, id) orders the lines of a file."""
    line_id = F.monotonically_increasing_id() if lines else F.lit(0).cast("bigint")
    return docs.withColumn("line_id", line_id)


def read_documents(
    spark: SparkSession, path: str | list[str], lines: bool = False, glob: str = "*.json", recursive: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """Documents under ``path`` as ``(file_order, path, block_start, line_id, text)``.

    With ``lines=False`` a file is one document, read by one task; large files are for
    :func:`~jsonloom.operators.large.shred_files`, or have one document per line (``lines=True``). ``max_bytes`` leaves out
    larger files; they are not opened.
    """
    few_listing_tasks(spark)
    raw = _reader(spark.read, lines, glob, recursive).load(path)
    if max_bytes is not None:
        raw = raw.where(F.col("_metadata.file_size") <= max_bytes)
    if lines:
        raw = raw.where(F.length(F.trim("value")) > 0)
    return number_lines(_located(raw), lines)


def stream_files(
    spark: SparkSession, path: str, glob: str = "*.json", max_files: int | None = None, archive_dir: str | None = None,
    delete_source: bool = False,
) -> DataFrame:
    """Unbounded listing of the files that arrive under ``path``: ``(path, length, modificationTime)``, every file once.

    Contents are not read, so no file can fail the stream; a file that is gone again before it is looked at is left out.
    """
    few_listing_tasks(spark)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("ignoreMissingFiles", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    elif delete_source:
        reader = reader.option("cleanSource", "delete")
    return reader.load(path).select("path", "length", "modificationTime")


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """File metadata ``(path, length, modificationTime)``; contents are not read."""
    few_listing_tasks(spark)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def sample_documents(
    spark: SparkSession, path: str, files: int = 50, lines: bool = False, glob: str = "*.json", recursive: bool = False
) -> DataFrame:
    """Documents of the first ``files`` files by path. Only those files are opened."""
    first = list_files(spark, path, glob, recursive).orderBy("path").limit(files)
    paths = [row.path for row in first.select("path").collect()]
    if not paths:
        return read_documents(spark, path, lines, glob, recursive)
    return read_documents(spark, paths, lines, "*", False)


def quarantine(docs: DataFrame) -> DataFrame:
    """Documents that are not one well-formed JSON object, with their whole text."""
    return docs.where(one_object(F.col("text")).isNull()).withColumn("reason", F.lit("not a JSON object"))
