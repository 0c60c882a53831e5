"""Contiguous shards of nearly equal byte size, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage

ROW_KEY = ("doc_id", "text_crc32", "text_hash")
#: copies of one row that a single sequence may hold
RUN = 100_000


def sized(docs: DataFrame, overhead: int = 8) -> DataFrame:
    """The columns that decide a row's place: its id, its size in UTF-8 bytes plus ``overhead``, and two hashes of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )


def placed_units(docs: DataFrame, overhead: int) -> DataFrame:
    """One row per distinct (id, text): its key, ``copies``, and the first copy's place among all bytes and rows
    (``start`` of ``total``, ``row``)."""
    units = sized(docs, overhead).groupBy("doc_id", "size", "text_crc32", "text_hash").agg(F.count("*").alias("copies"))
    ranged = cut_lineage(units.repartitionByRange(*ROW_KEY).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (
        ranged.groupBy("part")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*ROW_KEY, "size").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", "text_hash", "copies", "total",
        (F.col("bytes_before") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0))).alias("start"),
        (F.col("rows_before") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("row"),
    )


def shard_of(shards: int):
    return F.expr(f"cast(least({shards} - 1, (start + copy * size) * {shards} div total) as int)")


def each_copy(units: DataFrame, shards: int) -> DataFrame:
    return (
        units.withColumn("run", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})")))
        .withColumn("copy", F.explode(F.expr(f"sequence(run * {RUN}, least(copies, (run + 1) * {RUN}) - 1)")))
        .withColumns({"shard": shard_of(shards), "row": F.col("row") + F.col("copy")})
    )


def shard_by_bytes(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, text_hash, copy, shard, slot``.

    Rows are ordered by (doc_id, nulls first; text hashes), dealt to range partitions, and a row's global offset is
    its partition's offset (the sum of the totals of all partitions before it) plus the running sum inside the
    partition. Shard k takes the rows whose offset lies in the k-th of ``shards`` equal parts of all bytes, so a
    shard is a contiguous run of the order and misses its target by one row at most; ``slot`` numbers its rows from 0.
    Only ids, sizes and hashes are shuffled, never texts. Rows equal in id and text are one unit with a count until
    the end (``copy`` numbers them), so any number of repeats stays one row of a task.

    Null texts have the size ``overhead``; null ids come first; an empty table gives no rows; other columns are not read.
    """
    placed = each_copy(placed_units(docs, overhead), shards)
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "text_hash", "copy", "shard", (F.col("row") - F.col("first")).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` added; ValueError if it has columns of these names.

    The texts are shuffled once, to meet their units; copies of a row are numbered where they meet. Nulls, ties, repeated
    rows and empty tables are as in ``shard_by_bytes``; other columns, also of the names used here inside, stay as they are.
    """
    taken = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"columns named {sorted(taken)} are in the way; rename them first")
    text = F.coalesce(F.col("text"), F.lit(""))
    some, none = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), F.col("doc_id").isNull()
    rows = docs.select(
        F.struct("*").alias("document"), some.alias("id"), none.alias("no_id"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("hash")
    )
    units = cut_lineage(placed_units(docs, overhead))
    first = each_copy(units, shards).groupBy("shard").agg(F.min("row").alias("first"))
    keyed = units.select(
        some.alias("id"), none.alias("no_id"), F.col("text_crc32").alias("crc"), F.col("text_hash").alias("hash"), "size", "total", "start", "row"
    )
    key = ["id", "no_id", "crc", "hash"]
    copies = Window.partitionBy(*key).orderBy("start")
    met = rows.join(keyed, key).withColumn("copy", F.row_number().over(copies).cast("bigint") - 1).withColumn("shard", shard_of(shards))
    return met.join(F.broadcast(first), "shard").select("document.*", "shard", (F.col("row") + F.col("copy") - F.col("first")).alias("slot"))
