"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage

#: runs that one merge step takes in
FAN_IN = 8
KEY = ("text_sha256", "norm_chars", "norm_hash")


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def digests(docs: DataFrame) -> DataFrame:
    """One slim row per document: its row number, id, length and the digest of its normalised text."""
    norm = normalised(F.col("text"))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
        F.sha2(norm.cast("binary"), 256).alias("text_sha256"),
        F.length(norm).alias("norm_chars"),
        F.xxhash64(norm).alias("norm_hash"),
    )


def merged_runs(rows: DataFrame) -> DataFrame:
    """Winner and size of each group: ``text_sha256, norm_chars, norm_hash, best, group_size``.

    Every input partition starts as a run in one of FAN_IN^rounds cells. In round r a cell and the cells that differ
    from it in digit r exchange what they hold: each keeps the digests whose own digit r is its own. Digests equal
    in hash, length and a second hash merge into one row on both sides of an exchange, which keeps the best
    candidate, so what a round moves shrinks and a hot digest is one row per cell. After the last round a digest's
    rows are in the one cell named by its hash: the cells together are the merged run, and none holds it whole.
    """
    spark = rows.sparkSession
    rounds = 1
    while FAN_IN**rounds < int(spark.conf.get("spark.sql.shuffle.partitions")):
        rounds += 1
    cells = FAN_IN**rounds
    best = F.struct(
        (-F.col("n_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")
    )
    runs = rows.select(
        *KEY, best.alias("best"), F.lit(1).cast("bigint").alias("group_size"),
        F.pmod(F.shiftright("row", 33), F.lit(cells)).cast("int").alias("cell"),
        F.pmod(F.xxhash64("text_sha256"), F.lit(cells)).cast("int").alias("home"),
    )
    for r in range(rounds):
        unit = FAN_IN**r
        digit = lambda c: (F.floor(F.col(c) / unit) % FAN_IN).cast("int")
        runs = (
            runs.withColumn("cell", F.col("cell") + (digit("home") - digit("cell")) * unit)
            .groupBy("cell", "home", *KEY)
            .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))
        )
    return runs.select(*KEY, "best", "group_size")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, row``.

    Texts are equal when they agree after all ASCII white space is deleted. The row with the most code points in its
    original text stays, then the smallest doc_id (null counts as the largest), then the first of repeated rows, so
    exactly one row of a group is kept. Null texts count as empty; an empty table gives no rows; other columns are
    not read. Texts are read once: digests go to the shared folder and only they are shuffled.
    """
    rows = cut_lineage(digests(docs))
    winners = merged_runs(rows)
    return rows.join(winners, list(KEY)).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "row"
    )
