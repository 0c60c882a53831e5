"""Outcomes of an ingest whose first documents are all cut off."""

from pyspark.sql import functions as F

from jsonloom.workload import QUERIES


def test_outcomes_when_the_first_lines_are_all_cut_off(spark, tmp_path):
    status = F.when(F.col("id") >= 5000, "O").otherwise("F")
    orders = spark.range(10, 5050).select(F.col("id").alias("o_orderkey"), status.alias("o_orderstatus"))
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    row = QUERIES["ingest_outcomes"](spark, str(tmp_path)).first()
    assert (row.processed_count, row.failed_count, row.skipped_count, row.input_rows) == (5, 499, 0, 504)
