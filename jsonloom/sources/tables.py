"""Parquet tables and schema sidecars."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.quality.integrity import Reference

FIELD_FACTS = T.StructType(
    [
        T.StructField("data_types", T.ArrayType(T.StringType())),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("is_list", T.BooleanType()),
        T.StructField("max_length", T.LongType()),
        T.StructField("foreign_key_to", T.StringType()),
        T.StructField("sample_values", T.ArrayType(T.StringType())),
    ]
)
SCHEMA_SIDECAR = T.StructType(
    [
        T.StructField("detection_timestamp", T.StringType()),
        T.StructField("total_tables", T.LongType()),
        T.StructField(
            "tables",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("record_count", T.LongType()),
                        T.StructField("field_count", T.LongType()),
                        T.StructField("primary_key", T.StringType()),
                        T.StructField("foreign_keys", T.MapType(T.StringType(), T.StringType())),
                        T.StructField("fields", T.MapType(T.StringType(), FIELD_FACTS)),
                    ]
                ),
            ),
        ),
    ]
)
RELATIONSHIP_SIDECAR = T.StructType(
    [
        T.StructField(
            "relationships",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.StringType()) for n in ("from_table", "to_table", "foreign_key", "relationship_type")]
                )
            ),
        )
    ]
)


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame] | None:
    """``<folder>/<name>.parquet`` per name, or None when one of them cannot be read."""
    try:
        return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
    except AnalysisException:
        return None


def read_schema_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Tables of a schema document: ``(table, record_count, field_count, primary_key, foreign_keys, fields)``."""
    document = spark.read.schema(SCHEMA_SIDECAR).option("multiLine", True).json(path)
    return document.select(F.explode("tables").alias("table", "t")).select("table", "t.*")


def sidecar_fields(tables: DataFrame) -> DataFrame:
    """One row per (table, field) of a schema document."""
    return tables.select("table", F.explode("fields").alias("field", "f")).select("table", "field", "f.*")


def sidecar_relationships(spark: SparkSession, tables: DataFrame, path: str | None = None) -> DataFrame:
    """Edges of a relationship document; rebuilt from the schema document when there is none."""
    if path is not None:
        document = spark.read.schema(RELATIONSHIP_SIDECAR).option("multiLine", True).json(path)
        return document.select(F.explode("relationships").alias("r")).select("r.*")
    links = tables.select("table", F.explode("foreign_keys").alias("foreign_key", "to_table"))
    return links.select(
        F.col("table").alias("from_table"), "to_table", "foreign_key", F.lit("one_to_many").alias("relationship_type")
    )


def references_of(edges: DataFrame) -> list[Reference]:
    """Edges as check rules; there are as many as foreign keys in the schema."""
    rows = edges.orderBy("from_table", "foreign_key").collect()
    return [Reference(r.from_table, r.foreign_key, r.to_table) for r in rows]
