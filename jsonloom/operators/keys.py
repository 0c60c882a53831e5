"""Keys, relationships and documentation facts derived from a field profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonloom.functions.names import BASIC_DESCRIPTIONS, describe_field, is_key_name, parent_candidates


def primary_keys(profile: DataFrame) -> DataFrame:
    """``(table, primary_key)``: ``<table>_id`` if present, else the first key-like field; never one that held a null."""
    preferred = F.col("field") == F.concat("table", F.lit("_id"))
    rank = F.struct((~preferred).alias("later"), F.col("field_order"))
    return (
        profile.where(is_key_name(F.col("field")) & ~F.col("nullable"))
        .groupBy("table")
        .agg(F.min_by("field", rank).alias("primary_key"))
    )


def foreign_keys(
    profile: DataFrame, tables: DataFrame, keys: DataFrame, plurals: str = "basic", mode: str = "default"
) -> DataFrame:
    """``(from_table, foreign_key, to_table)``: the first candidate name that is a table."""
    candidates = (
        profile.join(keys, "table", "left")
        .where(is_key_name(F.col("field")) & ~F.col("field").eqNullSafe(F.col("primary_key")))
        .select(
            "table", "field", "field_order",
            F.posexplode(parent_candidates(F.col("field"), plurals, mode)).alias("rank", "to_table"),
        )
    )
    known = tables.select(F.col("table").alias("to_table"))
    return (
        candidates.join(known, "to_table")
        .groupBy("table", "field", "field_order")
        .agg(F.min_by("to_table", "rank").alias("to_table"))
        .select(F.col("table").alias("from_table"), F.col("field").alias("foreign_key"), "to_table", "field_order")
    )


def relationships(foreign: DataFrame) -> DataFrame:
    """Edge list; the type is always one_to_many."""
    return foreign.select("from_table", "to_table", "foreign_key", F.lit("one_to_many").alias("relationship_type"))


def er_edges(edges: DataFrame) -> DataFrame:
    """One entity-relationship diagram line per edge."""
    line = F.format_string(
        '    %s ||--o{ %s : "%s"', F.upper("to_table"), F.upper("from_table"), F.col("foreign_key")
    )
    return edges.select("from_table", "foreign_key", "to_table", line.alias("edge"))


def schema_summary(tables: DataFrame, profile: DataFrame, keys: DataFrame, foreign: DataFrame) -> DataFrame:
    """One row per table: counts, primary key, foreign keys as ``field->table``."""
    fields = profile.groupBy("table").agg(F.count(F.lit(1)).alias("field_count"))
    links = foreign.groupBy(F.col("from_table").alias("table")).agg(
        F.array_sort(F.collect_list(F.concat("foreign_key", F.lit("->"), "to_table"))).alias("foreign_keys")
    )
    return (
        tables.select("table", "record_count", "first_seen")
        .join(fields, "table", "left")
        .join(keys, "table", "left")
        .join(links, "table", "left")
        .select(
            "table", "record_count", F.coalesce("field_count", F.lit(0)).cast("bigint").alias("field_count"),
            "primary_key", F.coalesce("foreign_keys", F.array().cast("array<string>")).alias("foreign_keys"),
            "first_seen",
        )
    )


def field_descriptions(profile: DataFrame, foreign: DataFrame, rules=BASIC_DESCRIPTIONS) -> DataFrame:
    links = foreign.select(F.col("from_table").alias("table"), F.col("foreign_key").alias("field"), "to_table")
    return profile.join(links, ["table", "field"], "left").withColumn(
        "description", describe_field(F.col("field"), F.col("to_table"), rules)
    )


def catalog_completeness(summary: DataFrame) -> DataFrame:
    """Share of tables with a primary key, and a score that loses 5 per table without one."""
    keyed = F.count("primary_key")
    total = F.count(F.lit(1))
    return summary.agg(
        total.alias("tables"),
        F.sum("record_count").alias("records"),
        keyed.alias("tables_with_key"),
        F.when(total > 0, keyed / total * 100).alias("completeness_pct"),
        (100.0 - 5.0 * (total - keyed)).alias("score"),
    )
