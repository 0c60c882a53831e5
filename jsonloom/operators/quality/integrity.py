"""Referential integrity checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.names import key_columns
from jsonloom.operators.quality.rows import INTEGRITY, SAMPLE, as_check, details, literal_checks, sample_list, text
from jsonloom.operators.relate import comparable, reference_counts


@dataclass(frozen=True)
class Reference:
    """A foreign key between two tables."""

    from_table: str
    foreign_key: str
    to_table: str


def target_key(reference: Reference, tables: dict[str, DataFrame], keys: dict[str, str | None]) -> str | None:
    columns = tables[reference.to_table].columns
    declared = keys.get(reference.to_table)
    if declared in columns:
        return declared
    return next(iter(key_columns(tables[reference.to_table])), None)


def precondition(
    reference: Reference, tables: dict[str, DataFrame], keys: dict[str, str | None]
) -> tuple[int, str, str, str] | None:
    """The failed precondition of a reference, decided from the schemas alone."""
    source, target = reference.from_table, reference.to_table
    if source not in tables or target not in tables:
        name = f"Table Existence for {source} → {target}"
        return INTEGRITY, name, "Missing table(s) for relationship validation", "ERROR"
    if reference.foreign_key not in tables[source].columns:
        name = f"Foreign Key Column {reference.foreign_key}"
        return INTEGRITY, name, f"Foreign key column {reference.foreign_key} not found in {source}", "ERROR"
    if target_key(reference, tables, keys) is None:
        name = f"Primary Key Detection for {target}"
        return INTEGRITY, name, f"Cannot determine primary key for table {target}", "WARNING"
    return None


def integrity_checks(
    spark: SparkSession, tables: dict[str, DataFrame], references: list[Reference], keys: dict[str, str | None]
) -> list[DataFrame]:
    """One check per reference: every non-null foreign key has a parent."""
    failed = [row for row in (precondition(r, tables, keys) for r in references) if row]
    parts = [literal_checks(spark, failed)] if failed else []
    for reference in references:
        if precondition(reference, tables, keys) is None:
            parts += _reference_check(spark, reference, tables, keys)
    return parts


def reference_row(summary: DataFrame, reference: Reference, primary_key: str, affected: Column | None = None) -> DataFrame:
    """The check row of a reference from its totals: ``total, refs, orphans, parents`` and ``values_``, some orphaned keys."""
    label = f"Referential Integrity: {reference.from_table}.{reference.foreign_key} → {reference.to_table}.{primary_key}"
    return as_check(
        summary, INTEGRITY, text(label), "orphans = 0", "'All foreign key references are valid'",
        "format_string('Found %d orphaned foreign key references', orphans)", "ERROR", "orphans",
        details(total_references="total", unique_references="refs"),
        details(
            orphaned_count="orphans", orphaned_values="to_json(values_)",
            total_foreign_keys="total", total_primary_keys="parents",
        ),
        affected,
    )


def key_type_checks(spark: SparkSession, reference: Reference, left: T.DataType, right: T.DataType) -> list[DataFrame]:
    """A warning where the two keys' types can never match."""
    if comparable(left, right):
        return []
    note = f"{left.simpleString()} and {right.simpleString()} keys never match"
    return [literal_checks(spark, [(INTEGRITY, f"Key Types: {reference.from_table}.{reference.foreign_key}", note, "WARNING")])]


def _reference_check(spark, reference: Reference, tables, keys) -> list[DataFrame]:
    child, parent = tables[reference.from_table], tables[reference.to_table]
    foreign_key, primary_key = reference.foreign_key, target_key(reference, tables, keys)
    per_key = reference_counts(child, foreign_key, parent, primary_key)
    summary = per_key.selectExpr("n", "fk", "pk", "if(fk is not null and pk is null, n, 0) as lost").agg(
        F.expr("coalesce(sum(n), 0) as total"), F.expr("count(fk) as refs"),
        F.expr("coalesce(sum(lost), 0) as orphans"), F.expr("count(pk) as parents"),
    )
    orphan_keys = per_key.where("fk is not null and pk is null")
    summary = summary.withColumn("values_", sample_list(orphan_keys, "fk"))
    ids = next((c for c in ("id", f"{reference.from_table}_id") if c in child.columns), None)
    affected = None
    if ids:
        few = orphan_keys.orderBy("fk").limit(SAMPLE).select("fk")  # at most SAMPLE keys to broadcast
        rows = child.join(F.broadcast(few), F.col(foreign_key) == F.col("fk"), "left_semi")
        affected = sample_list(rows, ids)
    parts = [reference_row(summary, reference, primary_key, affected)]
    return parts + key_type_checks(spark, reference, child.schema[foreign_key].dataType, parent.schema[primary_key].dataType)
