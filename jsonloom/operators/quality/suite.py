"""The whole check suite, its summary and its score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.functions.scores import quality_score, recommendation
from jsonloom.operators.quality.capacity import CapacityRule, EntityLimit, capacity_checks, entity_limit_checks
from jsonloom.operators.quality.consistency import FieldRule, field_rule_checks, table_checks, uniqueness_check
from jsonloom.operators.quality.distribution import distribution_checks
from jsonloom.operators.quality.integrity import Reference, integrity_checks
from jsonloom.operators.quality.rows import INTEGRITY, literal_checks, union_checks

# A user's check: the tables in, check rows out.
Check = Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class Rules:
    """What to check. Everything comes from here; the suite knows no table names."""

    references: list[Reference] = field(default_factory=list)
    primary_keys: dict[str, str | None] = field(default_factory=dict)
    capacities: list[CapacityRule] = field(default_factory=list)
    limits: list[EntityLimit] = field(default_factory=list)
    field_rules: list[FieldRule] = field(default_factory=list)
    extra: list[Check] = field(default_factory=list)


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """All check rows as one lazy DataFrame."""
    parts = integrity_checks(spark, tables, rules.references, rules.primary_keys)
    parts += capacity_checks(spark, tables, rules.capacities)
    for name, df in tables.items():
        key = rules.primary_keys.get(name)
        if key in df.columns:
            parts.append(uniqueness_check(name, df, key))
        parts.append(table_checks(name, df))
        distribution = distribution_checks(name, df)
        if distribution is not None:
            parts.append(distribution)
    parts += entity_limit_checks(tables, rules.limits)
    parts += field_rule_checks(tables, rules.field_rules)
    parts += [check(tables) for check in rules.extra]
    return union_checks(spark, parts)


def load_failure(spark: SparkSession) -> DataFrame:
    """The only check row when a table cannot be read."""
    return literal_checks(spark, [(INTEGRITY, "Table Loading", "Failed to load one or more tables", "ERROR")])


def count_checks(checks: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Counters and score of check rows, optionally per group."""
    counted = checks.groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("passed"), F.lit(1))).alias("passed"),
        F.count(F.when(~F.col("passed"), F.lit(1))).alias("failed"),
        F.count(F.when(F.col("severity") == "ERROR", F.lit(1))).alias("errors"),
        F.count(F.when(F.col("severity") == "WARNING", F.lit(1))).alias("warnings"),
    )
    return counted.withColumn("score", quality_score(F.col("total"), F.col("errors"), F.col("warnings")))


def summarize(checks: DataFrame, tables: int, records: int, references: int) -> DataFrame:
    """One summary row: counters, score, status and recommendation."""
    score = F.col("score")
    return count_checks(checks).select(
        F.col("total").alias("total_checks"), F.col("passed").alias("passed_checks"),
        F.col("failed").alias("failed_checks"), "warnings", "errors",
        F.when(F.col("errors") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("overall_status"),
        F.lit(tables).cast("bigint").alias("tables_validated"),
        F.lit(records).cast("bigint").alias("total_records"),
        score.alias("quality_score"),
        F.col("errors").alias("critical_issues"),
        F.lit(references).cast("bigint").alias("relationships_validated"),
        recommendation(score).alias("recommendation"),
    )


def gate(summary: DataFrame) -> int:
    """Exit status: 0 without errors, else 1."""
    return 0 if summary.select("errors").first().errors == 0 else 1
