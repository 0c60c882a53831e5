"""Capacity and per-entity limit checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.operators.quality.rows import BUSINESS, CAPACITY, as_check, details, literal_checks, name, sample_list, text
from jsonloom.operators.relate import child_counts, with_child_count


@dataclass(frozen=True)
class CapacityRule:
    """A parent row holds at most ``limit`` (a column) child rows."""

    parent: str
    key: str
    limit: str
    child: str
    child_key: str
    check_name: str = "Class Capacity Constraints"
    noun: str = "classes"


@dataclass(frozen=True)
class EntityLimit:
    """A key occurs at most ``limit`` times."""

    table: str
    key: str
    limit: int
    check_name: str = "Student Enrollment Limits"
    noun: str = "students"


def capacity_violations(
    parent: DataFrame, key: str, limit: str, child: DataFrame, child_key: str
) -> DataFrame:
    """Parents with more children than their limit: ``(key, current, capacity, excess)``."""
    counted = with_child_count(parent.select(key, limit), key, child, child_key, "current")
    capacity = F.coalesce(F.col(limit), F.lit(0))
    return counted.where(F.col("current") > capacity).select(
        key, "current", capacity.alias("capacity"), (F.col("current") - capacity).alias("excess")
    )


def capacity_precondition(rule: CapacityRule, tables: dict[str, DataFrame]) -> tuple[int, str, str, str] | None:
    """The failed precondition of a rule, decided from the schemas alone."""
    if rule.parent not in tables or rule.child not in tables:
        message = f"Missing {rule.parent} or {rule.child} tables for capacity validation"
        return CAPACITY, "Capacity Validation Setup", message, "WARNING"
    parent, child = tables[rule.parent], tables[rule.child]
    if rule.child_key not in child.columns or rule.limit not in parent.columns or rule.key not in parent.columns:
        return CAPACITY, "Capacity Validation Columns", "Missing required columns for capacity validation", "WARNING"
    return None


def capacity_row(summary: DataFrame, rule: CapacityRule, affected: Column | None = None) -> DataFrame:
    """The check row of a rule from its totals: ``parents, over, max_excess, children`` and ``worst``, some rows over."""
    return as_check(
        summary, CAPACITY, text(rule.check_name), "over = 0", text(f"All {rule.noun} are within capacity limits"),
        f"format_string({text(f'Found %d {rule.noun} over capacity')}, over)", "ERROR", "over",
        details(total_classes_checked="parents", total_enrollments="children"),
        details(
            over_capacity_classes="concat('[', array_join(worst, ','), ']')", total_classes="parents",
            max_excess="max_excess",
        ),
        affected,
    )


def capacity_checks(spark: SparkSession, tables: dict[str, DataFrame], rules: list[CapacityRule]) -> list[DataFrame]:
    parts = []
    for rule in rules:
        failed = capacity_precondition(rule, tables)
        if failed:
            parts.append(literal_checks(spark, [failed]))
            continue
        parent, child = tables[rule.parent], tables[rule.child]
        counted = with_child_count(parent.select(rule.key, rule.limit), rule.key, child, rule.child_key, "current")
        key, limit = name(rule.key), name(rule.limit)
        counted = counted.selectExpr(key, "current", limit, f"current - coalesce({limit}, 0) as excess")
        over = counted.where("excess > 0")
        summary = counted.agg(
            F.expr("count(1) as parents"), F.expr("count_if(excess > 0) as over"),
            F.expr("max(excess) as max_excess"), F.expr("coalesce(sum(current), 0) as children"),
        )
        worst = over.selectExpr(key, f"to_json(struct({key}, current, {limit} as max, excess)) as worst_row")
        summary = summary.withColumn("worst", sample_list(worst, "worst_row", [key]))
        parts.append(capacity_row(summary, rule, sample_list(over, rule.key)))
    return parts


def entity_limit_row(summary: DataFrame, rule: EntityLimit, affected: Column | None = None) -> DataFrame:
    """The check row of a limit from its totals: ``over, most, mean``."""
    return as_check(
        summary, BUSINESS, text(rule.check_name), "over = 0",
        text(f"All {rule.noun} have reasonable enrollment counts"),
        f"format_string({text(f'Found %d {rule.noun} with excessive enrollments')}, over)", "WARNING", "over",
        bad_details=details(max_enrollments="most", avg_enrollments="mean", students_over_limit="over"),
        affected=affected,
    )


def entity_limit_checks(tables: dict[str, DataFrame], rules: list[EntityLimit]) -> list[DataFrame]:
    parts = []
    for rule in rules:
        if rule.table not in tables or rule.key not in tables[rule.table].columns:
            continue
        counts = child_counts(tables[rule.table], rule.key)
        over = counts.where(f"n > {rule.limit}")
        summary = counts.agg(
            F.expr(f"count_if(n > {rule.limit}) as over"), F.expr("max(n) as most"), F.expr("avg(n) as mean")
        )
        parts.append(entity_limit_row(summary, rule, sample_list(over, rule.key, ["n desc", name(rule.key)])))
    return parts
