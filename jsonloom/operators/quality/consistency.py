"""Key uniqueness, nulls in key columns, empty tables and cross-field rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonloom.functions.names import key_columns
from jsonloom.operators.quality.rows import (
    BUSINESS, CHECK_SCHEMA, CONSISTENCY, DISTRIBUTION, NO_RECORDS, as_check, details, name, sample_list, text,
)

# Null shares (percent) in key columns: reported above the first, an error from the second on.
NULL_WARNING, NULL_ERROR = 5, 20


@dataclass(frozen=True)
class FieldRule:
    """Rows for which ``violation`` (a SQL condition over ``columns``) holds are inconsistent."""

    table: str
    columns: tuple[str, ...]
    violation: str
    check_name: str = "Age-Grade Consistency"
    noun: str = "students with inconsistent age/grade"
    passed_message: str = "Student ages are consistent with grade levels"


def _null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``total`` and the nulls of column i in ``n<i>``."""
    nulls = [F.expr(f"count_if({name(c)} is null) as n{i}") for i, c in enumerate(columns)]
    return df.agg(F.expr("count(1) as total"), *nulls)


def null_rates(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``(table_name, field, total_records, null_count, null_percentage)``, all columns from one aggregate."""
    fields = ", ".join(f"struct({text(c)} as field, n{i} as nulls)" for i, c in enumerate(columns))
    return _null_counts(df, columns).selectExpr("total", f"explode(array({fields})) as f").selectExpr(
        f"{text(table)} as table_name", "f.field", "total as total_records", "f.nulls as null_count",
        "if(total > 0, 100D * f.nulls / total, 0D) as null_percentage",
    )


def table_checks(table: str, df: DataFrame) -> DataFrame:
    """Empty-table check and null checks of all key columns from one aggregate over the table."""
    columns = key_columns(df)
    return table_rows(_null_counts(df, columns), table, columns)


def table_rows(counts: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """The check rows of a table from its rows, ``total``, and the nulls of column i in ``n<i>``."""

    def check(failed: str, values: list[str]) -> str:
        cells = ", ".join(f"{v} as {f.name}" for f, v in zip(CHECK_SCHEMA.fields, values))
        return f"if({failed}, struct({cells}), null)"

    checks = [
        check(
            "total = 0",
            [
                str(DISTRIBUTION), text(f"Table Population: {table}"), "false", text(f"Table {table} is empty"),
                "'WARNING'", "0L", NO_RECORDS, details(),
            ],
        )
    ]
    for i, column in enumerate(columns):
        percent = f"(100D * n{i} / greatest(total, 1))"
        checks.append(
            check(
                f"{percent} > {NULL_WARNING}",
                [
                    str(CONSISTENCY), text(f"Null Values in Critical Field: {table}.{column}"), "false",
                    f"format_string('%.2f%% null values in critical field', {percent})",
                    f"if({percent} < {NULL_ERROR}, 'WARNING', 'ERROR')", f"n{i}", NO_RECORDS,
                    details(null_count=f"n{i}", total_records="total", null_percentage=percent),
                ],
            )
        )
    return counts.selectExpr(f"inline(array_compact(array({', '.join(checks)})))")


def duplicate_key_counts(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, nulls being equal: ``(key, n)``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def uniqueness_check(table: str, df: DataFrame, key: str) -> DataFrame:
    repeated = duplicate_key_counts(df, key)
    summary = repeated.agg(F.expr("coalesce(sum(n), 0) as rows"), F.expr("count(1) as values"))
    return uniqueness_row(summary, table, key, sample_list(repeated, key))


def uniqueness_row(summary: DataFrame, table: str, key: str, affected: Column | None = None) -> DataFrame:
    """The check row of a key from its totals: ``rows`` of repeated ``values``."""
    return as_check(
        summary, CONSISTENCY, text(f"Primary Key Uniqueness: {table}.{key}"), "`values` = 0",
        "'All primary key values are unique'", "format_string('Found %d duplicate primary key values', `rows`)", "ERROR",
        "`rows`", bad_details=details(duplicate_count="`rows`", unique_duplicates="`values`"),
        affected=affected,
    )


def field_rule_row(summary: DataFrame, rule: FieldRule) -> DataFrame:
    """The check row of a rule from its totals: ``bad`` of ``total`` rows."""
    return as_check(
        summary, BUSINESS, text(rule.check_name), "bad = 0", text(rule.passed_message),
        f"format_string({text(f'Found %d {rule.noun}')}, bad)", "WARNING", "bad",
        bad_details=details(inconsistent_count="bad", total_students="total"),
    )


def field_rule_checks(tables: dict[str, DataFrame], rules: list[FieldRule]) -> list[DataFrame]:
    parts = []
    for rule in rules:
        if rule.table not in tables or not set(rule.columns) <= set(tables[rule.table].columns):
            continue
        summary = tables[rule.table].agg(F.expr(f"count_if({rule.violation}) as bad"), F.expr("count(1) as total"))
        parts.append(field_rule_row(summary, rule))
    return parts
