"""All records that failed checks name, as a table beside the check rows.

A check row shows a few of them; here none is left out. The rows stay distributed: write them where they are needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.operators.quality.capacity import capacity_violations
from jsonloom.operators.quality.consistency import duplicate_key_counts
from jsonloom.operators.quality.integrity import target_key, precondition
from jsonloom.operators.quality.suite import Rules
from jsonloom.operators.relate import child_counts

SCHEMA = "check_name string, table_name string, key string, record string"


def affected_rows(spark: SparkSession, tables: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """One row per affected record and check: ``check_name, table_name, key, record`` (the record as JSON).

    References: child rows without a parent. Primary keys: all rows of a repeated key. Capacities and limits: the keys
    over them, with their counts. Field rules: the rows that break them.
    """
    parts = []

    def add(check_name: str, table: str, rows: DataFrame, key: str) -> None:
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
        parts.append(
            rows.select(F.lit(check_name).alias("check_name"), F.lit(table).alias("table_name"), F.col(f"`{key}`").cast("string").alias("key"), record.alias("record"))
        )

    for r in rules.references:
        if precondition(r, tables, rules.primary_keys) is None:
            primary = target_key(r, tables, rules.primary_keys)
            child, parents = tables[r.from_table], tables[r.to_table].select(F.col(primary).alias("_parent")).distinct()
            orphans = child.where(F.col(f"`{r.foreign_key}`").isNotNull()).join(parents, F.col(f"`{r.foreign_key}`") == F.col("_parent"), "left_anti")
            add(f"Referential Integrity: {r.from_table}.{r.foreign_key} → {r.to_table}.{primary}", r.from_table, orphans, r.foreign_key)
    for table, key in rules.primary_keys.items():
        if table in tables and key in tables[table].columns:
            repeated = duplicate_key_counts(tables[table], key).select(F.col(key).alias("_key"))
            rows = tables[table].join(repeated, F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left_semi")
            add(f"Primary Key Uniqueness: {table}.{key}", table, rows, key)
    for c in rules.capacities:
        if c.parent in tables and c.child in tables and {c.key, c.limit} <= set(tables[c.parent].columns) and c.child_key in tables[c.child].columns:
            add(c.check_name, c.parent, capacity_violations(tables[c.parent], c.key, c.limit, tables[c.child], c.child_key), c.key)
    for limit in rules.limits:
        if limit.table in tables and limit.key in tables[limit.table].columns:
            add(limit.check_name, limit.table, child_counts(tables[limit.table], limit.key).where(F.col("n") > limit.limit), limit.key)
    for rule in rules.field_rules:
        if rule.table in tables and set(rule.columns) <= set(tables[rule.table].columns):
            key = rules.primary_keys.get(rule.table) or rule.columns[0]
            add(rule.check_name, rule.table, tables[rule.table].where(rule.violation), key)
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], SCHEMA)
