"""The check row and the pieces checks are made of.

Checks are written as SQL expressions: one string per column instead of a tree of Column objects, which
keeps building a suite of dozens of checks cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = T.StructType(
    [
        T.StructField("check_group", T.IntegerType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("message", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("affected_count", T.LongType()),
        T.StructField("affected_records", T.ArrayType(T.StringType())),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Report order of the check groups.
INTEGRITY, CAPACITY, CONSISTENCY, BUSINESS, DISTRIBUTION = range(1, 6)

# A check row names this many affected records; the operators return all of them.
SAMPLE = 10

NO_RECORDS = "cast(array() as array<string>)"


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """SQL column name."""
    return "`" + column.replace("`", "``") + "`"


def literal_checks(spark: SparkSession, rows: list[tuple[int, str, str, str]]) -> DataFrame:
    """Failed checks known from the schema alone: ``(group, name, message, severity)``."""
    data = [(g, n, False, m, s, 0, [], {}) for g, n, m, s in rows]
    return spark.createDataFrame(data, CHECK_SCHEMA)


def details(**values: str) -> str:
    """SQL map of details, one expression per key."""
    pairs = ", ".join(f"{text(k)}, cast({v} as string)" for k, v in values.items())
    return f"map({pairs})" if values else "cast(map() as map<string,string>)"


def sample_list(rows: DataFrame, value: str, order: list[str] | None = None) -> Column:
    """The first few values as an array of text, as a scalar subquery over ``rows``; ``order`` are SQL sort terms."""
    terms = [F.expr(o.removesuffix(" desc")).desc() if o.endswith(" desc") else F.expr(o) for o in order or [name(value)]]
    picked = rows.orderBy(*terms)
    numbered = picked.limit(SAMPLE).selectExpr("monotonically_increasing_id() as p", f"cast({name(value)} as string) as v")
    return numbered.selectExpr("array_sort(collect_list(struct(p, v))).v as s").scalar()


def as_check(
    summary: DataFrame, group: int, check_name: str, passed: str, good: str, bad: str, severity: str,
    affected_count: str = "0", good_details: str = details(), bad_details: str = details(),
    affected: Column | None = None,
) -> DataFrame:
    """Project a summary row to a check row; all texts but ``severity`` are SQL expressions."""
    row = summary if affected is None else summary.withColumn("affected_", affected)
    return row.selectExpr(
        f"{group} as check_group", f"{check_name} as check_name", f"{passed} as passed",
        f"if({passed}, {good}, {bad}) as message", f"if({passed}, 'INFO', '{severity}') as severity",
        f"cast({affected_count} as bigint) as affected_count",
        f"{NO_RECORDS if affected is None else f'coalesce(affected_, {NO_RECORDS})'} as affected_records",
        f"if({passed}, {good_details}, {bad_details}) as details",
    )


def union_checks(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], CHECK_SCHEMA)
