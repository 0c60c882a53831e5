"""Approximate distinct counts that merge: one sketch per column and batch of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.quality.rows import name, text

#: 2 ** LOG_K registers; a standard error of 0.8 %
LOG_K = 14
SKETCHES = T.StructType(
    [
        T.StructField("table_name", T.StringType()), T.StructField("field", T.StringType()),
        T.StructField("record_count", T.LongType()), T.StructField("null_count", T.LongType()),
        T.StructField("max_length", T.LongType()), T.StructField("least", T.StringType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def _shown(df: DataFrame, column: str) -> str:
    """SQL of a value as text: equal values, and only these, have equal texts."""
    kind, value = df.schema[column].dataType, name(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"cast({value} + 0D as string)"  # turns -0.0 into 0.0
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({value})"
    return f"cast({value} as string)"


def column_sketches(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """One row per column (SKETCHES) from one aggregate; no value is shuffled."""
    columns = df.columns if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], SKETCHES)
    parts, cells = ["count(1) as total"], []
    for i, column in enumerate(columns):
        shown = _shown(df, column)
        length = f"max(length({shown}))" if isinstance(df.schema[column].dataType, (T.StringType, T.ArrayType, T.MapType, T.StructType)) else "null"
        parts.append(
            f"named_struct('nulls', count_if({name(column)} is null), 'longest', cast({length} as bigint), 'least', min({shown}),"
            f" 'sketch', hll_sketch_agg({shown}, {LOG_K})) as c{i}"
        )
        cells.append(
            f"struct({text(column)} as field, total as record_count, c{i}.nulls as null_count, c{i}.longest as max_length, c{i}.least as least,"
            f" c{i}.sketch as sketch)"
        )
    facts = df.agg(*[F.expr(p) for p in parts])
    return facts.selectExpr(f"inline(array({', '.join(cells)}))").selectExpr(f"{text(table)} as table_name", "*")


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches of several batches or runs as one per column."""
    return sketches.groupBy("table_name", "field").agg(
        F.sum("record_count").alias("record_count"), F.sum("null_count").alias("null_count"), F.max("max_length").alias("max_length"),
        F.min("least").alias("least"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
    )


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """:func:`~jsonloom.operators.profile.column_profile` with estimated distinct counts."""
    return sketches.select(
        "field", "record_count", "null_count", "max_length", F.hll_sketch_estimate("sketch").alias("unique_values"), F.col("table_name").alias("table")
    )


def sketched_variation(sketches: DataFrame) -> DataFrame:
    """:func:`~jsonloom.operators.quality.distribution.variation` with estimated distinct counts. Up to some thousands they are exact."""
    total = F.col("record_count") - F.col("null_count")
    unique = F.hll_sketch_estimate("sketch")
    return sketches.where(total > 0).select(
        "table_name", "field", unique.alias("unique_values"), total.alias("total_values"), (unique / total).alias("unique_ratio"),
        F.col("least").alias("a_value"),
    )
