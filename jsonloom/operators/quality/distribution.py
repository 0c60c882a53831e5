"""Value distributions of columns, exact, from one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.names import KEY_SUFFIX
from jsonloom.operators.ordering import top_per_group
from jsonloom.operators.quality.rows import DISTRIBUTION, as_check, details, name, text
from jsonloom.operators.sketches import column_sketches, sketched_variation

# A column varies little when distinct / total is below the first and there are more rows than the second.
LOW_RATIO, LOW_ROWS = 0.1, 20
TOP_VALUES = 3
_LOW = f"unique_ratio < {LOW_RATIO} and total_values > {LOW_ROWS}"
VARIES_LITTLE = f"unique_values = 1 or ({_LOW})"


def numeric_columns(df: DataFrame) -> list[str]:
    """Whole and floating point columns that are not keys."""
    kinds = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and not f.name.endswith(KEY_SUFFIX)]


def _cell(df: DataFrame, column: str, i: int, value: str, is_item: bool = False) -> str:
    """SQL of a value of column ``i`` as a struct with a field per kind of value; ``is_item``: nested values are text already."""
    kind, whole, real, shown = df.schema[column].dataType, "null", "null", "null"
    if isinstance(kind, T.IntegralType):
        whole = value
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        real = f"{value} + 0D"  # turns -0.0 into 0.0
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) and not is_item:
        shown = f"to_json({value})"
    else:
        shown = value
    return (
        f"struct({i} as f, cast({whole} as bigint) as long_value, cast({real} as double) as double_value,"
        f" cast({shown} as string) as text_value, {value} is null as is_null)"
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of every value of every column: ``(field, long_value, double_value, text_value, is_null, n)``.

    All columns share one scan and one shuffle. Values are counted before the shuffle, so a value
    held by most rows travels once per task. Whole numbers stay whole numbers: no value is rounded
    into another.
    """
    cells = [_cell(df, column, i, name(column)) for i, column in enumerate(columns)]
    every = df.selectExpr(f"inline(array({', '.join(cells)}))")
    counted = every.groupBy("f", "long_value", "double_value", "text_value", "is_null").agg(F.expr("count(1) as n"))
    names = ", ".join(text(c) for c in columns)
    return counted.selectExpr(
        f"get(array({names}), f) as field", "long_value", "double_value", "text_value", "is_null", "n"
    )


_SHOWN = "coalesce(cast(long_value as string), cast(double_value as string), text_value)"


def top_values(df: DataFrame, columns: list[str], k: int = TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent non-null values per column, ties by value."""
    counts = value_counts(df, columns).where("not is_null")
    order = [F.col("n").desc(), F.col("long_value"), F.col("double_value"), F.col("text_value")]
    return top_per_group(counts, ["field"], order, k).drop("is_null")


# Values that a sketch names as perhaps frequent, items it keeps track of, and classes that all values are counted in.
CANDIDATES, TRACKED, CLASSES = 64, 4096, 1024


def frequent_values(df: DataFrame, columns: list[str], k: int = TOP_VALUES) -> DataFrame:
    """:func:`top_values` in passes that shuffle no more values than the answer needs.

    A sketch of each column names candidates. One pass counts these exactly and all other values in CLASSES classes by hash: no other
    value occurs more often than its class. Where every class stays below the k-th candidate, none was missed; values
    of the other classes are counted one by one, which for a column without frequent values are all. The candidates and
    classes, bounded by the columns, pass through the driver.
    """
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], "field string, long_value bigint, double_value double, text_value string, n bigint")
    cells = melted(df, columns)
    named = df.agg(*[F.expr(f"approx_top_k({_item(df, c)}, {CANDIDATES}, {TRACKED}).item as c{i}") for i, c in enumerate(columns)])
    listed = melted_items(named, df, columns).distinct()  # a sketch tells 0.0 and -0.0 apart
    candidates = spark.createDataFrame(listed.toArrow()).withColumn("is_candidate", F.lit(True))  # columns * CANDIDATES at most
    value = ["f", "long_value", "double_value", "text_value"]
    same = [cells[c].eqNullSafe(candidates[c]) for c in value]
    marked = cells.join(F.broadcast(candidates), same, "left").select(*[cells[c] for c in value], "is_candidate")
    kind = F.pmod(F.xxhash64(*value[1:]), F.lit(CLASSES))
    only = [F.when(F.col("is_candidate"), F.col(c)).alias(c) for c in value[1:]]
    counted = marked.groupBy("f", F.coalesce("is_candidate", F.lit(False)).alias("is_candidate"), F.when(F.col("is_candidate").isNull(), kind).alias("class"), *only).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = spark.createDataFrame(counted.toArrow(), counted.schema)  # columns * (CANDIDATES + CLASSES) at most
    sure = counted.where("is_candidate").select(*value, "n")
    last = top_per_group(sure, ["f"], [F.col("n").desc()], k).groupBy("f").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("have"))
    open_classes = counted.where("not is_candidate").join(last.withColumnRenamed("f", "g"), F.col("f") == F.col("g"), "left").where(
        F.col("have").isNull() | (F.col("have") < k) | (F.col("n") >= F.col("least"))
    )
    opened = [(r.f, r["class"]) for r in open_classes.select("f", "class").collect()]
    every = sure
    if opened:
        asked = spark.createDataFrame(opened, "g int, class bigint")
        rest = marked.where("is_candidate is null").join(F.broadcast(asked), (F.col("f") == F.col("g")) & (kind == F.col("class")), "left_semi")
        every = sure.unionByName(rest.groupBy(*value).agg(F.count(F.lit(1)).alias("n")))
    order = [F.col("n").desc(), F.col("long_value"), F.col("double_value"), F.col("text_value")]
    names = ", ".join(text(c) for c in columns)
    return top_per_group(every, ["f"], order, k).selectExpr(f"get(array({names}), f) as field", "long_value", "double_value", "text_value", "n")


def _item(df: DataFrame, column: str) -> str:
    """SQL of a value as a sketch takes it: numbers as they are, other values as text."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({name(column)})"
    return name(column) if isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType)) else f"cast({name(column)} as string)"


def melted(df: DataFrame, columns: list[str]) -> DataFrame:
    """All values that are not null, one row each: ``f`` (the column's number) and the value by its kind."""
    return df.selectExpr(f"inline(array({', '.join(_cell(df, c, i, name(c)) for i, c in enumerate(columns))}))").where("not is_null").drop("is_null")


def melted_items(named: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Arrays of items in columns c0, c1, ... in the form of :func:`melted`."""
    out = None
    for i, column in enumerate(columns):
        some = named.selectExpr(f"explode(c{i}) as item").selectExpr(f"inline(array({_cell(df, column, i, 'item', True)}))").where("not is_null").drop("is_null")
        out = some if out is None else out.unionByName(some)
    return out


def variation(df: DataFrame, columns: list[str], table: str, approximate: bool = False) -> DataFrame:
    """Distinct and total non-null values per column: ``(table_name, field, unique_values, total_values, unique_ratio, a_value)``.

    ``approximate`` estimates the distinct values from sketches; no value is shuffled then.
    """
    if approximate:
        return sketched_variation(column_sketches(df, table, columns))
    counts = value_counts(df, columns).where("not is_null").groupBy("field").agg(
        F.expr("count(1) as unique_values"), F.expr("sum(n) as total_values"), F.expr(f"min({_SHOWN}) as a_value")
    )
    return counts.selectExpr(
        f"{text(table)} as table_name", "field", "unique_values", "total_values",
        "unique_values / total_values as unique_ratio", "a_value",
    )


def constant_columns(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    return variation(df, columns, table).where("unique_values = 1").selectExpr(
        "table_name", "field", "a_value as constant_value", "total_values"
    )


def low_variation(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    return variation(df, columns, table).where(f"unique_values > 1 and {_LOW}").drop("a_value")


def distribution_checks(table: str, df: DataFrame) -> DataFrame | None:
    """Constant and low-variation columns of one table; no rows for columns that vary enough."""
    columns = numeric_columns(df)
    if not columns:
        return None
    facts = variation(df, columns, table).where(VARIES_LITTLE)
    ranked = top_values(df, columns).selectExpr(
        "field", f"struct(-n as rank, long_value, double_value, {_SHOWN} as v, n) as e"
    )
    common = ranked.groupBy("field").agg(
        F.expr("to_json(map_from_entries(transform(array_sort(collect_list(e)), e -> struct(e.v, e.n)))) as common")
    )
    return variation_rows(facts.join(common, "field", "left"), table)


def variation_rows(found: DataFrame, table: str) -> DataFrame:
    """Check rows of columns that vary too little, from ``field, unique_values, total_values, unique_ratio, a_value, common``."""
    constant = "unique_values = 1"
    return as_check(
        found, DISTRIBUTION,
        f"concat({text(f'Data Variation: {table}.')}, field, if({constant}, '', ' (low variation)'))", "false", "''",
        f"if({constant}, 'Column has no variation (all values identical)',"
        " format_string('Column has very low variation (%d/%d unique)', unique_values, total_values))",
        "WARNING",
        bad_details=f"if({constant}, {details(constant_value='a_value')},"
        f" {details(unique_ratio='unique_ratio', most_common_values='common')})",
    )
