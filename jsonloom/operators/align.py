"""Column alignment and unions of batches whose columns differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the missing columns of ``schema`` as nulls and bring the others to its types.

    Columns outside the schema pass through behind it. A value that does not fit becomes null and its
    column is named in ``lost_fields`` when there are casts at all.
    """
    columns, lost = [], []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        own, value = df.schema[field.name].dataType, F.col(field.name)
        if same_type(own, field.dataType):
            columns.append(value)
            continue
        cast = _fit(value, own, field.dataType)
        columns.append(cast.alias(field.name))
        lost.append(F.when(value.isNotNull() & cast.isNull(), F.lit(field.name)))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if lost:
        columns.append(F.array_compact(F.array(*lost)).alias("lost_fields"))
    return df.select(*columns, *extra)


def same_type(left: T.DataType, right: T.DataType) -> bool:
    """Equal up to nullability, which files do not keep."""
    return left.simpleString() == right.simpleString()


def _fit(value, own: T.DataType, wanted: T.DataType):
    nested = (T.ArrayType, T.StructType, T.MapType)
    if isinstance(wanted, T.StringType):
        return F.to_json(value) if isinstance(own, nested) else value.cast("string")
    if isinstance(own, nested) or isinstance(wanted, nested):
        return F.from_json(value, wanted) if isinstance(own, T.StringType) else F.lit(None).cast(wanted)
    if isinstance(own, T.FractionalType) and isinstance(wanted, T.IntegralType):
        return F.when(value == F.floor(value), value.try_cast(wanted))
    return value.try_cast(wanted)


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns in first-seen order; equal types stay, whole and fractional numbers meet in double, others in text."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            seen = types.get(field.name)
            if seen is None or isinstance(seen, T.NullType):
                types[field.name] = field.dataType
            elif isinstance(field.dataType, T.NullType) or same_type(seen, field.dataType):
                continue
            elif isinstance(seen, T.IntegralType) and isinstance(field.dataType, T.IntegralType):
                types[field.name] = T.LongType()
            elif isinstance(seen, T.NumericType) and isinstance(field.dataType, T.NumericType):
                types[field.name] = T.DoubleType()
            else:
                types[field.name] = T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def union_batches(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by name after every batch has been brought to one schema.

    The common schema holds every value; with a given ``schema`` the column ``lost_fields`` names those it cannot.
    """
    wanted = schema or common_schema([f.schema for f in frames])
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [align_columns(f, wanted) for f in frames])
    return union.drop("lost_fields") if schema is None else union
