"""Joins between parent and child tables.

A child table may hold one parent key in a third of its rows. Counts are taken per key before a join,
and where child rows themselves are joined the parent side has one row per key and the join is left
to adaptive execution, which splits a skewed child partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(left: T.DataType, right: T.DataType) -> bool:
    """Keys of different types match only when both are numbers; text never equals a number."""
    return left == right or (isinstance(left, T.NumericType) and isinstance(right, T.NumericType))


def _key_of(df: DataFrame, column: str, other: T.DataType) -> Column:
    own = df.schema[column].dataType
    return F.col(column) if comparable(own, other) else F.lit(None).cast(other)


def child_counts(child: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per non-null key."""
    return child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_child_count(
    parent: DataFrame, key: str, child: DataFrame, child_key: str, column: str
) -> DataFrame:
    """Parent rows with the number of their child rows in ``column`` (replaced when present), 0 without any."""
    matched = child.select(_key_of(child, child_key, parent.schema[key].dataType).alias("_key"))
    counts = child_counts(matched, "_key", "_count")
    joined = parent.join(counts, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_count", F.lit(0)).cast("bigint")).drop("_key", "_count")


def _distinct_keys(parent: DataFrame, primary_key: str, other: T.DataType) -> DataFrame:
    """Keys of a parent table, once each: the exchange of the distinct is the one the join needs anyway, and a
    repeated parent key cannot swell one side of the join."""
    return parent.select(_key_of(parent, primary_key, other).alias("_key")).where("_key is not null").distinct()


def _position(columns: list[str]) -> Column:
    """Comparable position of a row; a single column stays as it is, so its minimum fits a hash aggregate."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def orphan_rows(child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    keys = _distinct_keys(parent, primary_key, child.schema[foreign_key].dataType)
    return child.where(F.col(foreign_key).isNotNull()).join(keys, F.col(foreign_key) == F.col("_key"), "left_anti")


def with_parent(child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str) -> DataFrame:
    """Child rows whose parent exists."""
    keys = _distinct_keys(parent, primary_key, child.schema[foreign_key].dataType)
    return child.join(keys, F.col(foreign_key) == F.col("_key"), "left_semi")


def dependency_filter(
    tables: dict[str, DataFrame], relationships: list[tuple[str, str, str, str]]
) -> dict[str, DataFrame]:
    """Keep only rows whose parents exist, parents first.

    ``relationships`` are ``(from_table, foreign_key, to_table, primary_key)``.
    """
    kept, waiting = dict(tables), set(tables)
    while waiting:
        ready = [t for t in waiting if not any(f == t and p in waiting and p != t for f, _, p, _ in relationships)]
        if not ready:
            raise ValueError(f"relationships form a cycle among {sorted(waiting)}")
        for table in sorted(ready):
            for source, foreign_key, target, primary_key in relationships:
                if source == table and target != table:
                    kept[table] = with_parent(kept[table], foreign_key, kept[target], primary_key)
            waiting.discard(table)
    return kept


def star_join(fact: DataFrame, dimensions: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of a fact table with ``(dimension, fact column, dimension key)`` in turn."""
    joined = fact
    for dimension, column, key in dimensions:
        right = dimension.withColumnRenamed(key, f"_{key}") if key in joined.columns else dimension
        name = f"_{key}" if key in joined.columns else key
        joined = joined.join(right, F.col(column) == F.col(name), "inner")
        if name.startswith("_"):
            joined = joined.drop(name)
    return joined


def reference_counts(child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str) -> DataFrame:
    """One row per key on either side: ``foreign_key``, ``primary_key``, ``n`` child rows.

    Both sides are reduced to one row per key before they meet.
    """
    counts = child_counts(child.select(F.col(foreign_key).alias("fk")), "fk", "n")
    keys = _distinct_keys(parent, primary_key, child.schema[foreign_key].dataType).withColumnRenamed("_key", "pk")
    return counts.join(keys, F.col("fk") == F.col("pk"), "full_outer")


def reference_summary(child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str) -> DataFrame:
    """Totals of a foreign key: references, distinct references, orphans, distinct orphans, parent keys."""
    orphan = F.col("fk").isNotNull() & F.col("pk").isNull()
    return reference_counts(child, foreign_key, parent, primary_key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_foreign_keys"),
        F.count("fk").alias("unique_references"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphaned_count"),
        F.count(F.when(orphan, F.lit(1))).alias("orphaned_values"),
        F.count("pk").alias("total_primary_keys"),
    )


def duplicate_rows(df: DataFrame, key: list[str], count: str = "n") -> DataFrame:
    """All rows of every key that occurs more than once (null keys equal each other), with the count."""
    repeated = df.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.count(F.lit(1)).alias(count))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return df.join(repeated.where(F.col(count) > 1), on, "inner").drop(*[f"_{c}" for c in key])


def repeated_occurrences(df: DataFrame, key: str, position: list[str]) -> DataFrame:
    """Second and later rows of every non-null key in order of ``position``."""
    at = _position(position)
    first = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(at).alias("_first"))
    return df.join(first, F.col(key) == F.col("_key"), "inner").where(at > F.col("_first")).drop("_key", "_first")


def last_declaration(df: DataFrame, key: str, position: list[str]) -> DataFrame:
    """The last row of every non-null key in order of ``position``."""
    row = F.max_by(F.struct(*df.columns), _position(position)).alias("_row")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(row).select("_row.*")


def unseen_parents(
    child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str, position: list[str]
) -> DataFrame:
    """Child rows that arrived before the first row of their parent, or whose parent never arrived."""
    first = (
        parent.where(F.col(primary_key).isNotNull())
        .groupBy(F.col(primary_key).alias("_key"))
        .agg(F.min(_position(position)).alias("_first"))
    )
    joined = child.where(F.col(foreign_key).isNotNull()).join(first, F.col(foreign_key) == F.col("_key"), "left")
    return joined.where(F.col("_first").isNull() | (F.col("_first") > _position(position))).drop("_key", "_first")


def count_since_reset(
    resets: DataFrame, reset_key: str, child: DataFrame, child_key: str, position: list[str], name: str = "since_reset"
) -> DataFrame:
    """Child rows after the last reset row of each key: ``(reset_key, name)``, 0 without any.

    Children meet one row per key, and a hot key's children are split in that join and counted before they move again.
    """
    at = _position(position)
    last = resets.where(F.col(reset_key).isNotNull()).groupBy(F.col(reset_key).alias("_key")).agg(F.max(at).alias("_last"))
    rows = child.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("_child"), at.alias("_pos"))
    after = rows.join(last, F.col("_child") == F.col("_key")).where("_pos > _last").groupBy("_child").agg(F.count(F.lit(1)).alias("_n"))
    counted = last.join(after, F.col("_key") == F.col("_child"), "left")
    return counted.select(F.col("_key").alias(reset_key), F.coalesce("_n", F.lit(0)).alias(name))
