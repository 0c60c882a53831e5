"""Order-dependent operators that stay parallel.

A window without a partition key, or with a key that owns a third of the rows, puts all of them in one task. Here the
rows are dealt by ranges of their order, sorted and numbered where they lie, and cut into segments of so many numbers.
A segment is a window of its own; what goes over from one segment to the next is added up along a tree: segments of a
range, then ranges. Segments keep their size whatever the number of rows, and no plan grows with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jsonloom.session import cut_lineage

# A segment has up to 2 ** SEGMENT_BITS rows.
SEGMENT_BITS = 17
# Numbers of a range's rows: a range's own number is above these bits (as Spark numbers rows).
RANGE_BITS = 33


def keep_last(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Last row per key. Ranks are limited before the shuffle, so a hot key sends one row per task."""
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() if isinstance(c, str) else c for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per group, limited before the shuffle in the same way."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def in_segments(df: DataFrame, order: list[str], bits: int | None = None) -> DataFrame:
    """The rows with ``_at``, a number that rises with ``order`` (nulls first), and ``_segment``, its higher bits.

    Rows are dealt by ranges once and go to the shared folder with their numbers, so every later reader sees the same.
    """
    bits = SEGMENT_BITS if bits is None else bits
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return cut_lineage(placed.withColumn("_segment", F.shiftright("_at", bits)))


def carried_over(
    cut: DataFrame, key: list[str], values: dict[str, Column], combine: Callable[[str | Column], Column], bits: int | None = None
) -> DataFrame:
    """What segments get from earlier ones of the same key: ``_from`` (the segment), the key as ``_of_<key>``, and the
    combined ``values``. Only segments that get something have a row: one at most, if rows are ordered by key.

    A window here holds the segments of a range, or the ranges: it grows with neither the rows of a range nor a key's rows.
    """
    up = RANGE_BITS - (SEGMENT_BITS if bits is None else bits)
    sums = cut.groupBy("_segment", *key).agg(*[combine(v).alias(n) for n, v in values.items()])
    sums = sums.withColumn("_range", F.shiftright("_segment", up))
    earlier = Window.partitionBy("_range", *key).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    near = sums.select(
        "_segment", "_range", *key, F.count(F.lit(1)).over(earlier).alias("_n"), *[combine(n).over(earlier).alias(n) for n in values]
    )
    ranges = sums.groupBy("_range", *key).agg(*[combine(n).alias(n) for n in values])
    before = Window.partitionBy(*(key or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    far = ranges.select(
        F.col("_range").alias("_r"), *[F.col(c).alias(f"_of_{c}") for c in key], F.count(F.lit(1)).over(before).alias("_m"),
        *[combine(n).over(before).alias(f"_far_{n}") for n in values],
    ).where("_m > 0")
    on = [F.col("_range") == F.col("_r")] + [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    met = near.join(far, on, "left").where("_n > 0 or _m > 0")
    both = {n: combine_two(combine, F.col(n), F.col(f"_far_{n}")) for n in values}
    return met.select(F.col("_segment").alias("_from"), *[near[c].alias(f"_of_{c}") for c in key], *[v.alias(n) for n, v in both.items()])


def combine_two(combine: Callable, left: Column, right: Column) -> Column:
    """Two partial results in one; null counts as none."""
    if combine is F.max:
        return F.greatest(left, right)
    return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))


def running_totals(
    df: DataFrame, key: list[str], order: list[str], totals: dict[str, Column], bits: int | None = None
) -> DataFrame:
    """Add, per row, the sums of ``totals`` over the earlier rows of the same key (zero for the first).

    ``order`` must be unique within a key. Works for a key that owns most of the rows and for no key at all.
    """
    inputs = {f"_in_{name}": value for name, value in totals.items()}
    cut = in_segments(df.withColumns(inputs), key + order, bits)
    carried = carried_over(cut, key, {f"_carry_{n}": F.col(f"_in_{n}") for n in totals}, F.sum, bits)
    before = Window.partitionBy("_segment", *key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # dealt by segment, the rows serve the window and the join
    local = cut.repartition("_segment").withColumns({n: F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)) for n in totals})
    on = [F.col("_segment") == F.col("_from")] + [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key]
    out = local.join(carried, on, "left")
    return out.select(*df.columns, *[(F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n) for n in totals])


def sequential_ids(
    df: DataFrame, order: list[str], column: str, prefix: str, start: int, bits: int | None = None
) -> DataFrame:
    """Prefixed ids without gaps, in ``order``, from ``start`` on."""
    counted = running_totals(df, [], order, {"_earlier": F.lit(1)}, bits)
    number = (F.col("_earlier") + F.lit(start)).cast("string")
    return counted.withColumn(column, F.concat(F.lit(prefix), number)).drop("_earlier")


def with_previous(df: DataFrame, value: str, column: str = "previous", bits: int | None = None) -> DataFrame:
    """Add the previous value of ``value`` in its own order over all rows (null for the first)."""
    cut = in_segments(df, [value], bits)
    inside = cut.repartition("_segment").withColumn("_near", F.lag(value).over(Window.partitionBy("_segment").orderBy("_at")))
    carried = carried_over(cut, [], {"_far": F.col(value)}, F.max, bits)
    joined = inside.join(carried, F.col("_segment") == F.col("_from"), "left")
    return joined.select(*df.columns, F.coalesce("_near", "_far").alias(column))


def gap_statistics(df: DataFrame, ts: str, bits: int | None = None) -> DataFrame:
    """Average, minimum and maximum seconds between consecutive timestamps.

    Equal timestamps are merged first (their gaps are zero), so a burst at one instant cannot
    fill a segment.
    """
    times = df.where(F.col(ts).isNotNull()).select(F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    instants = times.groupBy("us").agg(F.count(F.lit(1)).alias("n"))
    gaps = with_previous(instants, "us", "previous", bits)
    gap = (F.col("us") - F.col("previous")) / 1e6
    smallest = F.min(F.when(F.col("n") > 1, F.lit(0.0)).otherwise(gap))
    return gaps.agg(
        ((F.max("us") - F.min("us")) / 1e6 / (F.sum("n") - 1)).alias("avg_s"),
        smallest.alias("min_s"),
        F.greatest(F.max(gap), F.min(F.when(F.col("n") > 1, F.lit(0.0)))).alias("max_s"),
    )
