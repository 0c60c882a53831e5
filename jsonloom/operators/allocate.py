"""Admission of requests under capacity limits, first come first served."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonloom.functions.scores import share
from jsonloom.operators.graph import groups
from jsonloom.operators.ordering import running_totals, top_per_group
from jsonloom.operators.relate import with_child_count, with_parent
from jsonloom.session import cut_lineage

# Undecided requests that one task settles in sequence.
IN_SEQUENCE = 200_000
# Rounds of the parallel rule before what is still open is taken apart into independent groups.
PARALLEL_ROUNDS = 2

_STATE = "seq bigint, s string, c string, _room double, c_used bigint, s_used bigint, new boolean"


def admit_single_limit(
    requests: DataFrame, key: str, limit: Column, order: list[str], bits: int | None = None
) -> DataFrame:
    """Requests admitted while the count of their key is below ``limit``."""
    counted = running_totals(requests, [key], order, {"_earlier": F.lit(1)}, bits)
    return counted.where(F.col("_earlier") < limit).drop("_earlier")


def _in_turn(max_per_student: int) -> Callable[[pa.Table], pa.Table]:
    """Settle the open requests of a table one after the other; admitted ones come back with ``new`` set."""

    def settle(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("seq")
        columns = [rows.column(n).to_pylist() for n in ("s", "c", "_room", "c_used", "s_used")]
        students, classes, admitted = Counter(), Counter(), []
        for s, c, room, c_used, s_used in zip(*columns):
            fits = c_used + classes[c] < room and s_used + students[s] < max_per_student
            if fits:
                classes[c] += 1
                students[s] += 1
            admitted.append(fits)
        settled = rows.set_column(rows.schema.get_field_index("new"), "new", pa.array(admitted, pa.bool_()))
        return settled.select(["seq", "s", "c", "_room", "c_used", "s_used", "new"]).filter(pa.array(admitted, pa.bool_()))

    return settle


def admit_two_limits(
    requests: DataFrame, order: str, student: str, klass: str,
    students: DataFrame, student_key: str, max_per_student: int,
    classes: DataFrame, class_key: str, capacity: str, utilization: float = 1.0,
    bits: int | None = None, in_sequence: int = IN_SEQUENCE,
) -> DataFrame:
    """Requests admitted in ``order`` (a unique whole number) while both the class and the student have room.

    The answer is the sequential one. A round of the parallel rule settles every request whose answer no longer depends
    on undecided ones before it: it is admitted when even all of these would leave room on both sides, and rejected when
    the admitted ones alone fill either side. What is open after PARALLEL_ROUNDS falls apart into groups without a student or
    class in common. A group of up to ``in_sequence`` requests is settled in sequence by one task, of a larger one the
    earliest so many, as no answer depends on later requests. So each further round settles ``in_sequence`` requests
    of every group at least, and a chain of requests that wait for each other does not need a round each.
    Keys are compared as text of their own type; requests with a null key are not admitted.
    """
    s_type, c_type = requests.schema[student].dataType, requests.schema[klass].dataType
    limits = classes.select(
        F.col(class_key).alias("_class"), (F.coalesce(F.col(capacity), F.lit(0)) * F.lit(utilization)).cast("double").alias("_room")
    )
    known = with_parent(requests, student, students, student_key)
    none = F.lit(0).cast("bigint")
    state = cut_lineage(known.join(limits, F.col(klass) == F.col("_class"), "inner").select(
        F.col(order).cast("bigint").alias("seq"), F.col(student).cast("string").alias("s"), F.col(klass).cast("string").alias("c"),
        "_room", none.alias("c_used"), none.alias("s_used"), F.lit(False).alias("new"),
    ))
    admitted, rounds = [], 0
    settle = _in_turn(max_per_student)
    while (undecided := state.where("not new").count()):
        if rounds >= PARALLEL_ROUNDS or undecided <= in_sequence:
            current = _with_use(state, bits) if rounds else state
            group = F.lit("").alias("g")
            if undecided > in_sequence:
                current = cut_lineage(current)
                node = lambda side: F.concat(F.lit(f"{side}:"), F.col(side))
                member = groups(current.select(node("s").alias("a"), node("c").alias("b")))
                current = current.join(member, node("c") == F.col("node")).drop("node")
                group = F.col("group").alias("g")
            turn = cut_lineage(top_per_group(current.select("*", group).drop("group"), ["g"], [F.col("seq")], in_sequence))
            done = cut_lineage(turn.groupBy("g").applyInArrow(lambda rows: settle(rows), _STATE))
            admitted.append(done.select("seq", "s", "c"))
            if undecided <= in_sequence:
                break
            left = current.select(*state.columns).join(turn.select("seq"), "seq", "left_anti")
            state = cut_lineage(left.unionByName(done))
        else:
            used = _with_use(state, bits)
            full = (F.col("c_used") >= F.col("_room")) | (F.col("s_used") >= max_per_student)
            sure = (F.col("c_used") + F.col("c_open") < F.col("_room")) & (F.col("s_used") + F.col("s_open") < max_per_student)
            state = cut_lineage(used.where(~full).withColumn("new", sure).select(*state.columns))
            admitted.append(state.where("new").select("seq", "s", "c"))
        rounds += 1
    out = reduce(DataFrame.unionByName, admitted) if admitted else state.select("seq", "s", "c")
    return out.select(
        F.col("seq").cast(requests.schema[order].dataType).alias(order), F.col("s").cast(s_type).alias(student), F.col("c").cast(c_type).alias(klass)
    )


def _with_use(state: DataFrame, bits: int | None) -> DataFrame:
    """Open requests with the room that admitted ones before them use, and the open ones before them (``c_open``, ``s_open``)."""
    rows = state
    for side in ("c", "s"):
        added = {f"{side}_new": F.col("new").cast("bigint"), f"{side}_open": (~F.col("new")).cast("bigint")}
        rows = running_totals(rows, [side], ["seq"], added, bits)
    rows = rows.where(~F.col("new"))
    return rows.withColumns({f"{side}_used": F.col(f"{side}_used") + F.col(f"{side}_new") for side in ("c", "s")})


def available_parents(
    parent: DataFrame, key: str, capacity: Column, child: DataFrame, child_key: str, utilization: float = 0.8
) -> DataFrame:
    """Parents with fewer children than ``capacity * utilization``."""
    counted = with_child_count(parent, key, child, child_key, "_current")
    return counted.where(F.col("_current") < capacity * F.lit(utilization)).drop("_current")


def capacity_stats(
    parent: DataFrame, key: str, capacity: Column, child: DataFrame, child_key: str, members: DataFrame | None = None
) -> DataFrame:
    """Totals, utilization and, with ``members``, the mean number of child rows per member."""
    counted = with_child_count(parent.withColumn("_capacity", capacity), key, child, child_key, "_current")
    stats = counted.agg(
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.sum("_capacity"), F.lit(0)).cast("bigint").alias("total_capacity"),
        F.coalesce(F.sum("_current"), F.lit(0)).alias("total_enrollments"),
    ).withColumn("capacity_utilization", share(F.col("total_enrollments"), F.col("total_capacity")))
    if members is not None:
        stats = stats.withColumn("students", members.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn(
            "avg_enrollments_per_student", share(F.col("total_enrollments"), F.col("students"))
        )
    return stats
