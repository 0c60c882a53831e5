"""Joins, ordered operators and alignment against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators import relate
from jsonloom.operators.align import align_columns, union_batches
from jsonloom.operators.ordering import (
    gap_statistics, in_segments, keep_last, running_totals, sequential_ids, with_previous,
)

RECOUNT_CASES = {
    "basic": ([("c1", 0), ("c2", 0)], [("c1", "s1"), ("c1", "s2")], {"c1": 2, "c2": 0}),
    "no children": ([("c1", 0)], [], {"c1": 0}),
    "unknown parent": ([("c1", 0)], [("c1", "s1"), ("c2", "s2")], {"c1": 1}),
    "empty parents": ([], [("c1", "s1")], {}),
    "null keys": ([("c1", 9)], [(None, "s1")], {"c1": 0}),
}


@pytest.mark.parametrize("case", RECOUNT_CASES)
def test_recount(spark, case):
    classes, enrollments, expected = RECOUNT_CASES[case]
    parent = spark.createDataFrame(classes, "class_id string, current_enrollment bigint")
    child = spark.createDataFrame(enrollments, "class_id string, student_id string")
    rows = relate.with_child_count(parent, "class_id", child, "class_id", "current_enrollment").collect()
    assert {r.class_id: r.current_enrollment for r in rows} == expected


def test_recount_creates_column(spark):
    parent = spark.createDataFrame([("c1",)], "class_id string")
    child = spark.createDataFrame([("c1", "s1")], "class_id string, student_id string")
    row = relate.with_child_count(parent, "class_id", child, "class_id", "current_enrollment").first()
    assert row.current_enrollment == 1


def test_text_keys_never_match_numbers(spark):
    parent = spark.createDataFrame([(1, 0)], "class_id bigint, current_enrollment bigint")
    child = spark.createDataFrame([("1", "s1"), ("c2", "s2")], "class_id string, student_id string")
    assert relate.with_child_count(parent, "class_id", child, "class_id", "current_enrollment").first().current_enrollment == 0
    texts = parent.withColumn("class_id", F.col("class_id").cast("string"))
    assert relate.with_child_count(texts, "class_id", child, "class_id", "current_enrollment").first().current_enrollment == 1
    assert relate.orphan_rows(child, "class_id", parent, "class_id").count() == 2


def hot_rows(seed, n=400, keys=12):
    """Rows in arrival order; one key holds a third of them and some keys are null."""
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([None, "hot"]) if rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
    return [(i, pick(), rnd.randrange(100)) for i in range(n)]


@pytest.mark.parametrize("segments", [None, 5])
def test_running_totals_match_a_loop(spark, segments):
    rows = hot_rows(1)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint").repartition(6)
    got = {r.seq: (r.before, r.total) for r in running_totals(df, ["k"], ["seq"], {"before": F.lit(1), "total": F.col("v")}, segments).collect()}
    count, total, expected = Counter(), Counter(), {}
    for seq, k, v in rows:
        expected[seq] = (count[k], total[k])
        count[k] += 1
        total[k] += v
    assert got == expected


@pytest.mark.parametrize("segments", [None, 7])
def test_ids_and_previous_match_a_loop(spark, segments):
    values = sorted(random.Random(2).sample(range(10_000), 300))
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(5)
    ids = {r.v: r.id for r in sequential_ids(df, ["v"], "id", "S", 1000, segments).collect()}
    assert ids == {v: f"S{1000 + i}" for i, v in enumerate(values)}
    previous = {r.v: r.p for r in with_previous(df, "v", "p", segments).collect()}
    assert previous == dict(zip(values, [None, *values[:-1]]))


def test_ids_in_order_of_text_and_times(spark):
    df = spark.createDataFrame([(f"it's \\ {i:03d}", i) for i in range(300)], "a string, b bigint").withColumn(
        "t", F.timestamp_seconds("b")
    )
    for columns in (["a"], ["t"], ["a", "t"]):
        ids = sequential_ids(df, columns, "id", "", 0, 4).collect()
        assert all(int(r.id) == r.b for r in ids)


def test_segments_keep_their_size(spark):
    """The plan and the rows of a window stay the same when the rows grow tenfold, also for one key that holds them all."""
    plans = []
    for n in (300, 3000):
        df = spark.range(n, numPartitions=3).selectExpr("'hot' as k", "id as seq")
        cut = in_segments(df, ["k", "seq"], 5)
        sizes = [r["count"] for r in cut.groupBy("_segment").count().collect()]
        assert max(sizes) <= 32 and sum(sizes) == n and len(sizes) >= n / 32
        totals = running_totals(df, ["k"], ["seq"], {"before": F.lit(1)}, 5)
        assert totals.where("before <> seq").count() == 0
        plans.append(len(totals._jdf.queryExecution().optimizedPlan().toString()))
    assert abs(plans[0] - plans[1]) < 200


@pytest.mark.parametrize("segments", [None, 3])
def test_gaps(spark, segments):
    df = spark.createDataFrame([(s,) for s in (5, 0, 2)], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    assert tuple(gap_statistics(df, "ts", segments).first()) == (2.5, 2.0, 3.0)
    same = spark.createDataFrame([(s,) for s in (0, 0, 0, 4)], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    avg, low, high = gap_statistics(same, "ts", segments).first()
    assert (round(avg, 6), low, high) == (round(4 / 3, 6), 0.0, 4.0)
    only = spark.createDataFrame([(0,), (0,)], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    assert tuple(gap_statistics(only, "ts").first()) == (0.0, 0.0, 0.0)


def test_keep_last_and_repeats(spark):
    rows = hot_rows(3)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint").repartition(6)
    last, first, members = {}, {}, defaultdict(list)
    for seq, k, v in rows:
        last[k] = (seq, k, v)
        first.setdefault(k, seq)
        members[k].append(seq)
    assert {r.k: tuple(r) for r in keep_last(df, ["k"], ["seq"]).collect()} == last
    assert {r.k: tuple(r) for r in relate.last_declaration(df, "k", ["seq"]).collect()} == {k: v for k, v in last.items() if k}
    repeats = {r.seq for r in relate.repeated_occurrences(df, "k", ["seq"]).collect()}
    assert repeats == {s for s, k, _ in rows if k and s != first[k]}
    duplicated = {r.seq: r.n for r in relate.duplicate_rows(df, ["k"]).collect()}
    assert duplicated == {s: len(m) for m in members.values() if len(m) > 1 for s in m}


def test_count_since_reset_matches_a_loop(spark):
    rows = hot_rows(4)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint").repartition(6)
    resets, child = df.where("v % 7 = 0"), df.where("v % 7 <> 0")
    counts = {}
    for _, k, v in rows:
        if k and v % 7 == 0:
            counts[k] = 0
        elif k in counts:
            counts[k] += 1
    got = relate.count_since_reset(resets, "k", child, "k", ["seq"]).collect()
    assert {r.k: r.since_reset for r in got} == counts


def test_references(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), (None,), ("y",), ("x",)], "fk string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pk string")
    row = relate.reference_summary(child, "fk", parent, "pk").first()
    assert tuple(row) == (5, 3, 3, 2, 2)
    assert sorted(r.fk for r in relate.orphan_rows(child, "fk", parent, "pk").collect()) == ["x", "x", "y"]
    assert relate.with_parent(child, "fk", parent, "pk").count() == 2


def test_dependency_filter_follows_parents(spark):
    tables = {
        "a": spark.createDataFrame([(1,)], "a_id int"),
        "b": spark.createDataFrame([(1, 1), (2, 9)], "b_id int, a_id int"),
        "c": spark.createDataFrame([(1, 1), (2, 2)], "c_id int, b_id int"),
    }
    kept = relate.dependency_filter(tables, [("c", "b_id", "b", "b_id"), ("b", "a_id", "a", "a_id")])
    assert [r.c_id for r in kept["c"].collect()] == [1]
    with pytest.raises(ValueError):
        relate.dependency_filter(tables, [("c", "b_id", "b", "b_id"), ("b", "b_id", "c", "b_id")])


def test_star_join_on_equal_names(spark):
    students = spark.createDataFrame([("s1", "Ann")], "student_id string, name string")
    classes = spark.createDataFrame([("c1", "Math")], "class_id string, title string")
    links = spark.createDataFrame([("s1", "c1"), ("s2", "c1")], "student_id string, class_id string")
    rows = relate.star_join(links, [(students, "student_id", "student_id"), (classes, "class_id", "class_id")]).collect()
    assert [(r.name, r.title) for r in rows] == [("Ann", "Math")]


def test_alignment(spark):
    df = spark.createDataFrame([("1", 2.0), ("x", 2.5), (None, None)], "a string, b double")
    schema = T.StructType.fromDDL("a bigint, b bigint, c string")
    got = [(r.a, r.b, r.c, r.lost_fields) for r in align_columns(df, schema).collect()]
    assert got == [(1, 2, None, []), (None, None, None, ["a", "b"]), (None, None, None, [])]


def test_union_of_drifted_types(spark):
    a = spark.createDataFrame([(1, 5)], "k bigint, v bigint")
    b = spark.createDataFrame([("s", 2.5)], "k string, w double")
    assert sorted(tuple(r) for r in union_batches([a, b]).collect()) == [("1", 5, None), ("s", None, 2.5)]
