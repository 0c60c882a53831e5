"""Arrival analysis and admission against sequential models."""

import json
import random

import pytest

from jsonloom.operators.allocate import admit_single_limit, admit_two_limits, available_parents, capacity_stats
from jsonloom.operators.arrival import METRICS, arrival_issues, compare_metrics, entity_counts, score_issues
from jsonloom.operators.shred import shred
from jsonloom.plans.school import ARRIVAL
from jsonloom.sources.documents import read_documents
from jsonloom.sources.reports import comparison_markdown
from pyspark.sql import functions as F


def analyse(spark, path):
    docs = read_documents(spark, path)
    return score_issues(arrival_issues(shred(docs, keep_rejects=True), ARRIVAL))


def write(tmp_path, documents):
    for i, document in enumerate(documents):
        text = document if isinstance(document, str) else json.dumps(document)
        (tmp_path / f"school_data_20250101_{i:06d}_000000.json").write_text(text)
    return str(tmp_path)


def model(documents):
    """One document after the other, as they arrive."""
    seen = {"teachers": set(), "students": set(), "classes": set()}
    room, count = {}, {}
    duplicates = orphans = unreadable = 0
    for document in documents:
        if isinstance(document, str):
            unreadable += 1
            continue
        for table, records in document.items():
            for r in records:
                if table in seen:
                    key = r.get(ARRIVAL.keys[table])
                    if key:
                        duplicates += key in seen[table]
                        seen[table].add(key)
                        if table == "classes":
                            room[key], count[key] = r.get("max_capacity", 0), 0
                if table == "classes" and r.get("teacher_id"):
                    orphans += r["teacher_id"] not in seen["teachers"]
                if table == "student_classes":
                    orphans += bool(r.get("student_id")) and r["student_id"] not in seen["students"]
                    orphans += bool(r.get("class_id")) and r["class_id"] not in seen["classes"]
                    if r.get("class_id") in count:
                        count[r["class_id"]] += 1
    over = sum(count[c] > room[c] for c in count)
    score = max(0.0, 100.0 - duplicates - 5 * orphans - 3 * over - 10 * unreadable)
    return duplicates, orphans, over, unreadable, score


def random_documents(seed, n=14):
    rnd = random.Random(seed)
    pick = lambda prefix, k=5: rnd.choice([None, "", *[f"{prefix}{i}" for i in range(k)]])
    documents = []
    for _ in range(n):
        tables = {
            "teachers": [{"teacher_id": pick("T")} for _ in range(rnd.randrange(1, 3))],
            "students": [{"student_id": pick("S")} for _ in range(rnd.randrange(1, 3))],
            "classes": [{"class_id": pick("C"), "teacher_id": pick("T"), "max_capacity": rnd.randrange(3)} for _ in range(rnd.randrange(1, 3))],
            "student_classes": [{"student_class_id": "x", "student_id": pick("S"), "class_id": pick("C")} for _ in range(rnd.randrange(1, 5))],
        }
        names = list(tables)
        rnd.shuffle(names)
        documents.append("{broken" if rnd.random() < 0.1 else {t: tables[t] for t in names})
    return documents


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_streams(spark, tmp_path, seed):
    documents = random_documents(seed)
    assert tuple(analyse(spark, write(tmp_path, documents)).first()) == model(documents)


CASES = {
    "orphan at arrival": (
        [{"student_classes": [{"student_id": "S1"}]}, {"students": [{"student_id": "S1"}]}], (0, 1, 0, 0, 95.0)),
    "same file order": ([{"classes": [{"class_id": "C1", "teacher_id": "T1", "max_capacity": 1}], "teachers": [{"teacher_id": "T1"}]}], (0, 1, 0, 0, 95.0)),
    "reset": (
        [
            {"classes": [{"class_id": "C1", "max_capacity": 1}], "student_classes": [{"class_id": "C1"}, {"class_id": "C1"}]},
            {"classes": [{"class_id": "C1", "max_capacity": 1}], "student_classes": [{"class_id": "C1"}]},
        ],
        (1, 0, 0, 0, 99.0),
    ),
    "unreadable": (["{"], (0, 0, 0, 1, 90.0)),
}


@pytest.mark.parametrize("case", CASES)
def test_cases(spark, tmp_path, case):
    documents, expected = CASES[case]
    assert tuple(analyse(spark, write(tmp_path, documents)).first()) == expected == model(documents)


def test_unknown_tables_are_counted(spark, tmp_path):
    path = write(tmp_path, [{"rooms": [{"r": 1}, {"r": 2}], "students": [{"student_id": "S1"}]}])
    counts = {r.table: r.n for r in entity_counts(shred(read_documents(spark, path))).collect()}
    assert counts == {"rooms": 2, "students": 1}


def test_comparison(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    first = analyse(spark, write(tmp_path / "a", CASES["reset"][0]))
    second = analyse(spark, write(tmp_path / "b", CASES["orphan at arrival"][0]))
    rows = {
        r["metric"]: (r["first"], r["second"], r["difference"]) for r in compare_metrics(first, second, METRICS).collect()
    }
    assert rows["integrity_score"] == (99.0, 95.0, -4.0) and rows["orphaned_references"] == (0.0, 1.0, 1.0)
    assert "| integrity_score | 99 | 95 | -4 |" in comparison_markdown(compare_metrics(first, second, METRICS), ("one", "two"), "now")


def admitted(requests, students, rooms, most, utilization):
    per_class, per_student, out = {}, {}, set()
    for seq, s, c in sorted(requests):
        if s not in students or c not in rooms:
            continue
        if per_class.get(c, 0) < rooms[c] * utilization and per_student.get(s, 0) < most:
            per_class[c], per_student[s] = per_class.get(c, 0) + 1, per_student.get(s, 0) + 1
            out.add(seq)
    return out


@pytest.mark.parametrize("seed, segments", [(1, None), (2, 4), (3, 6)])
def test_admission_matches_a_loop(spark, seed, segments):
    rnd = random.Random(seed)
    students, rooms = {f"s{i}" for i in range(40)}, {f"c{i}": rnd.randrange(1, 25) for i in range(10)}
    requests = [
        (i, f"s{rnd.randrange(44)}", "c0" if rnd.random() < 0.35 else f"c{rnd.randrange(12)}") for i in range(500)
    ]
    got = admit_two_limits(
        spark.createDataFrame(requests, "seq bigint, s string, c string").repartition(5), "seq", "s", "c",
        spark.createDataFrame([(s,) for s in students], "s string"), "s", 4,
        spark.createDataFrame(list(rooms.items()), "c string, room bigint"), "c", "room", 0.8, segments,
    )
    assert {r.seq for r in got.collect()} == admitted(requests, students, rooms, 4, 0.8)


def run_admission(spark, requests, most, rooms, **settings):
    students = {s for _, s, _ in requests}
    got = admit_two_limits(
        spark.createDataFrame(requests, "seq bigint, s string, c string").repartition(5), "seq", "s", "c",
        spark.createDataFrame([(s,) for s in students], "s string"), "s", most,
        spark.createDataFrame(list(rooms.items()), "c string, room bigint"), "c", "room", 1.0, **settings,
    )
    assert {r.seq for r in got.collect()} == admitted(requests, students, rooms, most, 1.0)


@pytest.mark.parametrize("in_sequence", [7, 60, 1000])
def test_admission_in_groups(spark, in_sequence):
    """Many small groups and one large, with groups, slices of the large one, or all settled in sequence."""
    rnd = random.Random(5)
    requests = [(f"s{g}x{rnd.randrange(4)}", f"c{g}x{rnd.randrange(3)}") for g in range(8) for _ in range(12)]
    requests += [(f"t{rnd.randrange(30)}", f"d{rnd.randrange(8)}") for _ in range(90)]
    rnd.shuffle(requests)
    rooms = {c: rnd.randrange(1, 6) for _, c in requests}
    run_admission(spark, [(i, s, c) for i, (s, c) in enumerate(requests)], 2, rooms, bits=5, in_sequence=in_sequence)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Each request waits for the one before it: student and class in turn are what the two have in common."""
    from jsonloom.operators import allocate

    rounds = []
    real = allocate.cut_lineage
    monkeypatch.setattr(allocate, "cut_lineage", lambda df: rounds.append(1) or real(df))
    requests = [(i, f"s{(i + 1) // 2}", f"c{i // 2}") for i in range(10_000)]
    run_admission(spark, requests, 1, {c: 1 for _, _, c in requests})
    assert len(rounds) < 12


def test_components(spark):
    from jsonloom.operators.graph import groups

    rnd = random.Random(8)
    edges = [(f"n{rnd.randrange(70):03d}", f"n{rnd.randrange(70):03d}") for _ in range(45)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.group for r in groups(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for e in edges for x in e}


def test_admission_example(spark):
    requests = spark.createDataFrame([(1, "s1", "c"), (2, "s1", "c"), (3, "s2", "c"), (4, "s3", "c")], "seq bigint, s string, c string")
    students = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "s string")
    classes = spark.createDataFrame([("c", 2)], "c string, room bigint")
    rows = admit_two_limits(requests, "seq", "s", "c", students, "s", 1, classes, "c", "room").collect()
    assert sorted(r.seq for r in rows) == [1, 3]


@pytest.mark.parametrize("segments", [None, 5])
def test_single_limit_and_room(spark, segments):
    rnd = random.Random(7)
    requests = [(i, "hot" if rnd.random() < 0.5 else f"c{rnd.randrange(5)}") for i in range(200)]
    df = spark.createDataFrame(requests, "seq bigint, c string").repartition(4)
    limit = F.when(F.col("c") == "hot", 21 * 0.8).otherwise(9.0)
    got = {r.seq for r in admit_single_limit(df, "c", limit, ["seq"], segments).collect()}
    seen, expected = {}, set()
    for seq, c in requests:
        if seen.get(c, 0) < (21 * 0.8 if c == "hot" else 9.0):
            expected.add(seq)
        seen[c] = seen.get(c, 0) + 1
    assert got == expected and sum(c == "hot" for s, c in requests if s in got) == 17


def test_available_and_stats(spark):
    parents = spark.createDataFrame([("a", 5), ("b", 5), ("c", 0)], "c string, room bigint")
    child = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3, "c string")
    free = available_parents(parents, "c", F.col("room"), child, "c").collect()
    assert [r.c for r in free] == ["b"]
    row = capacity_stats(parents, "c", F.col("room"), child, "c", spark.range(2)).first()
    assert (row.total_capacity, row.total_enrollments, row.capacity_utilization, row.avg_enrollments_per_student) == (10, 7, 0.7, 3.5)
