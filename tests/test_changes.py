"""Recounts and checks from changes, against the full ones; files that cannot be read."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from jsonloom.operators.metrics import ingest_status
from jsonloom.operators.quality.capacity import CapacityRule, EntityLimit
from jsonloom.operators.quality.consistency import FieldRule
from jsonloom.operators.quality.integrity import Reference
from jsonloom.operators.quality.suite import Rules, run_checks
from jsonloom.operators.relate import with_child_count
from jsonloom.plans.incremental import _key_deltas, recount_changes, update_checks, watches
from jsonloom.plans.ingest import METRICS, REJECTS
from jsonloom.sources.store import TableStore
from jsonloom.streaming import retries
from jsonloom.streaming.ingest import QUALITY, check_changes, in_turn, load_files, recount_each_batch, start_ingest

RULES = Rules(
    [Reference("grades", "student_id", "students"), Reference("grades", "room_id", "rooms"), Reference("students", "room_id", "rooms"),
     Reference("grades", "nothing_id", "students"), Reference("grades", "code_id", "students"), Reference("lost", "a_id", "students")],
    {"students": "student_id", "rooms": "room_id", "grades": "grade_no"},
    [CapacityRule("rooms", "room_id", "places", "students", "room_id"), CapacityRule("rooms", "room_id", "none", "students", "room_id")],
    [EntityLimit("grades", "student_id", 3)],
    [FieldRule("students", ("age",), "age > 18 or age < 10")],
)


def rows_of(checks):
    keep = ["check_group", "check_name", "passed", "message", "severity", "affected_count"]
    return sorted((tuple(r) for r in checks.select(*keep).collect()), key=repr)


def test_changes_give_what_the_whole_gives(spark, tmp_path):
    draw = random.Random(1)
    store = TableStore(spark, str(tmp_path / "s"), 5)
    for step in range(4):
        with store.batch() as batch:
            students = [(f"s{draw.randrange(12)}", i, draw.choice([None, "r1", "r2", "r9"]), draw.randrange(8, 20)) for i in range(draw.randrange(1, 9))]
            batch.upsert("students", spark.createDataFrame(students, "student_id string, at int, room_id string, age bigint"), ["student_id"], ["at"])
            if step != 1:
                rooms = [(draw.choice(["r1", "r2", "r3", None]), i, draw.choice([None, 1, 2, 9]), 99) for i in range(draw.randrange(1, 4))]
                batch.upsert("rooms", spark.createDataFrame(rooms, "room_id string, at int, places int, held bigint"), ["room_id"], ["at"])
            grades = [(draw.randrange(30), draw.choice(["s1", "s2", "s99", None]), draw.choice(["r1", "r4"]), draw.randrange(3), draw.choice([1, None]), 2.5)
                      for _ in range(draw.randrange(0, 12))]
            ddl = "grade_no bigint, student_id string, room_id string, code_id bigint, level bigint, same double"
            if step > 1:
                grades, ddl = [(*g, draw.randrange(2)) for g in grades], f"{ddl}, late_id bigint"
            batch.append("grades", spark.createDataFrame(grades, ddl))
        assert rows_of(update_checks(store, RULES)) == rows_of(run_checks(spark, store.read_all(), RULES))
        if step != 2:
            expected = {r.room_id: r.held for r in with_child_count(store.read("rooms"), "room_id", store.read("students"), "room_id", "held").collect()}
            assert recount_changes(store, "rooms", "room_id", "students", "room_id", "held")
            assert {r.room_id: r.held for r in store.read("rooms").collect()} == expected


def test_a_batch_reads_what_it_touches(spark, tmp_path):
    """A run after a small batch reads one bucket of each table, however large the tables are."""
    read = []

    class Watched(TableStore):
        def _read_parts(self, table, entry, buckets=None):
            parts = [p for p in entry.parts if buckets is None or p[0] in buckets]
            read.append((table, len(parts)))
            return super()._read_parts(table, entry, buckets)

    store = Watched(spark, str(tmp_path / "s"), 64)
    with store.batch() as batch:
        batch.upsert("rooms", spark.range(2000).selectExpr("id as room_id", "0L as held"), ["room_id"], ["room_id"])
        batch.upsert("pupils", spark.range(4000).selectExpr("id as pupil_id", "id % 2000 as room_id"), ["pupil_id"], ["pupil_id"])
    assert recount_changes(store, "rooms", "room_id", "pupils", "room_id", "held")
    with store.batch() as batch:
        batch.upsert("pupils", spark.createDataFrame([(9000, 7)], "pupil_id bigint, room_id bigint"), ["pupil_id"], ["pupil_id"])
    read.clear()
    assert recount_changes(store, "rooms", "room_id", "pupils", "room_id", "held")
    assert max(n for table, n in read if not table.startswith("_")) == 1
    held = {r.room_id: r.held for r in store.read("rooms").collect()}
    assert held[7] == 3 and sum(held.values()) == 4001


def test_deleted_batches_are_noticed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    for v in range(4):
        with store.batch() as batch:
            batch.append("t", spark.createDataFrame([(v,)], "v bigint"))
    store.vacuum(1)
    with pytest.raises(ValueError):
        store.changed("t", 1)


def school_file(folder, i, zipped=False):
    document = {"students": [{"student_id": f"S{i}", "room_id": "R1"}], "rooms": [{"room_id": "R1", "places": 2, "held": 0}]}
    text = json.dumps(document)
    if zipped:
        (folder / f"f{i}.json.gz").write_bytes(gzip.compress(text.encode()))
    else:
        (folder / f"f{i}.json").write_text(text)


@pytest.mark.parametrize("lines", [False])
def test_an_unreadable_file_waits_and_is_set_aside(spark, tmp_path, lines):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(9):
        school_file(source, i)
    broken, mended = source / "g1.json.gz", source / "g2.json.gz"
    broken.write_bytes(gzip.compress(b'{"students": [' + b" " * 100_000)[:60])
    mended.write_bytes(b"\x1f\x8bnothing")
    store, checkpoint = TableStore(spark, str(tmp_path / "store"), 2), str(tmp_path / "check")
    rules = Rules([Reference("students", "room_id", "rooms")], {"students": "student_id"}, [CapacityRule("rooms", "room_id", "places", "students", "room_id")])
    hooks = in_turn(recount_each_batch("rooms", "room_id", "students", "room_id", "held"), check_changes(rules))
    run = lambda: start_ingest(spark, str(source), store, checkpoint, lines, "*.json*", after_batch=hooks).awaitTermination()
    run()
    assert store.read("students").count() == 9 and store.read("rooms").first().held == 9
    assert retries.waiting_files(store) and set(retries.waiting_files(store).values()) == {1}
    assert REJECTS not in store.tables() or store.read(REJECTS).count() == 0
    school_file(source, 20)
    run()
    assert set(retries.waiting_files(store).values()) == {2} and store.read("students").count() == 10
    mended.write_bytes(gzip.compress(json.dumps({"students": [{"student_id": "S30", "room_id": "R1"}]}).encode()))
    assert load_files(store, [], lines)  # no new file comes: the waiting ones are tried
    assert retries.waiting_files(store) == {} and store.read("students").count() == 11
    states = {r.path.rsplit("/", 1)[1]: (r.attempts, r.state) for r in store.read(retries.FILES).collect()}
    assert states == {"g1.json.gz": (3, retries.SET_ASIDE), "g2.json.gz": (3, retries.LOADED)}
    rejected = store.read(REJECTS).collect()
    assert [r.path.rsplit("/", 1)[1] for r in rejected] == ["g1.json.gz"] and rejected[0].reason.startswith("unreadable in 3 attempts")
    status = ingest_status(spark, store.read(METRICS)).first()
    assert (status.processed_count, status.failed_count) == (11, 1)
    assert not load_files(store, [], lines)
    assert store.read(QUALITY).orderBy(F.desc("batch")).first().errors == 1  # ten in a room for two


def test_a_batch_of_bad_files_only(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(b"\x1f\x8bnothing")
    store = TableStore(spark, str(tmp_path / "store"), 2)
    assert load_files(store, [str(tmp_path / "a.json.gz"), str(tmp_path / "never.json")])
    assert len(retries.waiting_files(store)) == 2 and store.read(METRICS).first().processed == 0


def test_errors_that_are_no_file_s_are_raised(spark, tmp_path, monkeypatch):
    school_file(tmp_path, 1)
    store = TableStore(spark, str(tmp_path / "store"), 2)
    monkeypatch.setattr("jsonloom.plans.ingest.discover", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_files(store, [str(tmp_path / "f1.json")])
    assert retries.FILES not in store.manifest()


def test_counts_of_checks_are_not_sorted(spark, tmp_path):
    """Checks that share a column get its counts each, from hash aggregates alone."""
    store = TableStore(spark, str(tmp_path / "s"), 4)
    rules = Rules([Reference("grades", "student_id", "students")], {"students": "student_id"},
                  [CapacityRule("students", "student_id", "places", "grades", "student_id")], [EntityLimit("grades", "student_id", 1)])
    with store.batch() as batch:
        batch.upsert("students", spark.createDataFrame([(1, 1), (2, None)], "student_id bigint, places int"), ["student_id"], ["student_id"])
        batch.append("grades", spark.createDataFrame([(1,), (1,), (2,), (None,)], "student_id bigint"))
    wanted = watches(store.read_all(), rules)
    deltas = _key_deltas(store, wanted, {w.rule: 0 for w in wanted}, 1)
    plan = deltas._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    found = {(r.rule, r.key): (r.c, r.p, r.capped and (r.capped.cap,)) for r in deltas.collect()}
    assert found[("capacity:0", "1")] == (2, 1, (1.0,)) and found[("capacity:0", "2")] == (1, 1, (None,))
    assert found[("limit:0", "1")] == (2, 0, None) and ("limit:0", "\u0000null") not in found
    assert rows_of(update_checks(store, rules)) == rows_of(run_checks(spark, store.read_all(), rules))
