"""Contracts, the table store, and streaming ingest."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.contracts import Contract, Field, check_documents, check_records, document_records
from jsonloom.operators.metrics import ingest_status, run_report, size_metrics, table_stats, table_totals
from jsonloom.plans import school
from jsonloom.plans.catalog import discover
from jsonloom.plans.ingest import (
    METRICS, REJECTS, IngestOptions, ingest_contracts, ingest_documents, initialize, stored_catalog,
)
from jsonloom.plans.validate import recount
from jsonloom.operators.shred import shred
from jsonloom.sources.documents import list_files, read_documents
from jsonloom.sources.export import documents, write_files, write_lines
from jsonloom.sources.reports import run_report_json
from jsonloom.sources.store import BatchConflict, TableStore
from jsonloom.streaming.ingest import (
    QUALITY, check_each_batch, compact_every, discover_then_ingest, document_every, in_turn, recount_each_batch, start_ingest,
)

STUDENT = {"student_id": "S1", "first_name": "a", "last_name": "b", "age": 15, "gender": "f", "year": 10, "gpa": 3.5}
CLASS = {
    "class_id": "C1", "class_name": "n", "room_number": "1", "teacher_id": "T1", "schedule": "s", "semester": "q",
    "max_capacity": 2, "current_enrollment": 2,
}


@pytest.mark.parametrize(
    "change, problem",
    [
        ({}, None), ({"age": 5}, None), ({"age": 26}, "students.age: outside 5..25"), ({"gpa": 4.1}, "students.gpa: outside 0..4"),
        ({"year": 0}, "students.year: outside 1..12"), ({"age": None}, "students.age: missing"), ({"age": "15"}, None),
        ({"age": 15.5}, "students.age: not int"), ({"age": "x"}, "students.age: not int"), ({"email": None}, None),
        ({"address": {"k": 1}}, "students.address: not string"), ({"unknown": 1}, None), ({"gpa": "NaN"}, "students.gpa: outside 0..4"),
        ({"first_name": '{"k":1}'}, None),
    ],
)
def test_record_contract(spark, folder, change, problem):
    record = {**STUDENT, **change}
    rows = spark.createDataFrame([(json.dumps(record),)], "record string")
    assert check_records(rows, school.STUDENTS).first().violations == ([problem] if problem else [])
    docs = read_documents(spark, folder(doc={"students": [record]}))
    assert check_documents(docs, school.CONTRACTS).first().violations == ([problem] if problem else [])


def test_documents_are_rejected_whole(spark, folder):
    bad = {**CLASS, "class_id": "C2", "current_enrollment": 3}
    path = folder(
        good={"data": {"students": [STUDENT], "classes": [CLASS], "teachers": None}},
        bad={"students": [{**STUDENT, "student_id": "S2"}], "classes": [CLASS, bad]},
        shape={"students": "none"}, member={"students": [STUDENT, 5]}, empty={"rooms": [{"r": 1}]}, broken="{",
    )
    checked = check_documents(read_documents(spark, path), school.CONTRACTS)
    found = {r.path.rsplit("/", 1)[1][:-5]: r.violations for r in checked.collect()}
    assert found == {
        "good": [], "bad": ["classes: enrollment within capacity"], "shape": ["students: not a list of records"],
        "member": ["students: not a list of records"], "empty": ["no known table"], "broken": ["not a JSON object"],
    }
    assert [r.student_id for r in document_records(checked, school.STUDENTS).collect()] == ["S1"]


def test_contract_ingest_is_all_or_nothing(spark, folder, tmp_path):
    path = folder(good={"students": [STUDENT]}, bad={"students": [{**STUDENT, "student_id": "S2", "age": 99}]})
    store = TableStore(spark, str(tmp_path / "store"), 2)
    assert ingest_contracts(store, read_documents(spark, path), 1, school.CONTRACTS)
    assert [r.student_id for r in store.read("students").collect()] == ["S1"]
    assert store.read("classes").count() == 0 and store.read("classes").schema["max_capacity"].dataType == T.IntegerType()
    assert json.loads(store.read(REJECTS).first().record)["students"][0]["student_id"] == "S2"
    batches, files = store.batches(), store.read("students").inputFiles()
    assert not ingest_contracts(store, read_documents(spark, f"{path}/*.json"), 1, school.CONTRACTS)
    assert (store.batches(), store.read("students").inputFiles()) == (batches, files)


def test_records_are_rejected_alone(spark, folder, tmp_path):
    bad = {**STUDENT, "student_id": "S2", "age": 99, "gpa": 9.0}
    path = folder(mixed={"students": [bad, STUDENT, bad], "classes": [CLASS, {**CLASS, "class_id": "C2", "current_enrollment": 3}]}, shape={"students": "none"})
    store = TableStore(spark, str(tmp_path / "store"), 2)
    assert ingest_contracts(store, read_documents(spark, path), 1, school.CONTRACTS, scope="record")
    assert [r.student_id for r in store.read("students").collect()] == ["S1"] and [r.class_id for r in store.read("classes").collect()] == ["C1"]
    rejects = sorted((r.table, r.rec_pos, r.reason) for r in store.read(REJECTS).collect())
    assert rejects == [
        ("_quarantine", 0, "students: not a list of records"), ("classes", 1, "classes: enrollment within capacity"),
        ("students", 0, "students.age: outside 5..25; students.gpa: outside 0..4"), ("students", 2, "students.age: outside 5..25; students.gpa: outside 0..4"),
    ]
    assert json.loads(store.read(REJECTS).where("table = 'students'").first().record)["age"] == 99
    counts = store.read(METRICS).first()
    assert (counts.processed, counts.failed) == (1, 1)
    with pytest.raises(ValueError):
        check_documents(read_documents(spark, f"{path}/*.json"), school.CONTRACTS, "table")


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_matches_a_dict(spark, tmp_path, seed):
    rnd = random.Random(seed)
    store, expected = TableStore(spark, str(tmp_path / "s"), 3), {}
    for batch_id in range(1, 5):
        rows = [(rnd.choice([None, *"abcdefgh"]), i, rnd.randrange(100)) for i in range(rnd.randrange(1, 30))]
        expected.update({k: (k, v) for k, _, v in rows})
        df = spark.createDataFrame(rows, "k string, seq bigint, v bigint").repartition(3)
        schema = T.StructType.fromDDL("k string, v bigint")
        with store.batch(batch_id) as batch:
            batch.upsert("t", df, ["k"], ["seq"], schema)
        assert {r.k: tuple(r) for r in store.read("t").collect()} == expected
    before = {r.k: tuple(r) for r in store.read("t", 3).collect()}
    assert store.read("t", 3).count() == len(before)
    store.vacuum(1)
    assert {r.k: tuple(r) for r in store.read("t").collect()} == expected


def test_batch_is_published_whole_and_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    one = spark.createDataFrame([("a", 1)], "k string, v bigint")
    with pytest.raises(RuntimeError):
        with store.batch(1) as batch:
            batch.upsert("t", one, ["k"], ["v"])
            raise RuntimeError("executor lost")
    assert store.tables() == []
    for _ in range(2):
        with store.batch(1) as batch:
            batch.upsert("t", one, ["k"], ["v"])
            batch.append("log", one)
    assert store.read("t").count() == 1 and store.read("log").count() == 1 and store.batches() == [1]


def test_schema_changes_between_batches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 4)
    for i, (rows, ddl) in enumerate([([("a", 1)], "k string, v bigint"), ([("b", 2.5)], "k string, v double"), ([("a", "x", 1)], "k string, v string, w bigint")]):
        with store.batch(i + 1) as batch:
            batch.upsert("t", spark.createDataFrame(rows, ddl), ["k"], ["k"])
            batch.append("log", spark.createDataFrame(rows, ddl))
    assert sorted(tuple(r) for r in store.read("t").collect()) == [("a", "x", 1), ("b", "2.5", None)]
    assert sorted(r.v for r in store.read("log").collect()) == ["1", "2.5", "x"]


def test_recount_preconditions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    assert not recount(store, *school.RECOUNT)
    with store.batch(1) as batch:
        batch.append("classes", spark.createDataFrame([("class_a", 0)], "name string, current_enrollment bigint"))
        batch.append("student_classes", spark.createDataFrame([("c1",)], "class_id string"))
    assert not recount(store, *school.RECOUNT) and store.batches() == [1]


def test_values_that_do_not_fit_are_rejected(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    initialize(store, discover(shred(read_documents(spark, folder(a={"t": [{"t_id": 1, "v": 1}]})))))
    assert store.read("t").count() == 0 and store.read("t").schema["v"].dataType == T.LongType()
    docs = read_documents(spark, folder(a={"t": [{"t_id": 1, "v": 2}, {"t_id": 2, "v": "x"}, 7], "u": [{"n": 1}]}, b={"u": [{"n": 1}]}))
    ingest_documents(store, docs, options=IngestOptions(frozen=True))
    assert [tuple(r) for r in store.read("t").collect()] == [(1, 2)] and "u" not in store.tables()
    reasons = sorted(r.reason for r in store.read(REJECTS).collect())
    assert reasons == ["record is not a JSON object", "value does not fit its type: v"]
    counts = store.read(METRICS).first()
    assert (counts.processed, counts.failed, counts.skipped) == (1, 0, 1)


def test_types_widen_with_new_batches(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), 2)
    path = folder(a={"t": [{"t_id": 1, "v": 1}]}, b={"t": [{"t_id": 2, "v": "x", "w": [1]}], "fresh": [{"z": 1}]})
    for i, name in enumerate("ab"):
        ingest_documents(store, read_documents(spark, f"{path}/{name}.json"), i + 1)
    assert sorted(tuple(r) for r in store.read("t").collect()) == [(1, "1", None), (2, "x", [1])]
    assert store.read("fresh").count() == 1


def school_files(tmp_path, numbers):
    for i in numbers:
        document = {"data": {
            "students": [{"student_id": f"S{j}", "age": 15, "year": 10, "note": i} for j in range(i, i + 3)],
            "classes": [{"class_id": f"C{i}", "max_capacity": 2, "current_enrollment": 0}],
            "student_classes": [{"student_class_id": f"E{i}{j}", "student_id": f"S{j}", "class_id": f"C{i}"} for j in range(i, i + 3)],
        }}
        (tmp_path / f"school_data_20250101_{i:06d}_000000.json").write_text(json.dumps(document, indent=2))


def test_stream_restart_and_replay(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    store, checkpoint = TableStore(spark, str(tmp_path / "store"), 2), str(tmp_path / "check")
    school_files(source, range(3))
    (source / "school_data_20250101_000099_000000.json").write_text("{broken")
    rules = school.with_school_rules(discover(shred(read_documents(spark, str(source)))).rules())

    hooks = in_turn(recount_each_batch(*school.RECOUNT), check_each_batch(rules))
    start_ingest(spark, str(source), store, checkpoint, after_batch=recount_each_batch(*school.RECOUNT)).awaitTermination()
    assert store.read("students").count() == 5
    assert {r.class_id: r.current_enrollment for r in store.read("classes").collect()} == {"C0": 3, "C1": 3, "C2": 3}
    school_files(source, range(3, 5))
    start_ingest(spark, str(source), store, checkpoint, after_batch=hooks).awaitTermination()
    notes = {r.student_id: r.note for r in store.read("students").collect()}
    assert notes == {"S0": 0, "S1": 1, "S2": 2, "S3": 3, "S4": 4, "S5": 4, "S6": 4}
    assert store.read(QUALITY).first().errors == 1  # classes over capacity
    status = ingest_status(spark, store.read(METRICS)).first()
    assert (status.processed_count, status.failed_count) == (5, 1)
    assert store.read(REJECTS).first().record == "{broken"
    # a replayed batch changes nothing, also after other writers have published
    batches, stream = store.batches(), (tmp_path / "check" / "stream_id.txt").read_text()
    for epoch in (0, 1):
        assert not ingest_documents(store, read_documents(spark, str(source)), token=(stream, epoch))
        hooks(store, stream, epoch)
    assert store.batches() == batches
    # a lost source checkpoint hands the files over again: keyed tables end up the same
    school_files(source, [7])
    start_ingest(spark, str(source), store, str(tmp_path / "other"), after_batch=compact_every(1)).awaitTermination()
    assert store.batches()[-1] > batches[-1] and store.read("student_classes").count() == 18
    assert store.read(METRICS).count() == 3 and len(store.manifest()[METRICS].parts) == 1


def test_two_phase_stream_writes_documents(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    school_files(source, range(2))
    store = TableStore(spark, str(tmp_path / "store"), 2)
    docs = str(tmp_path / "docs")
    query = discover_then_ingest(
        spark, str(source), store, str(tmp_path / "check"), sample_files=1,
        after_batch=document_every(1, docs, lambda: "now"), archive_dir=str(tmp_path / "archive"),
    )
    query.awaitTermination()
    assert store.read("student_classes").count() == 6
    assert json.loads((tmp_path / "docs" / "schema_documentation.json").read_text())["total_tables"] == 3
    assert stored_catalog(store).keys()["classes"] == "class_id"


def test_export_and_file_metrics(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, None), (0, 2, "a\"b"), (1, 3, "c")], "batch bigint, x_id bigint, t string")
    docs = documents({"xs": rows, "ys": rows.where("batch = 0")}, "batch", order=["x_id"])
    write_lines(docs, str(tmp_path / "lines"))
    write_files(docs, str(tmp_path / "files"))
    for settings in ({"path": str(tmp_path / "lines"), "lines": True}, {"path": str(tmp_path / "files"), "recursive": True}):
        read = read_documents(spark, glob="*.txt", **settings)
        envelopes = [json.loads(r.text) for r in read.collect()]
        assert sorted(e["metadata"]["entity_counts"].get("ys", 0) for e in envelopes) == [0, 2]
        records = sorted((r.table, r.record) for r in shred(read).collect())
        assert ("xs", '{"x_id":1,"t":null}') in records and len(records) == 5
    files = list_files(spark, str(tmp_path / "files"), "*.txt", recursive=True)
    row = size_metrics(files).first()
    assert row.files == 2 and row.size_bytes_total == sum(f.stat().st_size for f in (tmp_path / "files").rglob("*.txt"))
    stats = table_stats({"xs": rows, "none": rows.where("x_id > 9")})
    assert {r.table_name: r.record_count for r in stats.collect()} == {"xs": 3, "none": 0}
    sizes = spark.createDataFrame([("xs", 300)], "table_name string, bytes bigint")
    totals = table_totals(stats, sizes)
    assert totals.first().bytes_per_record == 100.0
    run = run_report(spark.createDataFrame([(2.0, 10.0, 90.0, 0)], "generation_rate double, processing_rate double, quality_score double, errors bigint"))
    assert json.loads(run_report_json(run, stats, totals, "now"))["run"]["overall_score"] == pytest.approx(25 + 36 + 20 + 0.15 * 39.6)


def test_command_line(spark, tmp_path, capsys):
    from jsonloom.__main__ import main

    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    school_files(source, range(2))
    load = ["ingest", "--input-dir", str(source), "--store", store, "--checkpoint", str(tmp_path / "check")]
    assert main([*load, "--schema-samples", "0", "--docs-dir", str(tmp_path / "docs"), "--buckets", "2"]) == 0
    assert (tmp_path / "docs" / "DATA_STRUCTURE_README.md").exists()
    assert main(["validate", "--store", store, "--report-dir", str(tmp_path / "report")]) == 1
    assert "Found 2 classes over capacity" in (tmp_path / "report" / "QUALITY_REPORT.md").read_text()
    assert main(["arrival", "--input-dir", str(source), "--compare-dir", str(source)]) == 0
    assert "| duplicate_ids |" in capsys.readouterr().out
    assert main(["files", "--input-dir", str(source), "--expected", "4"]) == 0
    # a run without new files and its recount publish a batch; files that come later are still merged
    assert main(load) == 0
    school_files(source, [5])
    assert main(load) == 0
    assert TableStore(spark, store).read("classes").count() == 3


def test_one_sided_ranges(spark):
    contract = Contract("t", "k", (Field("k"), Field("a", "int", high=5), Field("b", "int", low=100)))
    rows = spark.createDataFrame([('{"k":"x","a":99,"b":1}',), ('{"k":"y","a":5,"b":100}',)], "record string")
    assert [r.violations for r in check_records(rows, contract).orderBy("k").collect()] == [["t.a: outside ..5", "t.b: outside 100.."], []]


def test_two_open_batches_do_not_overwrite(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    row = lambda v: spark.createDataFrame([("k", 1, v)], "k_id string, at int, v string")
    first, second = store.batch(), store.batch()
    assert first.id == second.id
    first.upsert("t", row("first"), ["k_id"], ["at"])
    second.upsert("t", row("second"), ["k_id"], ["at"])
    first.commit()
    with pytest.raises(BatchConflict):
        second.commit()
    assert [r.v for r in store.read("t").collect()] == ["first"]
    with store.batch() as again:
        again.upsert("t", row("second"), ["k_id"], ["at"])
    assert [r.v for r in store.read("t").collect()] == ["second"]


def test_every_document_is_counted(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    path = folder(rows={"t": [{"t_id": 1}]}, scalar={"n": 5}, empty={"t": []}, bad="{")
    ingest_documents(store, read_documents(spark, path))
    row = store.read(METRICS).first()
    assert (row.processed, row.failed, row.skipped) == (3, 1, 0)


def test_a_contract_reads_each_value_once(spark):
    """Ranges, rules and the row itself share one reading of a record's fields."""
    from jsonloom.operators import contracts as C

    docs = spark.createDataFrame([(1, "a", 0, 0, json.dumps({"students": [STUDENT]}))], "file_order bigint, path string, block_start bigint, line_id bigint, text string")
    contract = next(c for c in school.CONTRACTS if c.table == "students")
    read = docs.select(F.from_json("text", contract.raw_schema).alias("raw")).select(C.typed_record(contract, F.col("raw")).alias("row"))
    spark.conf.set("spark.sql.debug.maxToStringFields", 100_000)
    try:
        plans = [df._jdf.queryExecution().analyzed().toString() for df in (read, C.check_documents(docs, [contract], "record"))]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    calls = [plan.count("try_variant_get(") for plan in plans]
    assert calls[0] == calls[1] > 0, calls
