import json

import pytest
from pyspark.sql import types as T

from jsonloom.operators.shred import DOCUMENT, QUARANTINE, shred, typed_records
from jsonloom.sources.documents import (
    list_files, name_timestamp, quarantine, read_documents, sample_documents,
)


def tables_of(spark, path, **settings):
    rows = shred(read_documents(spark, path), **settings).orderBy("path", "table_pos", "rec_pos").collect()
    out = {}
    for r in rows:
        out.setdefault(r.table, []).append(json.loads(r.record))
    return out


@pytest.mark.parametrize(
    "document, expected",
    [
        ({"students": [{"a": 1}], "teachers": [{"b": 2}, {"b": 3}]}, {"students": [{"a": 1}], "teachers": [{"b": 2}, {"b": 3}]}),
        ({"metadata": {"v": 1}, "data": {"students": [{"a": 1}]}}, {"students": [{"a": 1}]}),
        (
            {"tags": ["x", 2, 3.0, None, {"k": 1}]},
            {"tags": [{"value": v, "index": i} for i, v in enumerate(["x", 2, 3.0, None, {"k": 1}])]},
        ),
        ({"config": {"a_id": 1}}, {"config": [{"a_id": 1}]}),
        ({"eo": {}}, {"eo": [{}]}),
        ({"n": 5, "s": "x", "e": [], "z": None, "looks": "[1]", "like": '{"a":1}'}, {}),
        ({"data": [{"a_id": 1}], "metadata": {"v": 1}}, {"data": [{"a_id": 1}], "metadata": [{"v": 1}]}),
    ],
)
def test_shapes(spark, folder, document, expected):
    assert tables_of(spark, folder(doc=document)) == expected


def test_number_kinds_survive(spark, folder):
    rows = shred(read_documents(spark, folder(doc='{"tags": [3.0, 3, "3"]}'))).orderBy("rec_pos").collect()
    assert [r.record for r in rows] == [
        '{"value":3.0,"index":0}', '{"value":3,"index":1}', '{"value":"3","index":2}',
    ]


def test_key_order_is_kept(spark, folder):
    record = shred(read_documents(spark, folder(doc='{"z": [{"b": 1, "a": 2}], "a": [{"q": 1}]}'))).orderBy("table_pos").collect()
    assert [r.table for r in record] == ["z", "a"]
    assert record[0].record == '{"b":1,"a":2}'


BAD = {"truncated": '{"students":[{"student_id":"S1"', "listed": "[1, 2]", "tail": '{"a":[1]} x', "two": '{"a":1} {"b":2}', "nan": '{"a": NaN}'}


def test_quarantine_keeps_whole_text(spark, folder):
    path = folder(good={"t": [{"a": 1}]}, **BAD)
    rows = quarantine(read_documents(spark, path)).collect()
    assert {r.text for r in rows} == set(BAD.values())


def test_one_pass_serves_tables_and_rejects(spark, folder):
    path = folder(good={"t": [{"a": 1}, 5, "x"]}, **BAD)
    rows = shred(read_documents(spark, path), keep_rejects=True).collect()
    assert sorted(r.record for r in rows if r.table == QUARANTINE) == sorted(BAD.values())
    assert sorted(r.record for r in rows if r.table == "t" and r.reason) == ["5", "x"]
    assert [r.record for r in rows if r.table == "t" and not r.reason] == ['{"a":1}']


def test_document_larger_than_a_variant(spark, folder):
    big = {"data": {"t": [{"a_id": i, "s": "y" * 1_000_000} for i in range(20)], "p": [1, "a"], "o": {"k": 1}}}
    tables = shred(read_documents(spark, folder(big=big))).groupBy("table").count().collect()
    assert {r["table"]: r["count"] for r in tables} == {"t": 20, "p": 2, "o": 1}
    assert quarantine(read_documents(spark, folder(big=big))).count() == 0


@pytest.mark.parametrize("filler", ["", "y" * 5_000_000])
def test_last_of_repeated_keys_wins_at_every_size(spark, folder, filler):
    document = '{"t":[{"a":1}],"s":"%s","t":[{"a":1,"b":3,"a":2}, "{\\"a\\":5}"]}' % filler
    path = folder(doc=document)
    assert quarantine(read_documents(spark, path)).count() == 0
    rows = shred(read_documents(spark, path), keep_rejects=True).collect()
    assert [(r.table, json.loads(r.record), r.reason is None) for r in rows] == [("t", {"a": 2, "b": 3}, True), ("t", {"a": 5}, False)]


def test_documents_are_marked(spark, folder):
    path = folder(rows={"t": [{"a": 1}]}, none={"n": 5, "e": []}, bad="[")
    rows = shred(read_documents(spark, path), keep_rejects=True, mark_documents=True).groupBy("table").count().collect()
    assert {r["table"]: r["count"] for r in rows} == {DOCUMENT: 3, "t": 1, QUARANTINE: 1}


def test_entries_are_not_carried_beside_records(spark, folder):
    plan = shred(read_documents(spark, folder(doc={"t": [{"a": 1}]})))._jdf.queryExecution().optimizedPlan().toString()
    inner = plan[: plan.index("Generate posexplode", plan.index("Generate posexplode") + 1)]
    assert "_entry#" not in inner.split("Generate posexplode")[0] and "_entry.raw" not in inner.split("Generate posexplode")[0]


def test_sample_opens_first_files_only(spark, folder):
    path = folder(**{f"f{i}": {"t": [{"a": j} for j in range(5)]} for i in range(4)})
    rows = shred(sample_documents(spark, path, files=2), max_records=3).collect()
    assert sorted({r.path[-7:] for r in rows}) == ["f0.json", "f1.json"]
    assert len(rows) == 6


def test_unfinished_files_are_skipped(spark, folder, tmp_path):
    path = folder(a={"t": [{"a": 1}]})
    for name in ("b.json.tmp", "c.processing", ".d.json", "_e.json"):
        (tmp_path / name).write_text("{}")
    assert [r.path[-6:] for r in read_documents(spark, path).collect()] == ["a.json"]
    assert list_files(spark, path, "*.json").count() == 1


def test_lines_are_ordered(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(json.dumps({"t": [{"n": i}]}) for i in range(50)) + "\n\n")
    docs = read_documents(spark, str(tmp_path), lines=True)
    rows = shred(docs).orderBy("path", "block_start", "line_id").collect()
    assert [json.loads(r.record)["n"] for r in rows] == list(range(50))


def test_typed_records_name_lost_values(spark):
    rows = spark.createDataFrame(
        [('{"a": 1, "b": "x", "c": [1, 2]}',), ('{"a": "no", "b": {"k": 1}}',), ('{"a": 2.0}',), ('{"a": 2.5}',)], "record string"
    )
    schema = T.StructType.fromDDL("a bigint, b string, c array<bigint>")
    got = [(r.a, r.b, r.c, r.lost_fields) for r in typed_records(rows, schema).collect()]
    assert got == [(1, "x", [1, 2], []), (None, '{"k":1}', None, ["a"]), (2, None, None, []), (None, None, None, ["a"])]


def test_name_timestamp(spark):
    rows = spark.createDataFrame(
        [("x/school_data_20250102_030405_000006.json",), ("x/data.json",), ("x/b_20250102_030405_000006/part-0.txt",)], "p string"
    )
    got = [r.t for r in rows.select(name_timestamp(rows.p).cast("string").alias("t")).collect()]
    assert got == ["2025-01-02 03:04:05.000006", None, "2025-01-02 03:04:05.000006"]
