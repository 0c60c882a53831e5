import json

import pytest

from jsonloom.operators import profile
from jsonloom.operators.keys import er_edges, field_descriptions
from jsonloom.operators.metrics import complexity
from jsonloom.operators.shred import shred
from jsonloom.plans.catalog import Catalog, completeness, described_fields, discover
from jsonloom.plans.ingest import ingest_documents
from jsonloom.session import cut_lineage
from jsonloom.sources import tables as sidecars
from jsonloom.sources.documents import read_documents
from jsonloom.sources.reports import schema_documents, schema_markdown, write_text
from jsonloom.sources.store import TableStore

SCHOOL = {
    "students": [{"student_id": "S1", "name": "a", "gpa": 3.5}],
    "teachers": [{"teacher_id": "T1", "qualifications": ["x", "y"]}],
    "classes": [{"class_id": "C1", "teacher_id": "T1", "max_capacity": 3}],
    "student_classes": [{"student_class_id": "SC1", "student_id": "S1", "class_id": "C1", "grade": None}],
}

# values of one field -> (reference type, default type)
TYPES = {
    "whole": ([1, 2], "bigint", "bigint"),
    "mixed_numbers": ([1, 2.5], "double", "double"),
    "real": ([3.0], "double", "double"),
    "int_text": ([1, "a"], "bigint", "string"),
    "float_text": ([2.5, "a"], "double", "string"),
    "bool_text": ([True, "a"], "boolean", "string"),
    "bool_int": ([True, 1], "bigint", "string"),
    "nulls": ([None], "string", "string"),
    "nested": ([{"k": 1}], "string", "string"),
    "list_numbers": ([[1, 2.5]], "array<bigint>", "array<double>"),
    "list_mixed": ([["a", 1]], "array<string>", "array<string>"),
    "list_empty": ([[]], "array<string>", "array<string>"),
}


@pytest.fixture(scope="module")
def types(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("types")
    document = {name: [{"v": v} for v in values] for name, (values, _, _) in TYPES.items()}
    (path / "a.json").write_text(json.dumps(document))
    return discover(shred(read_documents(spark, str(path))))


@pytest.mark.parametrize("mode, column", [("reference", 1), ("default", 2)])
def test_type_resolution(types, mode, column):
    catalog = Catalog(types.table_facts, types.field_facts, mode)
    got = {r.table: r.data_type for r in catalog.profile.collect()}
    assert got == {name: case[column] for name, case in TYPES.items()}


def test_profile_facts(spark, folder):
    document = {"t": [{"b": "xy", "a": 1}, {"b": None, "a": 2.5, "c": ["p", 1, None]}, {"b": "z"}]}
    rows = discover(shred(read_documents(spark, folder(doc=document)))).profile.orderBy("field_order").collect()
    b, a, c = rows
    assert [r.field for r in rows] == ["b", "a", "c"]
    assert (b.data_types, b.nullable, b.max_length, b.samples, b.null_count, b.missing_count) == (["str"], True, 2, ["xy", "z"], 1, 0)
    assert (a.data_types, a.nullable, a.missing_count, a.samples) == (["int", "float"], False, 1, ["1", "2.5"])
    assert (c.is_list, c.list_element_types, c.data_types, c.record_count) == (True, ["str", "int"], [], 3)


def test_first_ten_samples(spark, folder):
    document = {"t": [{"n": i if i % 2 else None} for i in range(60)]}
    row = discover(shred(read_documents(spark, folder(doc=document)))).profile.first()
    assert row.samples == [str(i) for i in range(1, 20, 2)]


def keys_of(spark, folder, document, **settings):
    catalog = discover(shred(read_documents(spark, folder(doc=document))), **settings)
    primary = {r.table: r.primary_key for r in catalog.primary_keys.collect()}
    foreign = {(r.from_table, r.foreign_key): r.to_table for r in catalog.foreign_keys.collect()}
    return primary, foreign


def test_school_keys(spark, folder):
    primary, foreign = keys_of(spark, folder, SCHOOL)
    assert primary == {"students": "student_id", "teachers": "teacher_id", "classes": "class_id", "student_classes": "student_class_id"}
    assert foreign == {("classes", "teacher_id"): "teachers", ("student_classes", "student_id"): "students"}


def test_extended_plurals_reach_classes(spark, folder):
    _, foreign = keys_of(spark, folder, SCHOOL, plurals="extended")
    assert foreign[("student_classes", "class_id")] == "classes"


def test_table_name_key_is_preferred(spark, folder):
    primary, foreign = keys_of(spark, folder, {"item": [{"owner_id": 1, "item_id": 2}]})
    assert primary == {"item": "item_id"} and foreign == {}
    _, foreign = keys_of(spark, folder, {"item": [{"owner_id": 1, "item_id": 2}], "owner": [{"x": 1}]})
    assert foreign == {("item", "owner_id"): "owner"}


def test_field_with_null_is_no_key(spark, folder):
    primary, foreign = keys_of(spark, folder, {"t": [{"a_id": None, "b_id": 1}], "as": [{"x": 1}]})
    assert primary == {"t": "b_id"} and foreign == {("t", "a_id"): "as"}


def test_merge_of_runs(spark, folder, tmp_path):
    path = folder(a={"t": [{"x_id": 1, "v": 1}]}, b={"t": [{"x_id": None, "v": "s"}], "u": [{"w": True}]})
    one = discover(shred(read_documents(spark, f"{path}/a.json")))
    two = discover(shred(read_documents(spark, f"{path}/b.json")), known=one)
    merged, whole = one.merge(two), discover(shred(read_documents(spark, path)))
    columns = ["table", "field", "data_type", "nullable", "record_count", "samples"]
    assert sorted(merged.profile.select(columns).collect()) == sorted(whole.profile.select(columns).collect())
    assert merged.keys() == whole.keys() == {}


def test_documents_and_sidecars(spark, folder, tmp_path):
    catalog = discover(shred(read_documents(spark, folder(doc=SCHOOL))))
    schema, graph = schema_documents(catalog, "2025-01-01T00:00:00")
    out = str(tmp_path / "docs")
    write_text(spark, f"{out}/schema_documentation.json", schema)
    write_text(spark, f"{out}/table_relationships.json", graph)
    tables = sidecars.read_schema_sidecar(spark, f"{out}/schema_documentation.json")
    read = sidecars.sidecar_relationships(spark, tables, f"{out}/table_relationships.json")
    rebuilt = sidecars.sidecar_relationships(spark, tables)
    assert sorted(read.collect()) == sorted(rebuilt.select(read.columns).collect())
    assert len(sidecars.references_of(read)) == 2
    assert sidecars.sidecar_fields(tables).where("field = 'gpa'").first().data_types == ["float"]
    text = schema_markdown(catalog, "now")
    assert '    TEACHERS ||--o{ CLASSES : "teacher_id"' in text and "List[str]" in text


def test_descriptions_edges_scores(spark, folder):
    catalog = discover(shred(read_documents(spark, folder(doc=SCHOOL))))
    described = {(r.table, r.field): r.description for r in described_fields(catalog).collect()}
    assert described[("classes", "teacher_id")] == "References teachers"
    assert described[("classes", "class_id")] == "Identifier field"
    assert described[("classes", "max_capacity")] == "Capacity/Count"
    assert described[("students", "gpa")] == "Grade Point Average"
    basic = field_descriptions(catalog.profile, catalog.foreign_keys).where("field = 'gpa'").first()
    assert basic.description == ""
    assert er_edges(catalog.relationships).count() == 2
    row = completeness(catalog).first()
    assert (row.tables, row.tables_with_key, row.completeness_pct, row.score) == (4, 4, 100.0, 100.0)
    row = complexity(catalog.summary).first()
    assert (row.tables, row.fields, row.foreign_keys, row.complexity) == (4, 12, 2, 40 + 24 + 10)


def test_order_of_many_fields_and_late_samples(spark, folder):
    wide = {f"f{i:04d}": i for i in range(1050)} | {"zz_id": 1, "aa_id": 2}
    late = [{"x": None} for _ in range(150)] + [{"x": "late"}]
    found = discover(shred(read_documents(spark, folder(doc={"wide": [wide], "late": late}))))
    order = {r.field: r.field_order for r in found.profile.where("table = 'wide'").collect()}
    assert (order["zz_id"], order["aa_id"]) == (1051, 1052)
    assert found.keys()["wide"] == "zz_id"
    assert found.profile.where("field = 'x'").first().samples == ["late"]


def test_fields_of_stored_records_carry_no_paths(spark, folder, tmp_path_factory, monkeypatch):
    """Beside each of a record's fields its file's path would be copied and compared: hashes of the block stand for it."""
    path = folder(a={"t": [{"x": 1, "y": "é"}, {}], "u": [{"z": [1, "2"]}]}, b={"t": [{"x": None}, 5]}, c='{"t": [{"x": "a", "w": 1, "x": "abc"}]}')
    plans = []

    def kept(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return cut_lineage(rows)

    monkeypatch.setattr(profile, "cut_lineage", kept)
    ingest_documents(TableStore(spark, str(tmp_path_factory.mktemp("store")), buckets=2), read_documents(spark, path))
    over_fields = [line for plan in plans for line in plan.splitlines() if "Aggregate [" in line and "bit_or(" in line]
    assert over_fields and not any("path#" in line for line in over_fields)

    records = cut_lineage(shred(read_documents(spark, path)))
    columns = sorted(profile.chunk_facts(records).columns)
    by_path, by_hash = [sorted(map(str, profile.chunk_facts(records, stored).select(columns).collect())) for stored in (False, True)]
    assert by_path == by_hash and len(by_path) == 7
