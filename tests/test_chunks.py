"""Discovery from facts of chunks: one pass over the records, then only the chunks that can hold first values."""

import json

import pytest
from pyspark.sql import functions as F

from jsonloom.operators import profile as P
from jsonloom.operators.shred import shred
from jsonloom.plans.catalog import discover
from jsonloom.sources.documents import read_documents


def documents():
    """Late, null and missing values, other types later on, and strings that look like lists and objects."""
    out = []
    for i in range(60):
        rows = [{"id": i * 7 + j, **({"late": f"v{i}-{j}"} if i > 40 else {}), "gap": None if i < 20 else i, "odd": [i] if j else "x"} for j in range(1 + i % 7)]
        out.append({"t": rows, "like": '[{"a": 1}]', "like2": "{\"b\": 2}", "esc": "\\u007b", "one": {"k": i} if i % 2 else {}})
    return out


@pytest.mark.parametrize("bits", [(0, 0), (1, 1), (6, 13)])
def test_facts_and_samples_from_chunks(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(P, "LINE_BITS", bits[0])
    monkeypatch.setattr(P, "RECORD_BITS", bits[1])
    docs = documents()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(json.dumps(d).replace('"esc": "\\\\u007b"', '"esc": "\\u007bx}"') for d in docs))
    records = shred(read_documents(spark, str(tmp_path / "in"), lines=True, glob="*"))
    catalog = discover(records)
    tables = {r.table: r.record_count for r in catalog.table_facts.collect()}
    rows = [r for d in docs for r in d["t"]]
    assert tables == {"t": len(rows), "one": len(docs)}
    got = {(r.table, r.field): r for r in catalog.profile.collect()}
    order = [f for _, f in sorted((r.field_order, f) for (t, f), r in got.items() if t == "t")]
    assert order == ["id", "gap", "odd", "late"]
    for field in order:
        values = [r[field] for r in rows if r.get(field) is not None]
        row = got["t", field]
        assert row.samples == [v if isinstance(v, str) else json.dumps(v).replace(" ", "") for v in values[:10]]
        assert row.present_count == sum(field in r for r in rows)
        assert row.null_count == row.present_count - len(values)
    assert got["t", "gap"].nullable and not got["t", "id"].nullable
    assert got["t", "odd"].is_list and got["t", "odd"].data_types == ["str"] and got["t", "odd"].list_element_types == ["int"]
    assert got["t", "late"].max_length == max(len(r["late"]) for r in rows if "late" in r)


def test_few_chunks_are_read_for_samples(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "LINE_BITS", 1)
    (tmp_path / "a.txt").write_text("\n".join(json.dumps({"t": [{"v": i}, {"v": -i}]}) for i in range(1000)))
    records = shred(read_documents(spark, str(tmp_path), lines=True, glob="*"))
    seen = []
    values = P._values
    monkeypatch.setattr(P, "_values", lambda rows: seen.append(rows) or values(rows))
    chunks = P.chunk_facts(records)
    samples = P.field_samples(records, chunks).first().samples
    assert [s.sample for s in samples] == ["0", "0", "1", "-1", "2", "-2", "3", "-3", "4", "-4"]
    assert [rows.count() for rows in seen][0] == 2000 and seen[1].agg(F.count(F.lit(1)).alias("n")).first().n <= 40
