"""Large files: the same rows by byte ranges as in one piece."""

import json
import os
import random
import time

import pytest

from jsonloom.operators.large import Lexed, read_chunks, shred_files, shred_large
from jsonloom.operators.shred import DOCUMENT, QUARANTINE, shred
from jsonloom.plans.ingest import REJECTS, ingest_files
from jsonloom.session import shared_dir
from jsonloom.sources.documents import read_documents
from jsonloom.sources.store import TableStore
from jsonloom.workload import changes

FIXED = [
    "{}", ' {"data" : {}} ', "[1,2]", "{", " ", '{"a":1,,"b":2}', '{"t":[1,,2]}', '{"t":[1,]}', '{"a":1,5}', '{"t":["a":1,"b":2]}', '{"t":[1}',
    '{"t":{"a":1]}', '{"data":{"t":[{"a":1}]},"data":[2]}', '{"data":[2],"data":{"t":[{"a":1}]}}', '{"data":{"t":[1]},"data":"{\\"t\\":[1]}"}',
    '﻿{"t":[1]}', '{"t":[{"a":1},{"a":2}]},', '{"t":[1]} x', '{"data":"{\\"x\\": 1}","t":[{"a":1}]}', "{'t':[1]}", '{"t":[NaN]}', '{"t":[{"a":1}]}{',
    "{}],[{}", '{"a":{"b":1},"c":{"d":[1,2]}}', '{"d\\u0061ta":{"t":[{"a":"x,y"},"{z",[1,2],null]},"m":[{"n":1}]}',
    '{"t":[{"a":1}],"s":"]","t":[{"b":2,"b":3},7,"{\\"q\\":1}"]}', '{"t,\\"u":["a,b",1.50,null,true,{"k":[1,2]},"[x"],"o":{"p":"q,r"}}',
    '{"t":[ ] , "u":[ "" ],"v":[[],[1,[2,{"w":3}]]]}', '{"t":["\\\\","\\",{\\"",{"a":"\\\\\\""}]}', '{"a":"x\\,y"}', '{"a":[tru]}', '{"a":"\t"}',
]


def value(draw, depth):
    kind = draw.random()
    if kind < 0.35:
        return draw.choice(["x", "a,b", 'q"u,o"te', "back\\sl,ash\\", "{no", "[no,", "}],", "é,𝕏\n", '","', "", 1, -2.5, True, None, 10**20])
    if depth < 4:
        if kind < 0.7:
            return {draw.choice(["a", "b,c", 'd"e', "data", "x_id"]) + str(draw.randrange(3)): value(draw, depth + 1) for _ in range(draw.randrange(4))}
        return [value(draw, depth + 1) for _ in range(draw.randrange(5))]
    return 0


def document(draw):
    kinds = [lambda: [{"a": value(draw, 2)} for _ in range(draw.randrange(6))], lambda: [value(draw, 2) for _ in range(draw.randrange(5))],
             lambda: {"x": value(draw, 2)}, lambda: value(draw, 1)]
    tables = {draw.choice(["students", "t,1", 'k"q', "data", "metadata", "m\\"]): draw.choice(kinds)() for _ in range(draw.randrange(5))}
    if draw.random() < 0.5:
        tables = {"metadata": value(draw, 1), "data": tables, "tail": value(draw, 1)}
    text = json.dumps(tables, indent=draw.choice([None, 2]), separators=draw.choice([(",", ":"), (" , ", " : "), None]), ensure_ascii=draw.random() < 0.5)
    if draw.random() < 0.3:
        i = draw.randrange(len(text))
        text = draw.choice([text[:i], text[:i] + text[i + 1 :], text[:i] + draw.choice(',"{}[]:\\1x') + text[i:]]) or " "
    return text


def rows(df):
    return sorted(((r.path, r.table, r.table_pos, r.rec_pos, r.record, r.reason) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, chunk", [(1, 1), (3, 60)])
def test_ranges_give_the_same_rows(spark, tmp_path, seed, chunk):
    draw = random.Random(seed)
    texts = FIXED + [document(draw) for _ in range(40)]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i:03d}.json").write_text(text)
    settings = {"keep_rejects": True, "mark_documents": True}
    expected = rows(shred(read_documents(spark, str(tmp_path)), **settings))
    assert rows(shred_large(spark, [str(tmp_path)], chunk=chunk, **settings)) == expected
    assert sum(r[1] == DOCUMENT for r in expected) == len(texts) and any(r[1] == QUARANTINE for r in expected)


def test_options(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"t": [{"a": i} for i in range(9)] + [5], "u": [1, 2, 3]}))
    for settings in ({}, {"max_records": 2}, {"keep_rejects": True}):
        small, large = (f.drop("path", "file_order") for f in (shred(read_documents(spark, str(tmp_path)), **settings), shred_large(spark, [str(tmp_path)], chunk=8, **settings)))
        assert small.columns == large.columns and sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)
    placed = shred_files(spark, str(tmp_path), large=10).select("file_order").distinct().collect()
    assert placed == shred(read_documents(spark, str(tmp_path))).select("file_order").distinct().collect()


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    records = [{"a_id": i, "text": f"value, number {i}"} for i in range(60_000)]
    (tmp_path / "big.json").write_text(json.dumps({"metadata": {"n": 1}, "data": {"t": records, "p": [1, "a"], "o": {"k": 1}}}))
    (tmp_path / "small.json").write_text('{"t": [{"a_id": -1}]}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 400_000)
    try:
        chunks = read_chunks(spark, [str(tmp_path / "big.json")], 100_000)
        assert chunks.select("block_start").distinct().count() > 4 and chunks.selectExpr("max(length(text))").first()[0] < 120_000
        got = shred_files(spark, str(tmp_path), large=100_000)
        counts = {(r.path[-8:], r.table): r["count"] for r in got.groupBy("path", "table").count().collect()}
        assert counts == {("big.json", "t"): 60_000, ("big.json", "p"): 2, ("big.json", "o"): 1, ("all.json", "t"): 1}
        big = got.where("path like '%big.json' and table = 't'").orderBy("rec_pos").collect()
        assert [json.loads(r.record) for r in big] == records and [r.rec_pos for r in big] == list(range(60_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_files_are_not_opened_by_the_small_way(spark, tmp_path):
    (tmp_path / "big.json").write_text("{" + " " * 1000)
    (tmp_path / "small.json").write_text("{}")
    scan = read_documents(spark, str(tmp_path), max_bytes=100)
    assert [r.path[-10:] for r in scan.select("path").collect()] == ["small.json"]


def test_ingest_of_large_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"t": [{"t_id": i} for i in range(500)]}))
    (tmp_path / "b.json").write_text('{"t": [{"t_id": 1}, ' + " " * 2000)
    store = TableStore(spark, str(tmp_path / "store"), 2)
    assert ingest_files(store, str(tmp_path), large=1000)
    assert store.read("t").count() == 500 and store.read(REJECTS).count() == 1


@pytest.mark.parametrize("pad", [0, 40_000_000])
def test_a_string_that_looks_like_an_envelope(spark, tmp_path, pad):
    (tmp_path / "a.json").write_text('{"data": "{\\"x\\": 1}", "t": [{"a": 1}, {"a": 2}], "pad": "%s"}' % ("x" * pad))
    rows = shred(read_documents(spark, str(tmp_path)), keep_rejects=True).collect()
    assert sorted((r.table, r.record, r.reason) for r in rows) == [("t", '{"a":1}', None), ("t", '{"a":2}', None)]


def test_structure_of_a_chunk():
    lexed = Lexed(b'a\\",{" : [1,2],', quoted=1, depth=3)
    assert lexed.end_depth == 4 - 1 and lexed.parity == 1
    assert [chr(k) for k in lexed.kind if chr(k) in ",[]"] == ["[", ",", "]", ","]


def test_rows_per_comma_carry_no_path(spark, tmp_path):
    """Of a file's name, size and order a comma's row has an id only; files of equal texts stay apart."""
    from jsonloom.operators import large

    assert not {"path", "file_order", "file_size"} & set(large._CHUNK_SCHEMA.names)
    text = json.dumps({"a": [{"x": i} for i in range(300)]})
    for name in ("one", "two"):
        (tmp_path / f"{name}.json").write_text(text)
    paths = [str(tmp_path / f"{name}.json") for name in ("one", "two")]
    chunks = read_chunks(spark, paths, 500).collect()
    for path in paths:
        own = sorted((r.block_start, r.k, bytes(r.text)) for r in chunks if r.path.endswith(path))
        assert len(own) > 3 and b",".join(t for *_, t in own).decode() == text
    assert {r.file_size for r in chunks} == {len(text)}


def test_text_is_copied_once_and_does_not_move(spark, tmp_path):
    """Beside the file there is disk for one compressed copy of its text; rows come from that copy without a shuffle."""
    draw = random.Random(5)
    records = [{"a": i, "text": draw.randbytes(150).hex()} for i in range(10_000)]
    (tmp_path / "a.json").write_text(json.dumps({"data": {"t": records, "o": {"k": 1}}}))
    top = shared_dir(spark).removeprefix("file:")

    def stored():
        return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(top) for name in names)

    before = stored()
    got = shred_large(spark, [str(tmp_path)], chunk=100_000)
    assert got.count() == 10_001
    assert 0 < stored() - before < (tmp_path / "a.json").stat().st_size
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_document_of_many_ranges(spark, tmp_path, monkeypatch):
    """The document's writer takes ranges of the order one after the other; what was dealt out to it does not stay on disk."""
    monkeypatch.setattr(changes, "DOCUMENT_RANGE", 100, raising=False)
    order = [(key, line) for key in range(400) for line in range(1, 4)]
    draw = random.Random(6)
    rows = [(key, line, key * 7, 1.5, 10.25, 0.0, "R") for key, line in draw.sample(order, len(order))]
    spark.createDataFrame(rows, changes.LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        listed = files.getAllFiles()
        return {listed.apply(i).getName() for i in range(listed.size()) if listed.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    path = changes.one_document(spark, str(tmp_path)).removeprefix("file:")
    parts = [name for name in os.listdir(path) if name.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(path, parts[0])) as file:
        items = json.load(file)["data"]["items"]
    assert [(r["l_orderkey"], r["l_linenumber"]) for r in items] == order
    waited = time.time() + 5
    while shuffled() - before and time.time() < waited:
        time.sleep(0.2)
    assert not shuffled() - before
    got = changes.shred_large_document(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(rows)
