"""Arrival analysis, rates and progress on streams; sketches and frequent values."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jsonloom.operators.arrival import arrival_issues
from jsonloom.operators.large import shred_files
from jsonloom.operators.profile import column_profile
from jsonloom.operators.quality import distribution
from jsonloom.operators.quality.distribution import frequent_values, top_values, variation
from jsonloom.operators.shred import shred
from jsonloom.operators.sketches import column_sketches, merge_sketches, sketched_profile, sketched_variation
from jsonloom.plans.school import ARRIVAL
from jsonloom.sources.documents import read_documents, stream_files
from jsonloom.sources.store import TableStore
from jsonloom.streaming.arrival import arrival_state_issues, compact_arrivals, start_arrival, update_arrivals
from jsonloom.streaming.progress import PROGRESS, ProgressLog, progress_summary
from jsonloom.streaming.rates import arrival_rates, start_rates


def registry_document(draw):
    pick = lambda letter, n: draw.choice([f"{letter}{draw.randrange(n)}", f"{letter}0", None])
    return {
        "teachers": [{"teacher_id": pick("T", 4)} for _ in range(draw.randrange(3))],
        "students": [{"student_id": pick("S", 6)} for _ in range(draw.randrange(4))],
        "classes": [{"class_id": pick("C", 3), "teacher_id": pick("T", 4), "max_capacity": draw.choice([0, 1, 2, None])} for _ in range(draw.randrange(3))],
        "student_classes": [{"student_class_id": f"E{draw.randrange(99)}", "student_id": pick("S", 6), "class_id": pick("C", 3)} for _ in range(draw.randrange(5))],
    }


def write_registry(folder, seed, n=9):
    draw = random.Random(seed)
    paths = []
    for i in range(n):
        path = folder / f"school_data_20250101_{i:06d}_000000.json"
        path.write_text("{" if i == 4 else json.dumps(registry_document(draw)))
        paths.append(str(path))
    return paths


def issues_of(df):
    found = [(r.issue, r.kind, r.id, r.missing, r.file.rsplit("/", 1)[1], tuple(sorted(r.details.items()))) for r in df.collect()]
    return sorted(found, key=repr)


@pytest.mark.parametrize("seed", [2, 3])
def test_any_cut_into_batches_gives_the_batch_analysis(spark, tmp_path, seed):
    """Documents come in batches of any size, not in order of their names: parents, resets and repeats also come late."""
    paths = write_registry(tmp_path, seed)
    draw = random.Random(seed + 100)
    draw.shuffle(paths)
    store, seen = TableStore(spark, str(tmp_path / "store"), 3), []
    while len(seen) < len(paths):
        some = paths[len(seen) : len(seen) + draw.randrange(2, 5)]
        seen += some
        assert update_arrivals(store, shred(read_documents(spark, some), keep_rejects=True), ARRIVAL, ("s", len(seen)))
        assert not update_arrivals(store, shred(read_documents(spark, some), keep_rejects=True), ARRIVAL, ("s", len(seen)))
        if len(seen) == len(paths):
            compact_arrivals(store, ARRIVAL)
        whole = arrival_issues(shred(read_documents(spark, seen), keep_rejects=True), ARRIVAL)
        assert issues_of(arrival_state_issues(store, ARRIVAL)) == issues_of(whole)


def test_arrival_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_registry(tmp_path / "in", 7)
    store = TableStore(spark, str(tmp_path / "store"), 3)
    start_arrival(spark, str(tmp_path / "in"), store, str(tmp_path / "check"), ARRIVAL, "s", max_files=5).awaitTermination()
    assert len(store.batches()) == 2
    whole = arrival_issues(shred_files(spark, str(tmp_path / "in"), keep_rejects=True), ARRIVAL)
    assert issues_of(arrival_state_issues(store, ARRIVAL)) == issues_of(whole)


def stamped(folder, seconds):
    for s in seconds:
        at = datetime(2025, 1, 1) + timedelta(seconds=s)
        (folder / f"data_{at:%Y%m%d_%H%M%S}_000000.json").write_text("{}")


def test_rates_drop_what_comes_too_late(spark, tmp_path):
    source, sink, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    windows = lambda: {
        r.window_start.second + 60 * r.window_start.minute: (r.files, r.files_per_second, r.bytes) for r in spark.read.parquet(sink).collect()
    }
    run = lambda: start_rates(spark, str(source), sink, check, "10 seconds", "20 seconds").awaitTermination()
    stamped(source, [0, 3, 12, 31])
    run()
    assert windows() == {0: (2, 0.2, 4)}  # the newest file is at 31: what ends by 11 is closed
    stamped(source, [5, 14, 45])  # 5 is too late, 14 is late but its window is open
    run()
    assert windows() == {0: (2, 0.2, 4), 10: (2, 0.2, 4)}
    stamped(source, [90])
    run()
    assert windows() == {0: (2, 0.2, 4), 10: (2, 0.2, 4), 30: (1, 0.1, 2), 40: (1, 0.1, 2)}


def test_sliding_rates(spark, tmp_path):
    stamped(tmp_path, [0, 6, 11])
    rates = arrival_rates(stream_files(spark, str(tmp_path)), "10 seconds", "1 second", "5 seconds")
    out = rates.writeStream.format("memory").queryName("sliding").outputMode("complete").trigger(availableNow=True).start()
    out.awaitTermination()
    got = {(r.window_start - datetime(2025, 1, 1)).total_seconds(): r.files for r in spark.table("sliding").collect()}
    assert got == {-5.0: 1, 0.0: 2, 5.0: 2, 10.0: 1}


def test_progress_and_errors_are_kept(spark, tmp_path):
    stamped(tmp_path, range(3))
    store, log = TableStore(spark, str(tmp_path / "store"), 2), ProgressLog()
    spark.streams.addListener(log)
    try:
        good = stream_files(spark, str(tmp_path)).writeStream.foreachBatch(lambda df, i: df.count()).trigger(availableNow=True).start()
        good.awaitTermination()
        bad = stream_files(spark, str(tmp_path)).writeStream.foreachBatch(lambda df, i: 1 / 0).trigger(availableNow=True).start()
        with pytest.raises(Exception, match="division by zero"):
            bad.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    assert log.save(store) > 3 and log.save(store) == 0
    found = {r["query"]: r for r in progress_summary(store.read(PROGRESS)).collect()}
    assert (found[str(good.id)].batches, found[str(good.id)].input_rows, found[str(good.id)].last_error) == (1, 3, None)
    assert found[str(bad.id)].last_error


def sketch_rows(spark, n=5000):
    return spark.range(n).selectExpr(
        "id as many", "id % 7 as few", "cast(null as bigint) as none", "cast(id % 2000 as double) / 3 as real",
        "if(id % 5 = 0, null, concat('t', id % 300)) as word", "array(id % 11) as list", "cast(id % 13 as decimal(9,2)) as price",
        "if(id % 2 = 0, 0D, -0D) as zero", "true as yes",
    )


def test_sketches_estimate_and_merge(spark):
    df = sketch_rows(spark)
    whole = {r.field: r for r in sketched_profile(column_sketches(df, "t")).collect()}
    halves = column_sketches(df.where("many < 2500"), "t").unionByName(column_sketches(df.where("many >= 2000"), "t"))
    merged = {r.field: r for r in sketched_profile(merge_sketches(halves)).collect()}
    for row in column_profile(df, "t").collect():
        near = whole[row.field]
        assert (near.record_count, near.null_count, near["table"]) == (row.record_count, row.null_count, "t")
        assert abs(near.unique_values - row.unique_values) <= 0.04 * row.unique_values
        assert abs(merged[row.field].unique_values - row.unique_values) <= 0.04 * row.unique_values and merged[row.field].record_count == 5500
    assert column_profile(df, "t", approximate=True).columns == column_profile(df, "t").columns
    assert whole["word"].max_length == 4


def test_approximate_variation(spark):
    df, columns = sketch_rows(spark), ["many", "few", "none", "real", "zero"]
    exact = {r.field: r for r in variation(df, columns, "t").collect()}
    near = {r.field: r for r in variation(df, columns, "t", approximate=True).collect()}
    assert exact.keys() == near.keys() == {"many", "few", "real", "zero"}
    for field, row in exact.items():
        assert near[field].total_values == row.total_values and abs(near[field].unique_values - row.unique_values) <= 0.04 * row.unique_values
    assert near["zero"].unique_values == 1 and near["zero"].a_value == exact["zero"].a_value
    assert sketched_variation(column_sketches(df, "t", [])).count() == 0


@pytest.mark.parametrize("candidates, classes", [(64, 1024), (4, 8), (3, 1)])
def test_frequent_values(spark, monkeypatch, candidates, classes):
    monkeypatch.setattr(distribution, "CANDIDATES", candidates)
    monkeypatch.setattr(distribution, "CLASSES", classes)
    draw = random.Random(4)
    rows = [(draw.choice([1, 1, 1, 2, 2, 3, None, *range(9)]), draw.randrange(400), draw.choice(["x", "y", "x", "z" + str(draw.randrange(90))]), draw.choice([0.5, -0.0, 0.0])) for _ in range(900)]
    df = spark.createDataFrame(rows, "a bigint, b int, c string, d double").repartition(4)
    columns = ["a", "b", "c", "d"]
    want = sorted((tuple(r) for r in top_values(df, columns, 3).collect()), key=repr)
    assert sorted((tuple(r) for r in frequent_values(df, columns, 3).collect()), key=repr) == want
    other = sketch_rows(spark, 600)
    columns = ["few", "word", "list", "price", "yes", "none"]
    want = sorted((tuple(r) for r in top_values(other, columns, 2).collect()), key=repr)
    assert sorted((tuple(r) for r in frequent_values(other, columns, 2).collect()), key=repr) == want


def test_frequent_values_count_few_values_one_by_one(spark, monkeypatch):
    """Where a few values hold most rows, no other class of values is opened."""
    df = spark.range(40_000).selectExpr("if(id % 3 < 2, id % 4, id) as v")
    asked = []
    real = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, schema=None, **k: asked.append(schema) or real(data, schema, **k))
    top = frequent_values(df, ["v"], 3)
    assert "g int, class bigint" not in asked
    assert top.collect() == top_values(df, ["v"], 3).collect()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "a bigint, b string")
    assert frequent_values(empty, ["a", "b"]).count() == 0 and frequent_values(empty, []).columns == top_values(empty, ["a"]).columns
    assert sorted(tuple(r) for r in sketched_profile(column_sketches(empty, "t")).collect()) == [("a", 0, 0, None, 0, "t"), ("b", 0, 0, None, 0, "t")]


def test_values_keep_their_kind(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "v bigint")
    row = frequent_values(df, ["v"], 1).first()
    assert (row.field, row.long_value, row.double_value, row.text_value, row.n) == ("v", 1, None, None, 2)
    assert df.agg(F.count("v")).first()[0] == 3


def test_listing_takes_fewer_tasks_than_paths(spark, tmp_path):
    """A task per path would send the driver a result per path."""
    from jsonloom.sources import documents

    for i in range(100):
        (tmp_path / f"{i}.json").write_text('{"t": [{"a": 1}]}')
    paths = [str(tmp_path / f"{i}.json") for i in range(100)]
    context = spark.sparkContext
    for n, read in enumerate((documents.read_documents, documents.list_files)):
        context.setJobGroup(f"listing-{n}", "listing")
        found = read(spark, paths, glob="*")
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(f"listing-{n}") for s in tracker.getJobInfo(j).stageIds]
        assert stages and all(tracker.getStageInfo(s).numTasks < 50 for s in stages)
        context.setJobGroup("rest", "rest")
        assert found.count() == 100
