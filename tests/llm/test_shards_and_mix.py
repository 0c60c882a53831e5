"""Shards by bytes and the source mix, against plain versions."""

import itertools
import random
import zlib

import pytest

from jsonloom.llm import mixing, sharding

SCHEMA = "doc_id bigint, text string, source string"


def test_shards(spark):
    draw = random.Random(4)
    rows = [(i, "é" * draw.randrange(40), "s") for i in range(300)] + [(None, "a", "s"), (None, None, "s"), (7, "twin", "s"), (7, "twin", "s"), (7, "other", "s")]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA), shards=7).collect()
    assert len(got) == len(rows)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    sizes = {}
    for k, part in itertools.groupby(order, key=lambda r: r.shard):
        part = list(part)
        assert [r.slot for r in part] == list(range(len(part)))
        sizes[k] = sum(r.size for r in part)
    target = sum(sizes.values()) / 7
    assert sorted(sizes) == list(range(7)) and all(abs(x - target) <= max(r.size for r in got) for x in sizes.values())
    keys = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in order]
    assert keys == sorted(keys)
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == want


def test_one_row_repeated_is_split(spark):
    rows = [(1, "abcdefgh", "s")] * 500
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA), shards=5).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(k, s) for k in range(5) for s in range(100)]


def test_shard_documents(spark):
    rows = [(i, f"text {i}", "s", "x", i) for i in range(50)] + [(3, "text 3", "s", "x", 3), (None, None, None, None, None)]
    given = spark.createDataFrame(rows, SCHEMA + ", crc string, row int")
    got = sharding.shard_documents(given, shards=4)
    assert got.columns == [*given.columns, "shard", "slot"]
    places = sorted((r.shard, r.slot) for r in got.collect())
    want = sorted((r.shard, r.slot) for r in sharding.shard_by_bytes(given, shards=4).collect())
    assert places == want and got.drop("shard", "slot").exceptAll(given).count() == 0


def test_no_rows_to_shard(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.shard_by_bytes(empty).count() == 0 and sharding.shard_documents(empty).count() == 0


def test_targets():
    sizes = {"a": 1000, "b": 10, "c": 500, None: 90}
    got = mixing.source_targets(sizes)
    assert list(got) == ["a", "b", "c", None]
    assert got["b"] == 30 and sum(got.values()) == pytest.approx(1600)
    assert got["c"] == pytest.approx(3 * got["a"]) or got["c"] == 1500
    assert all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    assert mixing.source_targets({"a": 0, "b": 5}) == {"a": 0.0, "b": 5.0}
    assert mixing.source_targets({}) == {}


def test_flow_is_cheapest():
    """Two sources, one pattern that feeds both: against all integer splits."""
    draw = random.Random(5)
    for _ in range(30):
        capacity, quota = [draw.randrange(1, 5) for _ in range(3)], [draw.randrange(0, 9) for _ in range(2)]
        members = [[0], [1], [0, 1]]
        got = mixing.min_cost_flow(capacity, members, quota)
        cost = lambda x, c: sum(k * min(max(x - i * c, 0), c) for i, k in enumerate(mixing.REPEAT_COSTS))
        best = None
        for a, b, c0, c1 in itertools.product(range(13), repeat=4):
            if a <= 3 * capacity[0] and b <= 3 * capacity[1] and c0 + c1 <= 3 * capacity[2] and a + c0 <= quota[0] and b + c1 <= quota[1]:
                key = (-(a + b + c0 + c1), cost(a, capacity[0]) + cost(b, capacity[1]) + cost(c0 + c1, capacity[2]))
                best = key if best is None or key < best else best
        assert (-sum(got), sum(cost(x, c) for x, c in zip(got, capacity, strict=True))) == best


def mixed(spark):
    draw = random.Random(6)
    rows = [(i, "w " * draw.randrange(1, 30), draw.choice(["a", "b", "b", "b", "c", None])) for i in range(600)]
    return rows + [(600, None, "a"), (601, "", "d"), (5, rows[5][1], rows[5][2]), (None, "x y", "c")]


def test_mix(spark):
    rows = mixed(spark)
    given = spark.createDataFrame(rows, SCHEMA)
    report = mixing.mix_report(mixing.slim(given, 9)).collect()
    assert len(report) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = mixing.source_targets(sizes)
    for source in sizes:
        mine = [r for r in report if r.source == source]
        assert {r.source_size for r in mine} == {sizes[source]} and all(r.target == pytest.approx(targets[source]) for r in mine)
        assert abs(sum(r.taken for r in mine) - targets[source]) <= 31
    assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in report)
    again = mixing.mix_report(mixing.slim(given.repartition(5), 9)).collect()
    assert sorted(report, key=str) == sorted(again, key=str)
    wide = given.selectExpr("*", "doc_id as pattern", "source as place")
    taken = mixing.mix_documents(wide)
    assert taken.columns == wide.columns
    assert taken.count() == sum(r.uses for r in report if r.size)


def test_overlapping_sources(spark):
    """Documents of both sources serve the one that lacks words, and none is taken more than three times."""
    rows = [(i, "w " * 10, "a", ["a"]) for i in range(30)] + [(100 + i, "w " * 10, "b", ["b"]) for i in range(5)] + [(200 + i, "w " * 10, "ab", ["b", "a"]) for i in range(30)]
    given = mixing.slim(spark.createDataFrame(rows, SCHEMA + ", members array<string>"), 9, mixing.F.col("members"))
    decided, sizes, targets = mixing.decide(given)
    assert sizes == {"a": 600, "b": 350} and targets["a"] + targets["b"] == pytest.approx(950)
    uses = mixing.with_times(given, decided).collect()
    assert all(0 <= r.uses <= 3 for r in uses)
    assert abs(sum(r.uses * r["size"] for r in uses) - 950) <= 20


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_report(mixing.slim(empty, 9)).count() == 0 and mixing.mix_documents(empty).count() == 0
    bare = spark.createDataFrame([(1, None, "a"), (2, " ", None)], SCHEMA)
    assert {r.taken for r in mixing.mix_report(mixing.slim(bare, 9)).collect()} == {0}


@pytest.mark.parametrize("name", ["shard", "Slot"])
def test_shard_documents_says_what_is_in_the_way(spark, name):
    docs = spark.createDataFrame([(1, "a", 5)], f"doc_id bigint, text string, {name} int")
    with pytest.raises(ValueError, match=name.lower()):
        sharding.shard_documents(docs)
