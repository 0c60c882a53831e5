"""Vector codes against plain Lloyd rounds over Python whole numbers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from jsonloom.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string"


def plain(rows, parts, entries, rounds):
    """``rows``: (vec_id, vector, label) that are kept, all of one length. Codes, errors and codebooks by definition."""
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    step = len(whole[0][1]) // parts
    cut = lambda v, p: tuple(v[p * step : (p + 1) * step])
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            mine = [(near(cut(v, p), books[p])[0], cut(v, p)) for _, v, _ in whole]
            for e in range(len(books[p])):
                own = [x for k, x in mine if k == e]
                if own:
                    books[p][e] = tuple(sum(c) // len(own) for c in zip(*own))
    out = []
    for i, v, label in whole:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(f for _, f in found), label))
    sums = {}
    for *_, error, label in out:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((i, c, e, sums[label]) for i, c, e, label in out), key=repr), digest


def coded(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], SCHEMA).repartition(5)
    out, codes = V.encode_vectors(df, **settings)
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in out.collect()), key=repr), codes.digest()


def floats(draw, n, scale=1.0):
    import struct

    return [struct.unpack("f", struct.pack("f", draw.gauss(0, scale)))[0] for _ in range(n)]


@pytest.mark.parametrize("seed,rounds,entries", [(1, 2, 8), (2, 5, 4), (3, 1, 16), (4, 0, 4)])
def test_against_plain_rounds(spark, seed, rounds, entries, monkeypatch):
    monkeypatch.setattr(V, "RESIDENTS", 40)  # several salts
    draw = random.Random(seed)
    rows = [(draw.randrange(10_000), floats(draw, 8), draw.choice([None, 1, 2, 3])) for _ in range(150)]
    rows += [(20_000 + i, rows[0][1], 7) for i in range(80)]  # a third of all rows is one vector
    rows += rows[:5]  # repeated rows
    rows += [(None, floats(draw, 8), None)]
    assert coded(spark, rows, parts=4, entries=entries, rounds=rounds) == plain(rows, 4, entries, rounds)


def test_dropped_rows_and_small_tables(spark):
    good = [(5, [0.5, -0.001, 0.0, 1.0], 1), (3, [1.0, 2.0, -0.0, -1.0], None)]
    bad = [
        (1, None, 1), (2, [0.1, None, 0.2, 0.3], 1), (4, [float("nan"), 0.0, 0.0, 0.0], 1), (6, [float("inf"), 0.0, 0.0, 0.0], 2),
        (7, [0.0, 0.0, 0.0, float("-inf")], 2), (8, [], 1), (9, [1.0, 2.0], 1), (10, [1e9, 0.0, 0.0, 0.0], 1), (11, [1.0, 2.0, 3.0], 1),
    ]
    assert coded(spark, good + bad, parts=2, entries=64, rounds=2) == plain(good, 2, 64, 2)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(1, [0.0] * 2, 1), (2, [0.0] * 2, 1), (3, [1.0] * 2, 1), (4, [1.0] * 2, 1), (5, [0.5] * 2, 1)]
    assert coded(spark, rows, parts=1, entries=4, rounds=2) == plain(rows, 1, 4, 2)


def test_large_components_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, floats(draw, 4, 60_000.0), i % 2) for i in range(40)]
    assert coded(spark, rows, parts=2, entries=4, rounds=2) == plain(rows, 2, 4, 2)


def test_empty_table(spark):
    out, codes = V.encode_vectors(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"] and out.count() == 0
    assert codes.digest() == hashlib.sha256(b"").hexdigest()


def test_only_movers_are_written_again(spark, monkeypatch):
    written = []
    real = V.cut_lineage
    monkeypatch.setattr(V, "cut_lineage", lambda df: written.append(real(df)) or written[-1])
    draw = random.Random(6)
    rows = [(i, floats(draw, 8), 0) for i in range(400)]
    coded(spark, rows, parts=4, entries=8, rounds=3)
    settled, first, second = written[:3]
    assert settled.count() == 1600
    for moved in (first, second):
        assert 0 < moved.count() < 1600 and moved.where(F.col("left") == F.col("entry")).count() == 0


def test_entries_have_two_digits(spark):
    with pytest.raises(ValueError):
        V.encode_vectors(spark.createDataFrame([], SCHEMA), entries=257)
