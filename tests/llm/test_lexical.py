"""Ranked search against scores by definition, and the treap against its grid."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jsonloom.llm import lexical as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def plain(docs, items, k):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n_docs, n_terms = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, count, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = 0
            for term in set(words(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * count[term]) // (1000 * count[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k, tile_bytes=300):
    frame = spark.createDataFrame([(t, i, "x", 1) for i, t in docs], "text string, doc_id bigint, item_id string, score int").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in X.search(X.build_index(frame, tile_bytes), asked, k).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_scores(spark, seed, monkeypatch):
    monkeypatch.setattr(X, "OPENED", 3)
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "ärger", "ÄRGER", "x1", "1", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: draw.choice([" ", "-", "\n", ", "]).join(draw.choices(vocabulary, weights, k=n))
    docs = [(draw.randrange(1000), text(draw.choice([0, 1, 5, 40, 300]))) for _ in range(150)]
    docs += [(2000 + i, docs[0][1] + " w1 w2") for i in range(40)] + [(None, text(20)), (None, text(20)), (3000, None), (3001, " ,.;"), (3002, "A b")]
    items = [(i, text(8)) for i in range(12)] + [(50, None), (51, ""), (52, "unknown words"), (53, docs[3][1] or "w5"), (0, text(5)), (None, "w3 w3 W3")]
    assert searched(spark, docs, items, 7) == plain(docs, items, 7)


def test_long_text_and_hot_ties(spark):
    docs = [(i, "same text for all") for i in range(300)] + [(500, "needle " + "hay " * 60_000), (501, "needle")]
    items = [(1, "same TEXT"), (2, "needle hay"), (3, "all needle")]
    got = searched(spark, docs, items, 50, tile_bytes=2000)
    assert got == plain(docs, items, 50)
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(50))


def test_floors_change_nothing(spark, monkeypatch):
    draw = random.Random(9)
    docs = [(i, " ".join(draw.choices("abcdefghijkl", k=draw.randrange(1, 30)))) for i in range(200)]
    items = [(1, "a b c"), (2, "k l"), (3, "d")]
    want = plain(docs, items, 5)
    for first in (1, 2, 50):
        monkeypatch.setattr(X, "FIRST", first)
        assert searched(spark, docs, items, 5) == want


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "ITEMS", 2)
    docs = [(i, f"a{i % 3} b{i % 5}") for i in range(30)]
    items = [(i, f"a{i} b{i}") for i in range(5)]
    assert searched(spark, docs, items, 4) == plain(docs, items, 4)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    empty_docs = spark.createDataFrame([], "doc_id bigint, text string")
    empty_items = spark.createDataFrame([], "item_id bigint, text string")
    assert X.search(X.build_index(empty_docs), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0
    assert X.search(X.build_index(spark.createDataFrame(docs, "doc_id bigint, text string")), empty_items).count() == 0


def test_treap_holds_its_grid():
    draw = np.random.default_rng(3)
    side = 5
    cells = np.unique(draw.integers(0, 32 * 32, 90))
    rows, columns, impacts = cells // 32, cells % 32, draw.integers(1, 1000, len(cells))
    levels = X.treap(rows, columns, impacts, side)
    assert len(levels) == side + 1 and [("mask" in level) for level in levels] == [True] * side + [False]
    tops = -levels[0]["fall"]
    assert tops.tolist() == [impacts.max()]
    for up, down in zip(levels, levels[1:]):
        counts = [bin(m).count("1") for m in up["mask"]]
        assert sum(counts) == len(down["fall"]) and (down["fall"] >= 0).all()
        tops = np.repeat(tops, counts) - down["fall"]
    assert sorted(tops.tolist()) == sorted(impacts.tolist())


def test_terms():
    texts = ["Ab, a_b;é\x7fÉ", None, "", "9x▁Z"]
    terms, at = X.terms_of(pa.array(texts, pa.large_string()))
    got = [t.decode() for t in terms.to_pylist()]
    assert [got[a:b] for a, b in zip(at, at[1:])] == [words(t) for t in texts]
