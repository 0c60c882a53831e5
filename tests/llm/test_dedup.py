"""Exact and near duplicates, components, line dedup: against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from jsonloom.llm import exact_dedup, line_dedup, near_dedup
from jsonloom.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, tmp_path, rows, schema="doc_id bigint, text string", parts=3):
    """Written and read again, as near duplicates are found in files."""
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 120)]
    want = Union()
    for a, b in edges:
        want.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want.find(x) for x in linked}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_exact_dedup(spark):
    rows = [
        (5, "a b"), (3, "ab"), (9, "a b"), (8, " a  b"), (7, "a  b "), (1, None), (2, ""), (4, "\t\n"), (6, "Ab"), (None, "x"), (10, "x"),
        (11, "same"), (11, "same"), (12, "y" * 50_000), (13, "y" * 50_000 + " "),
    ]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i))
    want = []
    for norm, members in groups.items():
        first = min(members)
        for n, m in enumerate(sorted(members)):
            want.append((m[2], first[2], len(members), n == 0, hashlib.sha256(norm.encode()).hexdigest()))
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=key) == sorted(want, key=key)


def test_exact_dedup_odd_tables(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    clash = spark.createDataFrame([(1, "a", 7, "x", True), (2, "a", 8, "y", False)], "doc_id bigint, text string, row bigint, cell string, kept boolean")
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup.exact_dedup(clash).collect()) == [(1, 1), (2, 1)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_by_force(rows):
    sets, union = [shingles(t) for _, t in rows], Union()
    for a in range(len(rows)):
        union.find(a)
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                union.join(a, b)
    classes = defaultdict(list)
    for a in range(len(rows)):
        classes[union.find(a)].append(a)
    out = []
    for members in classes.values():
        ids = [rows[a][0] for a in members if rows[a][0] is not None]
        out += [(rows[a][0], len(sets[a]), min(ids, default=None)) for a in members]
    return sorted(out, key=str)


def edited(draw, words, share):
    return " ".join(draw.choice(["alpha", "beta", "gamma"]) + str(draw.randrange(999)) if draw.random() < share else w for w in words)


@pytest.mark.parametrize("block", [4, 512])
def test_near_dedup(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "ROWS_AT_ONCE", 8)
    monkeypatch.setattr(near_dedup, "MANY", 2)
    draw, rows = random.Random(3), []
    for family in range(6):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([6, 40, 120]))]
        for _ in range(8):
            rows.append((len(rows), edited(draw, words, draw.choice([0, 0.01, 0.02, 0.05]))))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "One  two"), (105, "one two three"), (None, "one two"), (106, "z " * 30_000)]
    got = near_dedup.near_dedup(docs(spark, tmp_path, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_force(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_keeps_one_of_repeated_rows(spark, tmp_path):
    rows = [(1, "a b c d e f")] * 3 + [(2, "a b c d e f"), (3, None), (3, None)]
    given = docs(spark, tmp_path, [(i, t, "en", "s", 1) for i, t in rows], DOCS)
    assert sorted((r.doc_id, r.kept) for r in near_dedup.near_dedup(given).collect()) == [(1, False), (1, False), (1, True), (2, False), (3, True), (3, True)]
    left = near_dedup.drop_near_duplicates(given)
    assert left.columns == given.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 3]


def repartitioned(monkeypatch, spark):
    """From the first look at the clusters on, files are packed into other partitions, as when executors join."""
    real = near_dedup.id_filter

    def other(df):
        found = real(df)
        spark.conf.set("spark.sql.files.minPartitionNum", 13)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        return found

    monkeypatch.setattr(near_dedup, "id_filter", other)


def test_near_dedup_does_not_depend_on_partitions(spark, tmp_path, monkeypatch):
    draw, rows = random.Random(6), []
    for _ in range(5):
        words = [f"w{draw.randrange(300)}" for _ in range(50)]
        rows += [(len(rows) + k, edited(draw, words, draw.choice([0, 0.02]))) for k in range(6)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (900, None), (None, rows[0][1])]
    given = docs(spark, tmp_path, [(i, t, draw.choice("ab")) for i, t in rows], "doc_id bigint, text string, text_a string", 9)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")}
    repartitioned(monkeypatch, spark)
    try:
        got = near_dedup.near_dedup(given).collect()
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
        left = near_dedup.drop_near_duplicates(given)
        assert left.columns == given.columns
        stay = [(r.doc_id, r.text) for r in left.collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_force(rows)
    assert sorted(i for i, _ in stay) == sorted(r.doc_id for r in got if r.kept) and len(stay) < len(rows)


def test_near_dedup_odd_tables(spark, tmp_path):
    clash = docs(spark, tmp_path, [(1, "a b c d e", 5, "x")], "doc_id bigint, text string, row bigint, band string")
    assert [tuple(r) for r in near_dedup.near_dedup(clash).drop("row").collect()] == [(1, 1, 1, True)]
    assert near_dedup.drop_near_duplicates(clash).collect() == clash.collect()
    assert near_dedup.near_dedup(clash.where("doc_id > 1")).count() == 0


def test_sketch_limit_lets_threshold_pairs_through():
    import numpy as np

    draw = np.random.default_rng(0)
    for _ in range(20):
        core, rest = draw.integers(0, 2**63, 300, dtype=np.uint64), draw.integers(0, 2**63, 100, dtype=np.uint64)
        sets = [np.unique(np.concatenate((core, rest[:50]))), np.unique(np.concatenate((core, rest[50:])))]
        bits = near_dedup.odd_sketches(near_dedup.minhashes(sets))
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= near_dedup.sketch_limit()


@pytest.mark.parametrize("part", [4096, 7])
def test_line_dedup(spark, monkeypatch, part):
    monkeypatch.setattr(line_dedup, "PART_PAGES", part)
    page = lambda *ls: "<html><script>x\ny</script><body>" + "".join(f"<p>{x}</p>\n" for x in ls) + "<!-- c --></body></html>"
    rows = [(i, f"http://A.org/{i}", page("menu", f"own {i}", f"own {i}", "foot" if i % 20 == 0 else "")) for i in range(40)]
    rows += [(50 + i, "https://small.org:80/x", page("menu")) for i in range(3)] + [(60, None, None), (61, "", ""), (62, "odd", "<p>menu")]
    got = {r.page_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert (got[1].host, got[1].n_lines, got[1].n_dropped, got[1].text) == ("a.org", 3, 1, "own 1\nown 1")
    assert got[0].text == "own 0\nown 0\nfoot"  # 2 of 40 pages
    assert got[50].text == "menu" and got[50].host == "small.org"
    assert (got[60].host, got[60].n_lines, got[60].text) == ("", 0, "") and got[62].text == "menu"


@pytest.mark.parametrize("pages", [4, 9, 10, 19])
def test_line_dedup_keeps_lines_of_few_pages(spark, pages):
    rows = [(i, "http://a.org/x", f"<p>menu<p>own {i}<p>{'pair' if i < 2 else 'other'} {min(i, 2)}" + ("<p>two" if i < 2 else "")) for i in range(pages)]
    got = {r.page_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == "own 0\npair 0\ntwo" and got[1] == "own 1\npair 1\ntwo"
    assert got[3] == ("own 3\nother 2" if pages == 4 else "own 3")


def test_line_dedup_odd_tables(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert line_dedup.line_dedup(empty).count() == 0
    clash = spark.createDataFrame([(1, "http://a", "x", "h", 3)] * 5, "page_id bigint, url string, html string, host string, lines int")
    assert {(r.host, r.text) for r in line_dedup.line_dedup(clash).collect()} == {("a", "")}
