"""Toxicity, language-model scores, decontamination and personal data: held-out accuracy and plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jsonloom.llm import decontamination, lm_scoring, pii, toxicity
from jsonloom.llm import text as T

DOCS = "doc_id bigint, text string, lang string"


def prose(draw, n, words=400):
    return " ".join(f"w{min(draw.randrange(words), draw.randrange(words))}" for _ in range(n))


# ---- word hashes


def test_word_hashes_follow_words():
    texts = ["The the THE cat", None, "", " \t", "a\x0bb", "é É e", "the", "x" * 5000 + " the"]
    seen = {}
    for _, _, body, at in T.pieces(pa.array(texts, pa.string())):
        starts, stops, hashes, word_at = T.words(body, at)
        for a, b, h in zip(starts, stops, hashes, strict=True):
            word = bytes(body[a:b]).decode()
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            assert seen.setdefault(int(h), word) == word
        counts = np.diff(word_at).tolist()
    assert counts == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_grams_do_not_cross_texts():
    body, at = T.buffer(pa.array(["a b c d", "e f", "a b c d e f"]))
    _, _, hashes, word_at = T.words(body, at)
    grams, cut = T.grams(hashes, word_at, 3, short=True)
    assert np.diff(cut).tolist() == [2, 1, 4]
    assert grams[:2].tolist() == grams[3:5].tolist() and len(set(grams.tolist())) == 5


# ---- toxicity


def test_toxicity(spark):
    draw, rows, labels = random.Random(1), [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = prose(draw, 60).split()
        if toxic:
            words[draw.randrange(60)] = draw.choice(["nasty", "VILE,", "awful"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None, None), (2001, "", "en"), (None, "vile", "en"), (5, rows[5][1], "en"), (2002, prose(draw, 40_000) + " vile", "en")]
    labels += [(None, 1, 1), (3, None, None), (7, 1, 0)]
    s = toxicity.Settings(bits=16, l1=8.0)
    got = toxicity.toxicity_report(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), s).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got}
    held = [of[i] for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r.held_out for r in held) and not of[None].held_out and of[None].predicted == 1
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert of[2000].score == of[2001].score and of[2000].predicted == 0


def test_toxicity_odd_tables(spark):
    given = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id bigint, text string, `toxic row` string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_report(given, none).collect()} == {0.5}
    assert toxicity.drop_toxic(given, none).collect() == given.collect()
    assert toxicity.toxicity_report(given.where("doc_id > 5"), none).count() == 0


# ---- language model


def test_token_probabilities_sum_to_one():
    """Over all spellings of up to two bytes and all longer ones together."""
    code = lm_scoring.huffman(np.arange(256))
    tables = np.zeros((len(lm_scoring.ORDERS), 1 << lm_scoring.TABLE_BITS), np.uint16)
    rows = pa.RecordBatch.from_arrays([pa.array([b"ab", b"a", b""]), pa.array([[5, 0], [3, 1], [2, 2]], pa.list_(pa.int64()))], ["word", "counts"])
    size = (1 << lm_scoring.TABLE_BITS) // lm_scoring.CHUNKS
    for batch in lm_scoring.packed_counts(iter([rows]), code, 2):
        for part, chunk, zeros, ones in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair = [lm_scoring.coded(np.frombuffer(zlib.decompress(x), np.uint32)).astype(np.uint16) for x in (zeros, ones)]
            tables[part, chunk * size : (chunk + 1) * size] = pair[0] << 8 | pair[1]
    mixer = lm_scoring.Mixer(code, tables)
    mixer.learn(lm_scoring._as_text(pa.array([b"ab", b"a", b""] * 20)), np.array([0, 1, 0] * 20), np.ones(60), 2)
    letters = [bytes([b]) for b in range(256) if b != 0x20]
    short = lm_scoring._as_text(pa.array([b"", *letters]))
    p = 10 ** mixer.log10(short, 2)
    assert (p.sum(axis=0) < 1).all() and p[0, 0] > 0.05
    lengths = code[1]
    assert sum(2.0 ** -int(x) for x in lengths) == pytest.approx(1)


def lm_rows(draw):
    rows = []
    for i in range(400):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(f"{lang}{draw.choice('abc')}{min(draw.randrange(90), draw.randrange(90))}" for _ in range(40)), lang))
    return rows + [(500, None, None), (501, "", "en"), (502, "New Unseen", "fr"), (None, "ena1 ENA1", "en"), (7, rows[7][1], "en"), (503, "ena1 " * 30_000, "en")]


def test_lm_scores(spark, tmp_path):
    rows = lm_rows(random.Random(2))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "docs"))
    got = lm_scoring.lm_scores(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + [""]
    counts = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = defaultdict(list)
    for i, t, _ in rows:
        words = tokens(t)
        want[i].append((held(i), len(words), sum(counts[w] > 0 for w in words), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)))
    for r in got:
        assert r.train_tokens == n and r.score < 0
        assert any((r.held_out, r.n_tokens, r.n_known) == w[:3] and r.base_score == pytest.approx(w[3]) for w in want[r.doc_id])
    unseen = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_lm_mixer_learns_from_all_words(spark):
    """More words than a bounded sample holds: weights and map are those of one mixer that sees every word."""
    draw = random.Random(3)
    rows = [("".join(draw.choice("etaoinsh") for _ in range(draw.randrange(2, 9))) + str(i), [1 + (i % 7 == 0), i % 2]) for i in range(62_000)]
    words = spark.createDataFrame(rows, "word string, counts array<bigint>").select(F.col("word").cast("binary").alias("word"), "counts").repartition(5).localCheckpoint()
    shared, weights, refining = lm_scoring.train(words, 2, lm_scoring.Settings())
    one = lm_scoring.Mixer.of(*shared.value)
    dealt = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(16))).toPandas()
    part, counts = dealt["part"].to_numpy(), np.stack(dealt["counts"].to_numpy())
    text = lm_scoring._as_text(pa.array(dealt["word"].tolist(), pa.binary()))

    def added(what, at):
        some = [(g, at[counts[at, g] > 0]) for g in range(2)]
        return sum(what(text.take(pa.array(a)), g, counts[a, g]) for g, a in some)

    for first, last in ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16)):
        one.follow(added(one.bends, np.flatnonzero((part >= first) & (part < last))))
    one.refine(added(one.shares, np.arange(len(part))))
    assert np.allclose(np.frombuffer(weights).reshape(one.weights.shape), one.weights, atol=1e-6)
    assert np.allclose(np.frombuffer(refining).reshape(one.map.shape), one.map, atol=1e-4)


def test_lm_counting_holds_little_beside_its_input(monkeypatch):
    """An executor runs several of these tasks beside its heap: a block's tokens and sums of all slots are not held whole."""
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcdefgh") * draw.randrange(1, 9) for _ in range(300)) for _ in range(6000)]
    block = pa.RecordBatch.from_arrays(
        [pa.array([0] * 6000), pa.array([i % 5 == 1 for i in range(6000)]), pa.array([i % 2 for i in range(6000)], pa.int32()), pa.array(texts)],
        ["block", "held_out", "class", "text"],
    )

    def peak(made):
        tracemalloc.start()
        out = list(made)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    (words,), most = peak(lm_scoring.block_words(iter([block]), 2))
    assert most < 3 * block.nbytes
    want = [Counter(w for i, t in enumerate(texts) if i % 5 != 1 and i % 2 == g for w in t.split() + [""]) for g in (0, 1)]
    assert {w.decode(): n for w, n in zip(words["word"].to_pylist(), words["counts"].to_pylist(), strict=True)} == {
        w: [want[0][w], want[1][w]] for w in {*want[0], *want[1]}
    }
    monkeypatch.setattr(lm_scoring, "TABLE_BITS", 18)
    tables = len(lm_scoring.ORDERS) * 4 * (2 << 18)
    _, most = peak(lm_scoring.packed_counts(iter([words.select(["word", "counts"])]), lm_scoring.huffman(np.arange(256)), 2))
    assert most < 1.4 * tables


def test_lm_scores_without_rows(spark, tmp_path):
    spark.createDataFrame([], DOCS + ", block string, row int").write.parquet(str(tmp_path / "docs"))
    assert lm_scoring.lm_scores(spark.read.parquet(str(tmp_path / "docs"))).count() == 0


# ---- decontamination


def test_decontamination(spark):
    draw = random.Random(3)
    items = [(i, " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(300)}" for _ in range(draw.randrange(12, 40)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "too short"), (None, items[3][1]), (3, items[3][1])]
    rows, want = [], set()
    for i in range(80):
        words = prose(draw, 200).split()
        if i % 2:
            item = draw.randrange(20)
            copy = items[item][1].split()
            for _ in range(len(copy) // 8 if i % 4 == 1 else 0):  # edited: words replaced, left out and put in
                at = draw.randrange(len(copy))
                copy[at : at + draw.choice([0, 1])] = ["edit"] * draw.choice([0, 1])
            words[100:100] = " ".join(copy).upper().replace(" ", ", ").split(" ")
            want.add((i, item))
        rows.append((i, " ".join(words), "en"))
    rows += [(90, None, None), (91, "", "en"), (92, items[0][1], "en"), (92, items[0][1], "en")]
    rows += [(1000 + k, "some " * k + items[1][1], "en") for k in range(150)]  # copies that fill the corpus
    given, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contaminated(given, benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.item_id is not None}
    assert want | {(92, 0)} | {(1000 + k, 1) for k in range(150)} == found
    assert all(0.5 <= r.score <= 1 and r.word_end > r.word_start for r in got)
    assert sum(r.doc_id == 92 for r in got) == 2
    clean = decontamination.decontaminate(given, benchmark)
    assert clean.columns == given.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted({i for i in range(80) if i % 2 == 0} | {90, 91})


@pytest.mark.parametrize("exact", [0, 1, 300])
def test_decontamination_of_heavy_edits(spark, exact):
    """One word in four changed, in tables of under 1000 documents, alone and beside exact copies."""
    draw, rows, want = random.Random(6), [], set()
    items = [(i, " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(300)}" for _ in range(40))) for i in range(8)]
    for item, text in items:
        for k in range(6):
            words = text.split()
            for at in draw.sample(range(40), 10):
                words[at] = f"new{draw.randrange(1000)}"
            if any(all(w[:3] != "new" for w in words[j : j + 4]) for j in range(37)):
                want.add((len(rows), item))
            rows.append((len(rows), f"{prose(draw, 60)} {' '.join(words)} {prose(draw, 60)}", "en"))
    rows += [(1000 + k, f"{prose(draw, 5)} {items[0][1]}", "en") for k in range(exact)]
    got = decontamination.contaminated(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert len(want) > 40 and want | {(1000 + k, 0) for k in range(exact)} == {(r.doc_id, r.item_id) for r in got}


def test_reachable_is_no_less_than_the_alignment():
    draw = np.random.default_rng(7)
    items = [draw.integers(0, 12, draw.integers(1, 15)).astype(np.uint64) for _ in range(200)]
    words = draw.integers(0, 9, 14).astype(np.uint64)
    cuts = np.concatenate(([0], np.cumsum([len(x) for x in items])))
    most = decontamination.reachable(np.isin(np.concatenate(items), words), cuts)
    for item, bound in zip(items, most, strict=True):
        assert bound >= decontamination.align(item, words)[0]
        assert bound == max(sum(2 if w in words else -1 for w in item[i:j]) for i in range(len(item)) for j in range(i, len(item) + 1))


def test_decontamination_odd_tables(spark):
    given = spark.createDataFrame([(1, "a b c d e", "x")], "doc_id bigint, text string, matches string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate(given, none).collect() == given.collect()
    assert decontamination.contaminated(given.where("doc_id > 1"), none).count() == 0


def test_alignment():
    a = np.array([1, 2, 3, 4, 5], np.uint64)
    assert decontamination.align(a, np.array([9, 1, 2, 3, 4, 5, 9], np.uint64)) == (10, 5, 6)
    assert decontamination.align(a, np.array([1, 2, 4, 5], np.uint64))[0] == 7
    assert decontamination.align(a, np.array([1, 2, 8, 3, 4, 5], np.uint64))[0] == 9
    assert decontamination.align(a, np.array([1, 2, 8, 4, 5], np.uint64))[0] == 7
    assert decontamination.align(a, np.zeros(0, np.uint64)) == (0, 0, 0)


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(number) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0
    return kind == "email" or 9 <= len(number) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k in PATTERNS for m in re.finditer(PATTERNS[k], text or "") if passes(k, m.group())]


def written(spark, rows):
    frame = pii.find_pii(spark.createDataFrame(rows, DOCS))
    return frame.select("doc_id", pii.written(pii.F.array_sort("base")).alias("base"), pii.written(pii.F.col("spans")).alias("spans")).collect()


def test_base_spans(spark):
    draw = random.Random(4)
    parts = ["a@b.co", "@", "x.y+z@q-r.example.com", "+", "1.2.3.4", "300.1.1.1", "007.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (637) 555-3926", " ", ".", "é", "\n", "12", "-", "(", ")", "+49"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(30))), "en") for i in range(300)]
    rows += [(900, None, None), (901, "", "en"), (902, "9" * 30_000, "en"), (903, "a" * 30_000 + "@", "en"), (904, "1.1.1.1 " * 3_000, "en"), (5, rows[5][1], "en"), (None, "a@b.co", "en")]
    got = written(spark, rows)
    assert len(got) == len(rows)
    texts = defaultdict(list)
    for i, text, _ in rows:
        texts[i].append(text)
    for r in got:
        assert r.base in {",".join(base_spans(t)) for t in texts[r.doc_id]}
        assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))


def test_trees_add_spans(spark):
    draw, rows = random.Random(5), []
    for i in range(300):
        rows.append((i, f"call {prose(draw, 3)} phone +1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)} or {prose(draw, 3)}", "en"))
        rows.append((1000 + i, f"sum {draw.randrange(10, 99)}.{draw.randrange(10, 99)}.{draw.randrange(10, 99)} in {draw.randrange(100, 999)} {draw.randrange(100, 999)} {prose(draw, 3)}", "en"))
    rows.append((5000, "phone 001 (637) 555-3926 now", "en"))
    got = {r.doc_id: r for r in written(spark, rows)}
    assert all(got[i].base.startswith("phone") and got[i].spans == got[i].base for i in range(300))
    assert all(got[1000 + i].spans == "" for i in range(300))
    assert got[5000].base == ""


def private_rows(draw, n):
    """Base forms and number runs, and from 5000 on other forms beside cue words."""
    rows = []
    for i in range(n):
        card = f"4{draw.randrange(10**14):014}"
        card += next(d for d in "0123456789" if passes("card", card + d))
        number = f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
        rows.append((i, f"call {prose(draw, 3)} phone {number} or mail m{i}@x{i % 9}.org, card {card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]} {prose(draw, 3)}", "en"))
        rows.append((1000 + i, f"sum {draw.randrange(100, 999)} {draw.randrange(100, 999)} {draw.randrange(1000, 9999)} and {prose(draw, 3)}", "en"))
    return rows + [(5000, "phone 001 (637) 555-3926 now", "en"), (5001, "mail joe (at) example (dot) org", "en"), (5002, "phone 1-637-555-3926 now", "en")]


@pytest.mark.parametrize("runs", [0, 30_000])
def test_trees_add_other_forms(spark, runs):
    """Beside many more number runs than base forms, too."""
    draw = random.Random(8)
    rows = private_rows(draw, 300) + [(10_000 + i, " ".join(f"sum {draw.randrange(100, 999)} {draw.randrange(100, 999)} {draw.randrange(1000, 9999)}" for _ in range(100)), "en") for i in range(runs // 100)]
    got = {r.doc_id: r for r in written(spark, rows)}
    assert (got[5000].base, got[5000].spans) == ("", "phone:6:24")
    assert (got[5001].base, got[5001].spans) == ("", "email:5:31")
    assert (got[5002].base, got[5002].spans) == ("", "phone:6:20")
    assert all(r.spans == "" for i, r in got.items() if 1000 <= i < 5000 or i >= 10_000)


def test_redaction(spark, tmp_path):
    rows = [(1, "mail a@b.co and 1.2.3.4!", "en"), (2, None, "en"), (3, "plain", "en")]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "docs"))
    got = {r.doc_id: r.text for r in pii.redacted(spark.read.parquet(str(tmp_path / "docs"))).collect()}
    assert got == {1: "mail [email] and [ip]!", 2: None, 3: "plain"}


def test_no_texts(spark):
    assert pii.find_pii(spark.createDataFrame([], DOCS)).count() == 0


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_many_spans_in_one_text(spark, tmp_path):
    """The time a text takes follows its spans; all places are right, also over groups of matches and pieces of text."""
    import time

    n = 50_000
    text = " ".join(f"u{i}@h{i % 7}.org" + (" ünï" if i % 1000 == 0 else "") for i in range(n))
    spark.createDataFrame([(1, text), (2, "a@b.org, c@d.org"), (3, None)], "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    start = time.time()
    got = {r.doc_id: r.base for r in pii.find_pii(spark.read.parquet(str(tmp_path / "docs"))).collect()}
    assert time.time() - start < 90
    assert [(s.start, s.end) for s in got[1]] == [m.span() for m in re.finditer(r"[a-z0-9]+@[a-z0-9]+\.org", text)]
    assert [(s.start, s.end) for s in got[2]] == [(0, 7), (9, 16)] and got[3] == []


def test_added_spans_against_a_plain_loop(spark):
    draw = random.Random(12)
    likely, base = [], []
    for row in range(40):
        base += [(row, 0, a, a + draw.randrange(1, 6)) for a in range(0, 60, 15) if draw.random() < 0.5]
        likely += [(row, round(draw.random(), 3), draw.randrange(4), a, a + draw.randrange(1, 12)) for a in (draw.randrange(60) for _ in range(draw.randrange(8)))]
    rows = spark.createDataFrame([(r, [x[1:] for x in base if x[0] == r]) for r in range(40)], "row bigint, base array<struct<order:int,start:int,end:int>>")
    got = {r.row: sorted((s.start, s.end, s.order) for s in r.more) for r in pii.added(spark.createDataFrame(likely, "row bigint, p double, order int, start int, end int"), rows).collect()}
    for row in range(40):
        taken, found = [(a, b) for r, _, a, b in base if r == row], []
        for _, p, order, a, b in sorted((x for x in likely if x[0] == row), key=lambda x: (-x[1], x[3], x[4], x[2])):
            if all(e <= a or b <= s for s, e in taken):
                taken.append((a, b))
                found.append((a, b, order))
        assert got.get(row, []) == sorted(found)


def test_repeated_ids_do_not_swell_the_sample(spark):
    ids = spark.range(100).withColumnRenamed("id", "doc_id")
    free = [r.doc_id for r in ids.where(~toxicity.held_out()).orderBy("doc_id").limit(3).collect()]
    rows = [(free[0], f"bad word {i}") for i in range(300)] + [(free[1], "good"), (free[2], "fine")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0, int(i == free[0])) for i in free], "doc_id bigint, quality int, toxic int")
    least = docs.where(f"doc_id = {free[0]}").selectExpr("min_by(text, xxhash64(text))").first()[0]
    one = docs.where((docs["doc_id"] != free[0]) | (docs["text"] == least))
    assert toxicity.fit(docs, labels) == toxicity.fit(one, labels)
