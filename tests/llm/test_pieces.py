"""Piece ids against the library on whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from jsonloom.llm import pieces
from jsonloom.llm.blocks import text_blocks

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "ids string, doc_id bigint, block int, text string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(spark, library, texts, **settings):
    rows = [("x", i, 0, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in pieces.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), MODEL, **settings).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, text in enumerate(texts):
        want = library.encode(text or "")
        assert got[i].ids == want and got[i].decoded == library.decode(want), repr(text)


def test_odd_texts(spark, library):
    texts = [
        None, "", " ", "  ", "a", " a", "a ", "a b", "  a  b  ", "▁", "▁ ▁", "a▁b", "a▁ b", "▁▁▁a", "　x", "ﬁ Ａ\xa0b", "a\tb\nc\r\n", "<0x0A> </s><s><unk>",
        "\x00a\x00 b", "𝕏 é ﻿", "é", "a​b", " a a a a", "same same same", "日本語 テキスト", "x" * 20_000, " " * 700 + "y", "\n" * 50,
    ]
    check(spark, library, texts)
    check(spark, library, texts, block_bytes=64)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, library, seed):
    draw = random.Random(seed)
    alphabet = " ▁ab\n é𝕏\t0<>/sth日本 "
    check(spark, library, ["".join(draw.choices(alphabet, k=draw.randrange(80))) for _ in range(250)], block_bytes=3000)


def test_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in pieces.encode(docs, MODEL, block_bytes=50_000).collect():
        assert row.ids == library.encode(texts[row.doc_id]) and row.decoded == library.decode(row.ids)


def test_repeated_rows_null_ids_and_empty_tables(spark, library):
    rows = [(None, "a b"), (None, None), (1, "a b"), (1, "a b"), (1, "c")]
    got = pieces.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), MODEL).collect()
    want = [(i, library.encode(t or "")) for i, t in rows]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    assert pieces.encode(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).count() == 0


def test_a_chunk_is_segmented_once(monkeypatch, library):
    asked = []

    class Counted:
        def __init__(self, **settings):
            self.real = library

        def encode(self, chunks, **settings):
            asked.extend(chunks)
            return self.real.encode(chunks, **settings)

        def __getattr__(self, name):
            return getattr(self.real, name)

    monkeypatch.setattr(pieces.sentencepiece, "SentencePieceProcessor", Counted)
    chunks = pa.table({"chunk": pa.array(["a", "b", "c"], pa.large_string())})
    batch = pa.RecordBatch.from_pydict({"block": [1, 2], "bucket": pa.array([0, 0], pa.int32()), "payload": [pieces.packed(chunks)] * 2})
    assert len(list(pieces._segment(b"")([batch]))) == 2
    assert sorted(asked) == ["a", "b", "c"]


def test_models_that_do_not_fit_are_refused(library):
    class Crossing:
        def get_piece_size(self):
            return 2

        def id_to_piece(self, i):
            return ["▁a", "a▁b"][i]

        def encode(self, text, out_type=None):
            return library.encode(text, out_type=out_type)

    pieces.check_model(library)
    with pytest.raises(ValueError):
        pieces.check_model(Crossing())


def test_blocks_hold_all_rows_in_order():
    texts = ["a" * n for n in (5, 0, 30, 1, 1, 1, 9, 0)] + [None]
    table = pa.table({"doc_id": range(len(texts)), "text": texts})
    blocks = list(text_blocks(iter(table.to_batches(max_chunksize=4)), 10))
    assert [i for b in blocks for i in b.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert all(b.num_rows == 1 or sum(map(len, b.column("text").to_pylist())) <= 10 for b in blocks)
