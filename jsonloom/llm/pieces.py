"""Encoding with a sentencepiece model through a table of distinct chunks.

The library marks white space: a text is one marker (if it is not empty) and itself, with every space written as a
marker. In a vocabulary in which no piece has a marker behind another character, no piece crosses from a character to a
marker, so a text may be cut there: a chunk is a run of markers and the characters up to the next marker, and its ids do
not depend on its neighbours.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame

from jsonloom.llm.blocks import BLOCK, offsets, packed, text_blocks, unpacked
from jsonloom.session import scratch_path

MARK = "▁"
#: ids that go back to Spark in one batch, about
OUT = 500_000
#: chunks that the library segments in one call
CALL = 4096

# bucket -1: the documents of a block as numbers of chunks, and the numbers of its distinct chunks by bucket and text;
# else the distinct chunks of that bucket
CUT = "block bigint, bucket int, payload binary"
ENCODED = "doc_id bigint, ids array<int>, decoded string"


def load_model(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(sp: sentencepiece.SentencePieceProcessor) -> None:
    """Raise ValueError unless the model marks and cuts white space as this module's chunks need it."""
    crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
    written = lambda text: "".join(sp.encode(text, out_type=str))
    probes = {"a": f"{MARK}a", " a  b ": f"{MARK}{MARK}a{MARK}{MARK}b{MARK}", "": "", "a" + MARK: f"{MARK}a{MARK}"}
    if crossing or any(written(text) != marked for text, marked in probes.items()):
        raise ValueError("chunks need a model with a marker before the text, all spaces kept, and no piece that crosses into a marker")


def cut_chunks(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks, each without its first marker, by falling frequency; their numbers in text order; the texts' offsets in these."""
    _, at, data = text.buffers()
    at = np.frombuffer(at, np.int64)[text.offset : text.offset + len(text) + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    marks = body == 0x20
    if len(body) > 2:
        wide = np.flatnonzero((body[:-2] == 0xE2) & (body[1:-1] == 0x96) & (body[2:] == 0x81))
        for k in range(3):
            marks[wide + k] = True
    starts = marks.copy()
    starts[1:] &= ~marks[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    starts[begins] = True
    starts = np.flatnonzero(starts)
    at_chunk = np.searchsorted(starts, at, "left")
    if not len(starts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), at_chunk
    # a text's first chunk has its marker before the text, all others hold it
    first = np.zeros(len(starts), bool)
    first[np.searchsorted(starts, begins, "left")] = True
    written = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(body)).tobytes()), pa.py_buffer(body.tobytes())])
    inner = written.filter(pa.array(~first)).dictionary_encode()
    outer = written.filter(pa.array(first)).dictionary_encode()
    stripped = pc.replace_substring_regex(inner.dictionary.cast(pa.large_string()), f"^( |{MARK})", "")
    both = pa.concat_arrays([stripped, outer.dictionary.cast(pa.large_string())]).dictionary_encode()
    place = both.indices.to_numpy()
    numbers = np.empty(len(starts), np.int64)
    numbers[~first] = place[inner.indices.to_numpy()]
    numbers[first] = place[len(stripped) + outer.indices.to_numpy()]
    order = np.argsort(-np.bincount(numbers, minlength=len(both.dictionary)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return both.dictionary.take(pa.array(order)), rank[numbers], at_chunk


def _planes(name: str, numbers: np.ndarray) -> dict[str, pa.Array]:
    """Numbers by their bytes, lowest first: the higher ones hardly vary."""
    return {f"{name}{i}": pa.array([((numbers >> 8 * i) & 255).astype(np.uint8).tobytes()], pa.large_binary()) for i in range(4)}


def _from_planes(name: str, whole: pa.Table) -> np.ndarray:
    return sum(np.frombuffer(whole.column(f"{name}{i}")[0].as_py(), np.uint8).astype(np.int64) << 8 * i for i in range(4))


def _cut(buckets: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, block in enumerate(text_blocks(batches, size)):
            number = (TaskContext.get().partitionId() << 32) + k
            chunks, numbers, at = cut_chunks(block.column("text").chunk(0))
            docs = pa.table({"doc_id": block.column("doc_id"), "n": np.diff(at)})
            order, rows = np.zeros(0, np.int64), []
            if len(chunks):
                bucket = pd.util.hash_array(chunks.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(buckets)
                order = pc.array_sort_indices(chunks).to_numpy().astype(np.int64)
                order = order[np.argsort(bucket[order], kind="stable")]
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                rows = [(int(bucket[part[0]]), packed(pa.table({"chunk": chunks.take(pa.array(part))}))) for part in np.split(order, cuts)]
            whole = {"docs": pa.array([packed(docs)], pa.large_binary())} | _planes("b", numbers) | _planes("o", order)
            rows.append((-1, packed(pa.table(whole))))
            for first in range(0, len(rows), 64):
                some = rows[first : first + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(some), pa.int64()), pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.binary())],
                    ["block", "bucket", "payload"],
                )

    return run


def piece_texts(sp: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each id writes: a piece with markers as spaces, one byte, or nothing."""

    def text(i: int) -> bytes:
        if sp.is_byte(i):
            return bytes([int(sp.id_to_piece(i)[3:-1], 16)])
        return b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode()

    return [text(i) for i in range(sp.get_piece_size())]


def _segment(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = load_model(model)
        alone, written = sp.piece_to_id(MARK), piece_texts(sp)
        kind = np.uint16 if sp.get_piece_size() <= 2**16 else np.int32
        known: dict[str, int] = {}
        ids: list[np.ndarray] = []
        for batch in batches:
            for block, bucket, payload in zip(*(batch.column(n).to_pylist() for n in ("block", "bucket", "payload"))):
                asked = unpacked(payload)
                chunks = asked.column("chunk").to_pylist()
                new = [c for c in chunks if c not in known]
                for first in range(0, len(new), CALL):
                    some = new[first : first + CALL]
                    for chunk, got in zip(some, sp.encode(some, num_threads=1)):
                        known[chunk] = len(ids)
                        got = got if chunk else [alone]
                        ids.append(np.array(got, kind))
                        # texts are put together from ids at the end; here the library says once whether that is right
                        if b"".join(written[i] for i in got) != b" " + sp.decode(got).encode():
                            raise ValueError(f"the library decodes {got} in a way of its own")
                lists = [ids[known[c]] for c in chunks]
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                answer = pa.table({"ids": pa.LargeListArray.from_arrays(offsets(sizes), np.concatenate(lists))})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([packed(answer)], pa.binary())], ["block", "bucket", "payload"]
                )

    return run


def _join_back(texts: list[bytes]):
    """The documents of one block, from their chunk numbers and the answers for its chunks."""
    lengths = np.array([len(t) for t in texts])
    pieces = pa.array(texts, pa.large_binary())

    def written(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of runs of ids, without the space that the marker before a text writes."""
        body = np.frombuffer(pieces.take(pa.array(ids)).buffers()[2] or b"", np.uint8)
        spans = offsets(lengths[ids])[ends]
        spaces = spans[:-1][spans[:-1] < spans[1:]]
        kept = np.ones(spans[-1], bool)
        kept[spaces] = False
        spans = spans - np.searchsorted(spaces, spans, "left")
        data = pa.py_buffer(body[: len(kept)][kept].tobytes())
        return pa.Array.from_buffers(pa.large_string(), len(spans) - 1, [None, pa.py_buffer(spans.astype(np.int64).tobytes()), data]).cast(pa.string())

    def run(key, streams: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for payload in streams.column("payload"):
            whole = unpacked(payload.as_py())
            docs = unpacked(whole.column("docs")[0].as_py())
            numbers, order = _from_planes("b", whole), _from_planes("o", whole)
            at = offsets(docs.column("n").to_numpy())
            if answers.num_rows:
                parts = [unpacked(a.as_py()) for a in answers.sort_by("bucket").column("payload")]
                ids = pa.concat_arrays([p.column("ids").chunk(0) for p in parts]).take(pa.array(np.argsort(order)))
                sizes = np.diff(ids.offsets.to_numpy())
            weight = offsets(sizes[numbers])[at] if len(numbers) else at
            first, n = 0, len(at) - 1
            while first < n:
                last = max(first + 1, int(np.searchsorted(weight, weight[first] + OUT, "right")) - 1)
                here = numbers[at[first] : at[last]]
                ends = weight[first : last + 1] - weight[first]
                got = ids.take(pa.array(here)).flatten().to_numpy() if len(here) else np.zeros(0, np.int32)
                id_lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got.astype(np.int32)))
                doc_ids = docs.column("doc_id").chunk(0).slice(first, last - first)
                out.append(pa.RecordBatch.from_arrays([doc_ids, id_lists, written(got, ends)], ["doc_id", "ids", "decoded"]))
                first = last
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        return pa.Table.from_batches(out, schema)

    return run


def encode(docs: DataFrame, model_file: str, block_bytes: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, ids, decoded``: the ids the library gives for the whole text, and what it decodes them to.

    Blocks of documents are cut into chunks once, and written as numbers into the block's list of distinct chunks. The
    lists are dealt by the chunk's hash, so all blocks that hold a chunk ask the same task, which segments it once; the
    answers go back to the blocks, where numbers become ids in text order. A chunk crosses the network once per block,
    not once per occurrence, and the documents' numbers wait in files that are dealt by block. No task holds more than a
    block or its share of the distinct chunks. A document is
    worked on by one task; a longer one than ``block_bytes`` is a block of its own.

    Null texts are empty and have no ids; a null doc_id stays null; rows that repeat each give a row; an empty table gives
    none; other columns are not read. Raises ValueError for a model whose pieces may cross from a character to a marker.
    """
    with open(model_file, "rb") as file:
        model = file.read()
    check_model(load_model(model))
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    cut = _bucketed(given.mapInArrow(_cut(buckets, block_bytes), CUT), buckets)
    answers = cut.where("bucket >= 0").repartition(buckets, "bucket").mapInArrow(_segment(model), CUT)
    streams = cut.where("bucket < 0")
    return streams.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_join_back(piece_texts(load_model(model))), ENCODED)


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows as files in the shared folder, dealt by block, so that what meets them by block is all that moves."""
    spark, name = rows.sparkSession, f"pieces_{uuid.uuid4().hex}"
    rows.write.option("path", scratch_path(spark, "pieces")).bucketBy(buckets, "block").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")  # the files stay
    return table
