"""Shred JSON files that are too large for one task.

A large file is read by byte ranges that end at commas and kept as chunks of text. What a chunk does to its place in the
document (inside a string or not, how deep) is summed up for both ways it may begin, and prefix sums over the chunks'
summaries, which are small, tell where each really begins. Then every chunk cuts itself at the commas between entries and
between the members of a list; only pieces that go over a chunk's end move, to be put together. No task holds more than a
chunk, one record, or a document's summaries.

The text is written once, compressed, and otherwise stays where it lies: the summaries go to the chunks, which are cut once to
judge a document and once more for its rows. So beside the files the steps need disk for that one copy.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jsonloom.functions.json_values import TEXT_RULES, is_json, one_object
from jsonloom.operators.shred import DOCUMENT, QUARANTINE, numbered, shred
from jsonloom.session import cut_lineage
from jsonloom.sources.documents import DOC_POSITION, file_order, list_files, read_documents

# what runs in tasks travels with them, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: files above this size are read by several tasks
LARGE_FILE = 32 * 2**20
#: bytes of text in a chunk, about
CHUNK = 2**20
#: the one copy of the text is small, and read some chunks at a time: Spark holds a row group's texts, and those of 100 rows at least
#: were Parquet's own rule
_STORED = {"compression": "zstd", "parquet.block.size": str(8 * CHUNK), "parquet.page.size.row.check.min": "8"}
#: a broken document's text is kept up to this size; a row cannot hold much more
KEPT_TEXT = 2**30

_QUOTE, _ESCAPE, _COMMA = 0x22, 0x5C, 0x2C
_STEP = np.zeros(256, np.int8)
_STEP[[0x7B, 0x5B]], _STEP[[0x7D, 0x5D]] = 1, -1
_SPECIAL = _STEP != 0
_SPECIAL[[_QUOTE, _COMMA]] = True
# a key that reads "data", also with its letters escaped, and the first character of its value
_DATA = re.compile(rb'"(?:d|\\u0064)(?:a|\\u0061)(?:t|\\u0074)(?:a|\\u0061)"\s*:\s*(.?)', re.S)

_CHUNKS = "file bigint, block_start bigint, k bigint, text binary, bytes bigint, odd boolean, parity int, d0 bigint, d1 bigint"
_FACTS = "file bigint, no bigint, o2 string, o3 string, first1 bigint, datas array<struct<at: bigint, object: boolean, next: bigint>>"
_PIECES = (
    "file bigint, no bigint, at bigint, of bigint, starts boolean, complete boolean, inside boolean, entry boolean, opened boolean,"
    " leads boolean, last boolean, enveloped boolean, head binary, body binary, tail binary"
)


class Lexed:
    """Structure of a chunk that begins inside a string (``quoted``) or not, ``depth`` deep."""

    def __init__(self, text: bytes, quoted: int = 0, depth: int = 0):
        data = np.frombuffer(text, np.uint8)
        at = np.flatnonzero(_SPECIAL[data])
        kind = data[at]
        quotes = kind == _QUOTE
        if _ESCAPE in text:
            # a quote after an odd number of escape characters is one of the string's own
            place = np.arange(len(data))
            last = np.maximum.accumulate(np.where(data != _ESCAPE, place, -1))
            before = np.where(at > 0, last[np.maximum(at - 1, 0)], -1)
            quotes &= (at - 1 - before) % 2 == 0
        passed = np.cumsum(quotes)
        self.parity = int(quotes.sum()) & 1
        outside = ((passed - quotes + quoted) & 1) == 0
        steps = _STEP[kind]
        step = np.where(outside, steps, 0).astype(np.int64)
        opens, closes = step > 0, step < 0
        structural = (quotes | (kind != _QUOTE)) & outside
        self.depth_after = depth + np.cumsum(step)[structural]
        self.end_depth = depth + int(step.sum())
        #: where it ends if it begins the other way, inside a string or not
        self.other_end_depth = depth + int(steps.sum(dtype=np.int64)) - int(step.sum())
        self.at, self.kind = at[structural], kind[structural]
        self.opens, self.closes, self.comma = opens[structural], closes[structural], (kind == _COMMA)[structural]
        # quotes that begin a string
        self.string = (self.kind == _QUOTE) & ~self.comma

    def holder(self, depth: int, before: str | None) -> np.ndarray:
        """For each structural character, what opened the innermost thing at ``depth`` so far (0: nothing)."""
        here = np.where(self.opens & (self.depth_after == depth), np.arange(len(self.at)), -1)
        last = np.maximum.accumulate(here) if len(here) else here
        return np.where(last >= 0, self.kind[np.maximum(last, 0)], ord(before) if before else 0)


_CHUNK_SCHEMA = pa.schema(
    [
        ("file", pa.int64()), ("block_start", pa.int64()), ("k", pa.int64()), ("text", pa.binary()), ("bytes", pa.int64()),
        ("odd", pa.bool_()), ("parity", pa.int32()), ("d0", pa.int64()), ("d1", pa.int64()),
    ]
)


def _ends_odd(text: bytes) -> bool:
    return (len(text) - len(text.rstrip(b"\\"))) % 2 == 1


def _chunked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now, held_bytes, k = None, 0, 0

        def flush() -> pa.RecordBatch:
            text = b",".join(held)
            lexed = Lexed(text)
            row = dict(zip(("file", "block_start"), now)) | {
                "k": k, "text": text, "bytes": len(text), "odd": _ends_odd(text), "parity": lexed.parity, "d0": lexed.end_depth,
                "d1": lexed.other_end_depth,
            }
            return pa.RecordBatch.from_pylist([row], schema=_CHUNK_SCHEMA)

        for batch in batches:
            files, split = (batch.column(n).to_numpy() for n in ("file", "block_start"))
            text = batch.column("text").cast(pa.large_binary())
            lengths = pc.binary_length(text).to_numpy(zero_copy_only=False) + 1
            place = np.zeros(batch.num_rows, np.int64)
            same = np.append(False, (split[1:] == split[:-1]) & (files[1:] == files[:-1])) if batch.num_rows else place.astype(bool)
            ends = np.cumsum(lengths)
            first = 0
            while first < batch.num_rows:
                own = (int(files[first]), int(split[first]))
                run_end = first + 1 + int(np.argmax(np.append(~same[first + 1 :], True)))
                if own != now:
                    if held:
                        yield flush()
                    held, held_bytes, now, k = [], 0, own, 0
                before = int(ends[first - 1]) if first else 0
                last = min(run_end, max(first + 1, int(np.searchsorted(ends, before + size - held_bytes, "right"))))
                some = text.slice(first, last - first)
                listed = pa.LargeListArray.from_arrays(pa.array([0, len(some)], pa.int64()), some)
                held.append(pc.binary_join(listed, pa.scalar(b",", pa.large_binary()))[0].as_py())
                held_bytes += int(ends[last - 1]) - before
                first = last
                if held_bytes >= size:
                    yield flush()
                    held, held_bytes, k = [], 0, k + 1
        if held:
            yield flush()

    return run


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dicts; only one chunk's text is copied at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk: what opened depths 2 and 3 last, its first comma at depth 1, and entries of depth 1 named data."""
    for batch in batches:
        for row in one_by_one(batch):
            lexed = Lexed(row["text"], row["quoted"], row["depth"])
            opened = {}
            for depth in (2, 3):
                here = np.flatnonzero(lexed.opens & (lexed.depth_after == depth))
                opened[depth] = chr(lexed.kind[here[-1]]) if len(here) else None
            commas = lexed.at[lexed.comma & (lexed.depth_after == 1)]
            # the comma before the chunk is at its place -1
            edge = row["no"] > 1 and not row["quoted"] and row["depth"] == 1
            keys = set(lexed.at[lexed.string & (lexed.depth_after == 1)].tolist())
            datas = []
            for found in _DATA.finditer(row["text"]):
                if found.start() in keys:
                    after = commas[commas > found.start()]
                    datas.append({"at": found.start(), "object": found.group(1) == b"{", "next": int(after[0]) if len(after) else None})
            yield pa.RecordBatch.from_pylist(
                [{"file": row["file"], "no": row["no"], "o2": opened[2], "o3": opened[3], "first1": -1 if edge else int(commas[0]) if len(commas) else None, "datas": datas}],
                schema=pa.schema([
                    ("file", pa.int64()), ("no", pa.int64()), ("o2", pa.string()), ("o3", pa.string()), ("first1", pa.int64()),
                    ("datas", pa.list_(pa.struct([("at", pa.int64()), ("object", pa.bool_()), ("next", pa.int64())]))),
                ]),
            )


_PIECE_SCHEMA = pa.schema(
    [
        ("file", pa.int64()), ("no", pa.int64()), ("at", pa.int64()), ("of", pa.int64()), ("starts", pa.bool_()), ("complete", pa.bool_()),
        ("inside", pa.bool_()), ("entry", pa.bool_()), ("opened", pa.bool_()), ("leads", pa.bool_()), ("last", pa.bool_()),
        ("enveloped", pa.bool_()), ("head", pa.binary()), ("body", pa.binary()), ("tail", pa.binary()),
    ]
)


def _after(events: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each piece of text the first event in it, -1 without one."""
    if not len(events):
        return np.full(len(begins), -1)
    i = np.searchsorted(events, begins, "left")
    found = events[np.minimum(i, len(events) - 1)]
    return np.where((i < len(events)) & (found < stops), found, -1)


def _cut(row: dict) -> pa.RecordBatch:
    """The pieces of one chunk; ``at`` and ``of`` count the document's units from ``earlier``, those before the chunk."""
    text, no = row["text"], row["no"]
    base = 2 if row["enveloped"] else 1
    lexed = Lexed(text, row["quoted"], row["depth"])
    holder = lexed.holder(base + 1, row["opener"])

    def within(at):
        """Whether the object that holds the tables is around these places."""
        at = np.asarray(at, np.int64)
        if not row["enveloped"]:
            return np.ones(at.shape, bool)
        begun = at > row["s_at"] if no == row["s_no"] else np.full(at.shape, no > row["s_no"])
        if row["e_no"] is None:
            return begun
        return begun & (at < row["e_at"] if no == row["e_no"] else np.full(at.shape, no < row["e_no"]))

    inside = within(lexed.at)
    limit = np.where(inside, np.where(holder == 0x5B, base + 1, base), 1)
    cuts = np.flatnonzero(lexed.comma & (lexed.depth_after <= limit))

    def bounds(at: int, quoted: int, depth: int, last: int) -> bool:
        """Whether a comma at a chunk's edge is one to cut at."""
        return not quoted and depth <= ((base + 1 if last == 0x5B else base) if within(at) else 1)

    opener = ord(row["opener"]) if row["opener"] else 0
    first_starts = no == 1 or bounds(-1, row["quoted"], row["depth"], opener)
    last_holder = int(holder[-1]) if len(holder) else opener
    ends_whole = row["final"] or bounds(len(text), (row["quoted"] + lexed.parity) & 1, lexed.end_depth, last_holder)
    places = lexed.at[cuts]
    begins, stops = np.append(0, places + 1), np.append(places, len(text))
    n = len(begins)
    starts, complete, last = np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
    starts[0], complete[-1], last[-1] = first_starts, ends_whole, True
    depths = np.append(row["depth"] if no > 1 else 0, lexed.depth_after[cuts])
    in_brackets = np.append(opener, holder[cuts]) == 0x5B
    holds_start = (begins <= row["s_at"]) & (row["s_at"] < stops) if row["enveloped"] and row["s_no"] == no else np.zeros(n, bool)
    before = begins - 1
    before[0] = -1 if no > 1 else 0
    role = within(before) | holds_start
    entry = starts & role & (depths <= base)
    idx = np.cumsum(starts) - 1
    entry_idx = np.maximum.accumulate(np.where(entry, idx, -1))
    in_list = ~entry & role & (depths >= base + 1) & in_brackets
    opens_list = lexed.at[lexed.opens & inside & (lexed.depth_after == base + 1) & (lexed.kind == 0x5B)]
    opened = np.where(in_list | ~role, -1, _after(opens_list, begins, stops))
    body = in_list | (opened >= 0)
    body_at = np.where(in_list, begins, opened + 1)
    ends = [lexed.at[lexed.closes & (lexed.depth_after == depth)] for depth in (base, base - 1, 0)]
    object_end = np.where(role, _after(ends[1], begins, stops), _after(ends[2], begins, stops))
    tail_at = np.where(body, _after(ends[0], np.where(body, body_at, begins), stops), object_end)
    # a piece that goes on after the chunk keeps the comma there
    stops[-1] += not ends_whole
    tail_at = np.where(tail_at < 0, stops, tail_at)
    head_end = np.where(body, body_at, tail_at)
    # head, body, tail and the comma after them follow each other in the text
    edges = np.append(np.column_stack([begins, head_end, tail_at, stops]).ravel(), stops[-1]).astype(np.int32)
    parts = pa.BinaryArray.from_buffers(pa.binary(), 4 * n, [None, pa.py_buffer(edges), pa.py_buffer(text + b",")])
    head, middle, tail = (parts.take(pa.array(np.arange(i, 4 * n, 4))) for i in range(3))
    of = np.where(entry_idx >= 0, row["earlier"] + entry_idx, -1 if row["entry_before"] is None else row["entry_before"])
    leads = holds_start.copy()
    leads[0] |= no == 1
    columns = [
        np.full(n, row["file"]), np.full(n, no), row["earlier"] + idx, pa.array(of, mask=of < 0), starts, complete, role, entry, opened >= 0,
        leads, last, np.full(n, bool(row["enveloped"])), head, middle, tail,
    ]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=_PIECE_SCHEMA)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in one_by_one(batch):
            cut = _cut(row)
            for first in range(0, cut.num_rows, 10_000):
                yield cut.slice(first, 10_000)


def read_chunks(spark: SparkSession, paths: list[str], chunk: int = CHUNK) -> DataFrame:
    """The files' text by byte ranges, in chunks that end at commas, with their summaries; written once."""
    file = F.xxhash64("_metadata.file_path")
    # a row per comma: what is the same for a whole file joins the chunks, of which there are few
    raw = spark.read.format("text").option("lineSep", ",").load(paths).select(
        file.alias("file"), F.col("_metadata.file_block_start").cast("bigint").alias("block_start"), F.col("value").cast("binary").alias("text"),
    )
    given = spark.read.format("binaryFile").load(paths).select(
        file.alias("file"), F.col("_metadata.file_path").alias("path"), file_order().alias("file_order"),
        F.col("_metadata.file_size").cast("bigint").alias("file_size"),
    )
    return cut_lineage(raw.mapInArrow(_chunked(chunk), _CHUNKS), **_STORED).join(F.broadcast(cut_lineage(given)), "file")


def _located(chunks: DataFrame) -> DataFrame:
    """Summaries with where each chunk begins: its number in the file, in a string or not, how deep."""
    order = Window.partitionBy("file").orderBy("block_start", "k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    slim = chunks.select("file", "block_start", "k", "parity", "d0", "d1").withColumns(
        {
            "no": F.row_number().over(order).cast("bigint"),
            "quoted": (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).cast("int"),
            "final": F.lead("k").over(order).isNull(),
        }
    )
    step = F.when(F.col("quoted") == 0, F.col("d0")).otherwise(F.col("d1"))
    return cut_lineage(
        slim.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0)).cast("bigint")).drop("parity", "d0", "d1")
    )


def _with_texts(chunks: DataFrame, places: DataFrame) -> DataFrame:
    """Chunks with what is known of their places. A place is some 100 bytes for a chunk of text: places go to the texts."""
    return chunks.select("file", "block_start", "k", "text").join(F.broadcast(places), ["file", "block_start", "k"])


def _with_tables_object(facts: DataFrame) -> DataFrame:
    """Per chunk: whether the document has an envelope, where the object that holds the tables begins and ends, and what opened the
    depth of lists before the chunk."""
    data = facts.select("file", "no", F.explode("datas").alias("d"))
    last = data.groupBy("file").agg(F.max_by(F.struct("no", "d"), F.struct("no", "d.at")).alias("e")).where("e.d.object").select(
        F.col("file").alias("p"), F.col("e.no").alias("s_no"), F.col("e.d.at").alias("s_at"), F.col("e.d.next").alias("next")
    )
    later = facts.join(last, F.col("file") == F.col("p")).where("next is null and first1 is not null and no > s_no").groupBy("file").agg(
        F.min(F.struct("no", "first1")).alias("f")
    ).select(F.col("file").alias("q"), "f")
    ends = last.join(later, F.col("p") == F.col("q"), "left").select(
        "p", "s_no", "s_at", F.when(F.col("next").isNotNull(), F.col("s_no")).otherwise(F.col("f.no")).alias("e_no"),
        F.coalesce("next", "f.first1").alias("e_at"),
    )
    before = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    held = facts.select("file", "no", *[F.last(o, ignorenulls=True).over(before).alias(o) for o in ("o2", "o3")])
    met = held.join(ends, F.col("file") == F.col("p"), "left")
    return met.select(
        "file", "no", F.col("s_no").isNotNull().alias("enveloped"), "s_no", "s_at", "e_no", "e_at",
        F.when(F.col("s_no").isNotNull(), F.col("o3")).otherwise(F.col("o2")).alias("opener"),
    )


_PARTS = ["head", "body", "tail"]
_PLACED = ["file", "no", "at", "of", "inside", "entry", "leads", "opened", "enveloped"]


def _put_together(some: DataFrame) -> DataFrame:
    """Entries and list members that go over chunks' ends, each with the place of its first piece."""
    run = Window.partitionBy("file").orderBy("no", "at", "starts").rowsBetween(Window.unboundedPreceding, 0)
    marked = some.withColumn("_unit", F.sum(F.col("starts").cast("bigint")).over(run))
    fact = [c for c in _PLACED if c not in ("file", "opened")]
    first = F.min_by(F.struct(*fact), F.struct("no", "at")).alias("f")
    joined = [
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "at", F.col(p).alias("v")))), lambda x: x["v"]), "").alias(p)
        for p in _PARTS
    ]
    put = marked.groupBy("file", "_unit").agg(first, F.max("opened").alias("opened"), *joined)
    return put.select("file", *[f"f.{c}" for c in fact], "opened", *_PARTS).select(*_PLACED, *_PARTS)


_KEY = r'^\s*"([^"\\]*(?:\\.[^"\\]*)*)"\s*:\s*'


def bare(text) -> Column:
    """Text without the white space that JSON allows before it; blank text is empty."""
    return F.ltrim(F.translate(text, "\t\r\n", "   "))


def _member() -> Column:
    """An entry's text; before the first one stand the braces that open the document and its envelope."""
    opening = F.when(F.col("inside") & F.col("enveloped"), r'^\s*\{?\s*"[^"]*"\s*:\s*\{').otherwise(r"^\s*\{")
    return F.when(F.col("leads"), F.call_function("regexp_replace", "head", opening, F.lit(""))).otherwise(F.col("head"))


def _judged_units(units: DataFrame) -> DataFrame:
    """Units with what stands for them in a skeleton (see :func:`_skeletons`), and of entries the key and what they hold."""
    body = F.when(is_json(F.col("body")), F.lit("0")).otherwise(F.col("body"))
    alone = F.length(F.concat("head", "tail")) == 0
    short = F.when(alone, body).otherwise(F.concat("head", body, "tail"))
    is_member = ~F.col("leads") & (bare("short") != "") & one_object(F.concat(F.lit("{"), "short", F.lit("}"))).isNotNull()
    kind = F.when(alone & (F.col("short") == "0"), "V").when(is_member, "M").otherwise("S")
    kinds = units.withColumn("short", short).withColumn("kind", kind).withColumn("member", F.when(F.col("entry"), _member()))
    key = F.get(F.from_json(F.concat(F.lit('["'), F.regexp_extract("member", _KEY, 1), F.lit('"]')), "array<string>", TEXT_RULES), F.lit(0))
    return kinds.withColumns(
        {
            "short": F.when(F.col("kind") == "M", F.lit('"k":0')).otherwise(F.col("short")),
            "key": F.when(F.col("entry"), key),
            "named": F.col("entry") & (bare("member") != ""),
            "objects": F.col("entry") & bare("body").startswith("{"),
        }
    ).drop("member")


def _entries(units: DataFrame) -> DataFrame:
    """Entries of the object that holds the tables: key, kind, and their place among its keys (the last of repeated ones counts)."""
    facts = units.where("named").select("file", "of", "key", "opened", "objects")
    repeated = facts.groupBy("file", "key").agg(F.min("of").alias("place"), F.max("of").alias("last"))
    order = F.row_number().over(Window.partitionBy("file").orderBy("place")) - 1
    kept = repeated.withColumn("table_pos", order).select(F.col("file").alias("p"), F.col("key").alias("k"), "last", "table_pos")
    met = facts.join(kept, (F.col("file") == F.col("p")) & F.col("key").eqNullSafe(F.col("k")) & (F.col("of") == F.col("last")))
    return met.select(F.col("file").alias("e_file"), F.col("of").alias("e_of"), "key", "table_pos", F.col("opened").alias("listed"), "objects")


def _skeletons(units: DataFrame) -> DataFrame:
    """Per document, a short text that is JSON exactly if the document is.

    Members of lists that are JSON by themselves stand as 0, entries that are as "k":0, and of several in a row in a chunk one is left.
    ``units`` may lack whole members that are JSON by themselves: where numbers are missing stands one of these.
    """
    in_chunk = Window.partitionBy("file", "no").orderBy("at")
    marked = units.withColumn("before", F.lag("kind").over(in_chunk)).withColumn(
        "missing", F.col("at") - F.coalesce(F.lag("at").over(in_chunk), F.col("earlier") - 1) > 1
    )
    kept = marked.where("kind = 'S' or before is null or before <> kind or missing").withColumn(
        "short", F.when(F.col("missing"), F.concat(F.lit("0,"), "short")).otherwise(F.col("short"))
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "short"))), lambda s: s["short"]), ",")
    return kept.groupBy("file").agg(text.alias("skeleton"))


def shred_large(
    spark: SparkSession, paths: list[str], max_records: int | None = None, keep_rejects: bool = False, mark_documents: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """:func:`~jsonloom.operators.shred.shred` of whole-file documents, each read by as many tasks as it has byte ranges.

    The rows are those that ``shred`` gives for the same documents. Compressed files do not split. A broken document's text
    is kept if it has up to KEPT_TEXT bytes. An entry that is neither a list nor a table is one row while it is checked, as a
    record is. The steps write to the shared folder, so the call itself runs Spark jobs.
    """
    chunks = read_chunks(spark, paths, chunk)
    located = _located(chunks)
    given = ["file", "no", "quoted", "depth", "text"]
    facts = cut_lineage(_with_texts(chunks, located).select(*given).mapInArrow(_facts, _FACTS))
    places = cut_lineage(located.join(_with_tables_object(facts), ["file", "no"]))
    asked = [*given, "final", "enveloped", "s_no", "s_at", "e_no", "e_at", "opener", "earlier", "entry_before"]
    strings = {p: F.col(p).cast("string") for p in _PARTS}

    def pieces(of_chunks: DataFrame) -> DataFrame:
        return _with_texts(chunks, of_chunks).select(*asked).mapInArrow(_pieces, _PIECES).withColumns(strings)

    # a document is judged by its entries, and by what goes over chunks' ends or is no list's member that is JSON by itself
    whole = F.col("starts") & F.col("complete")
    first = _judged_units(pieces(places.withColumns({"earlier": F.lit(0).cast("bigint"), "entry_before": F.lit(None).cast("bigint")})))
    texts = {p: F.when(~whole, F.col(p)) for p in _PARTS} | {"short": F.when(whole, F.col("short")), "whole": whole}
    first = cut_lineage(first.where(~whole | F.col("entry") | F.col("last") | (F.col("kind") != "V")).withColumns(texts))
    per_chunk = first.where("last").select("file", "no", (F.col("at") + 1).alias("n"), F.col("of").alias("last_entry"))
    before = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    counted = per_chunk.select("file", "no", "last_entry", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    counted = cut_lineage(counted.select("file", "no", "earlier", F.last(F.col("earlier") + F.col("last_entry"), ignorenulls=True).over(before).alias("entry_before")))
    put = _judged_units(_put_together(first.where("not whole").select(*_PLACED, "starts", *_PARTS))).withColumn("whole", F.lit(False))
    marks = first.where("whole").select(*put.columns).unionByName(put).join(counted, ["file", "no"])
    marks = cut_lineage(
        marks.withColumns({"at": F.col("earlier") + F.col("at"), "of": F.coalesce(F.col("earlier") + F.col("of"), F.col("entry_before"))})
    )

    sizes = chunks.groupBy("file", "path", "file_order", F.col("file_size").alias("size")).agg(
        # a separator stands between chunks; one at the file's end, or a byte order mark, would be missing
        (F.sum(F.col("bytes") + 1) - 1 != F.max("file_size")).alias("cut"), F.max("odd").alias("odd"),
    )
    judged = sizes.join(_skeletons(marks), "file", "left")
    sound = one_object(F.col("skeleton")).isNotNull() & ~F.col("cut") & ~F.col("odd")
    judged = cut_lineage(judged.select("file", "path", "size", "file_order", F.coalesce(sound, F.lit(False)).alias("ok")))

    good = judged.where("ok").select(F.col("file").alias("e_file"), "path", "file_order")
    entries = cut_lineage(_entries(marks).join(good, "e_file"))
    columns = [*_PLACED, *_PARTS]
    units = pieces(places.join(counted, ["file", "no"])).where(whole).select(*columns).unionByName(marks.where("not whole").select(*columns))
    own = units.join(entries, (F.col("file") == F.col("e_file")) & (F.col("of") == F.col("e_of")))
    rec_pos = (F.col("at") - F.col("of")).cast("int")
    members = F.from_json(F.concat(F.lit("["), "body", F.lit("]")), "array<string>", TEXT_RULES)
    value, shown = F.get(members, F.lit(0)), bare("body")
    parsed = F.get(F.map_values(one_object(F.concat(F.lit("{"), _member(), F.lit("}")))), F.lit(0))
    # of a list each member is a record, of an object its entry is
    listed = F.when(F.col("objects"), value).otherwise(numbered(value, rec_pos, shown.startswith('"')))
    one_row = (F.col("at") == F.col("of")) & F.regexp_replace(_member(), _KEY, "").startswith("{")
    out = own.where(F.when(F.col("listed"), shown != "").otherwise(one_row)).select(
        "path", "file_order", F.col("key").alias("table"), "table_pos", rec_pos.alias("rec_pos"),
        F.when(F.col("listed"), listed).otherwise(parsed).alias("record"),
        (~F.col("listed") | ~F.col("objects") | shown.startswith("{")).alias("is_record"),
    )
    if max_records:
        out = out.where(F.col("rec_pos") < max_records)
    if not keep_rejects:
        return _as_records(out.where("is_record").withColumn("reason", F.lit(None))).drop("reason")
    reason = F.when(~F.col("is_record"), F.lit("record is not a JSON object"))
    broken = judged.where("not ok")
    kept = [row.path for row in broken.where(F.col("size") <= KEPT_TEXT).select("path").collect()]
    texts = read_documents(spark, kept, glob="*").select("path", F.col("text").alias("record")) if kept else spark.createDataFrame([], "path string, record string")
    failed = broken.join(texts, "path", "left").select(
        "path", "file_order", F.lit(QUARANTINE).alias("table"), F.lit(0).alias("table_pos"), F.lit(0).alias("rec_pos"), "record", F.lit("not a JSON object").alias("reason")
    )
    every = out.withColumn("reason", reason).drop("is_record").unionByName(failed)
    if mark_documents:
        marks = judged.select(
            "path", "file_order", F.lit(DOCUMENT).alias("table"), F.lit(0).alias("table_pos"), F.lit(0).alias("rec_pos"), F.lit(None).cast("string").alias("record"),
            F.lit(None).cast("string").alias("reason"),
        )
        every = every.withColumn("table_pos", F.col("table_pos") + 1).unionByName(marks)
    return _as_records(every)


def _as_records(rows: DataFrame) -> DataFrame:
    """The shredder's columns; a file is one document."""
    nothing = F.lit(0).cast("bigint")
    placed = rows.withColumns({"block_start": nothing, "line_id": nothing})
    return placed.select(*DOC_POSITION, "table", "table_pos", "rec_pos", "record", "reason")


def shred_files(
    spark: SparkSession, path: str | list[str], glob: str = "*.json", recursive: bool = False, max_records: int | None = None,
    keep_rejects: bool = False, mark_documents: bool = False, large: int = LARGE_FILE,
) -> DataFrame:
    """Records of the whole-file documents under ``path``: files up to ``large`` bytes by a task each, larger ones by several."""
    settings = {"max_records": max_records, "keep_rejects": keep_rejects, "mark_documents": mark_documents}
    found = list_files(spark, path, glob, recursive).where(F.col("length") > large)
    paths = [row.path for row in found.select("path").collect()]
    small = read_documents(spark, path, False, glob, recursive, max_bytes=large if paths else None)
    rows = shred(small, **settings)
    return rows.unionByName(shred_large(spark, paths, **settings)) if paths else rows
