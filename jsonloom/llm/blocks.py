"""Rows of a partition gathered into blocks of bounded text, and Arrow tables as single binary cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text in a block; a longer document is a block of its own
BLOCK = 16_000_000


def text_blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.Table]:
    """The rows as tables of at most ``size`` bytes of the column ``text`` (one row, if that is longer); null texts are empty."""
    held, held_bytes = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text").cast(pa.large_string()).fill_null("")
        batch = batch.set_column(batch.schema.get_field_index("text"), "text", text)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        first, before = 0, 0
        while first < batch.num_rows:
            last = max(int(np.searchsorted(ends, before + size - held_bytes, "right")), first + (not held))
            if last > first:
                held.append(batch.slice(first, last - first))
                held_bytes += int(ends[last - 1]) - before
                first, before = last, int(ends[last - 1])
            if first < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def packed(table: pa.Table) -> bytes:
    """The table as one compressed binary value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all().combine_chunks()


def offsets(lengths: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
