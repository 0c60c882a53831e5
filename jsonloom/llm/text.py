"""Words, their hashes and shingles over the byte buffers of Arrow string columns.

Everything works on whole buffers with numpy, in pieces of some hundred kilobytes that end at document ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text that are worked on at once; a longer document is a piece of its own
PIECE = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.random.default_rng(11).integers(0, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_VALUES = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]

#: bytes that end a word
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: the same and all ASCII bytes that are neither letters nor digits
MARKS = np.zeros(256, bool)
MARKS[:128] = True
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_ODD ** i and its inverse, modulo 2 ** 64, for i < n."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_ODD), -1, 2**64))
        for k, base in enumerate((_ODD, inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the ``n + 1`` offsets of its texts; null texts are empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, bytes, offsets`` of runs of texts that hold about PIECE bytes."""
    body, at = buffer(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        yield first, last, body[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(body: np.ndarray, at: np.ndarray, ends: np.ndarray = SPACES, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words (A-Z as a-z when ``fold``), and the ``n + 1`` offsets of the texts' words."""
    inside = ~ends[body]
    n = len(body)
    if not n or not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(at), np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _VALUES)[body] * power[:n], out=sums[1:])
    hashes = mixed((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    return starts, stops, hashes, np.searchsorted(starts, at, "left")


def grams(hashes: np.ndarray, at: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and the offsets of the texts' runs, in text order.

    ``short``: a text with fewer words, but at least one, has one run of all its words.
    """
    counts = np.diff(at)
    runs = np.maximum(counts - n + 1, 0)
    if short:
        runs = np.where((counts > 0) & (runs == 0), 1, runs)
    out_at = np.concatenate(([0], np.cumsum(runs)))
    if not out_at[-1]:
        return np.zeros(0, np.uint64), out_at
    begin = np.repeat(at[:-1] - out_at[:-1], runs) + np.arange(out_at[-1])
    length = np.repeat(np.minimum(counts, n), runs)
    total = length.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for k in range(n):
        has = length > k
        if has.all():
            total += hashes[begin + k] * _MULTIPLIERS[k]
        else:
            total[has] += hashes[begin[has] + k] * _MULTIPLIERS[k]
    return mixed(total), out_at


def pairs(hashes: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word pairs that have ``gap - 1`` words between them, and the text each is of."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if len(hashes) <= gap:
        return np.zeros(0, np.uint64), owner[:0]
    both = owner[:-gap] == owner[gap:]
    left, right = hashes[:-gap][both], hashes[gap:][both]
    return mixed(left * _MULTIPLIERS[0] + right * _MULTIPLIERS[1] + _MULTIPLIERS[8 + gap]), owner[:-gap][both]
