"""Codes of vectors from codebooks that member-resident Lloyd rounds train.

A vector is cut into equal parts; each part position has a codebook. Parts live where their entry's owner is: they are dealt
once by (position, entry, salt) and written there. A round's owners add up the parts that live with them; then every
part looks for its nearest entry where it lies, and only those that change entry are sent on, to their new owner. A file of
residents is never rewritten: a part has left it once one of the later codebooks gave it another entry, which its file's
readers see from the codebooks, so a round moves nothing but its movers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: components of a greater size (after scaling) count as non-finite, so that all sums are exact in 64 bits
LARGEST = 2**26
#: parts that live with one owner, about
RESIDENTS = 1_000_000
#: rows worked on at once
ROWS = 4096

Codebooks = list[np.ndarray]  # per position, (entries, width) int64


def components(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integer components floor(SCALE * x)."""
    flat = np.asarray(vectors.flatten().cast(pa.float64()))
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties to the lower) of each part, and its squared distance; exact."""
    entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    small = max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)) < 2**20
    for first in range(0, len(parts), ROWS):
        some = parts[first : first + ROWS]
        if small:
            # whole numbers below 2 ** 53: the products are exact in doubles
            kind = some.astype(np.float64)
            far = ((book * book).sum(1) - 2 * (kind @ book.T.astype(np.float64))).astype(np.int64) + (some * some).sum(1)[:, None]
        else:
            far = np.zeros((len(some), len(book)), np.int64)
            for j in range(some.shape[1]):
                far += (some[:, j, None] - book[None, :, j]) ** 2
        best = far.argmin(1)
        entry[first : first + ROWS] = best
        error[first : first + ROWS] = far[np.arange(len(some)), best]
    return entry, error


def kept_vectors(rows: DataFrame, vector: str, parts: int) -> tuple[DataFrame, int]:
    """Rows with a usable vector as ``vec_id, label, vec``, and its width: the commonest that ``parts`` divides, then the smallest."""
    vec = F.col(vector).cast("array<double>")
    sound = F.forall(vec, lambda x: F.coalesce((F.abs(x) * SCALE < LARGEST) & ~F.isnan(x), F.lit(False)))
    given = rows.select(
        rows["vec_id"].cast("bigint").alias("vec_id"), rows["label"].cast("bigint").alias("label"), rows[vector].alias(vector)
    ).where(F.col(vector).isNotNull() & sound & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    widths = given.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = widths.width if widths else parts
    return given.where(F.size(vector) == width).withColumnRenamed(vector, "vec"), width


def first_codebooks(kept: DataFrame, width: int, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of the smallest ids (null last; equal ids by their components)."""
    first = kept.select("vec_id", "vec").orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
    if not first:
        return []
    whole = components(pa.array([r.vec for r in first], pa.list_(pa.float64())), width)
    return [np.ascontiguousarray(p) for p in np.split(whole, parts, axis=1)]


def _settle(books: Codebooks, width: int):
    """Vectors as parts with their nearest entries."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                whole = components(some.column("vec"), width)
                for position, cut in enumerate(np.split(whole, parts, axis=1)):
                    entry, _ = nearest(cut, books[position])
                    yield _part_rows(np.full(len(cut), position), entry, cut, None, some.column("salt").to_numpy())

    return run


def _part_rows(position: np.ndarray, entry: np.ndarray, cut: np.ndarray, left: np.ndarray | None, salt: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cut) + 1, dtype=np.int32) * cut.shape[1]), pa.array(cut.ravel().astype(np.int32)))
    columns = {"position": pa.array(position, pa.int32()), "entry": pa.array(entry, pa.int32())}
    if left is not None:
        columns["left"] = pa.array(left, pa.int32())
    columns |= {"salt": pa.array(salt, pa.int32()), "part": lists}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _movers(history: list[Codebooks]):
    """Parts that live here under the earlier codebooks of ``history`` and change entry under its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            position, entry = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
            part = np.asarray(batch.column("part").flatten(), np.int64).reshape(batch.num_rows, -1)
            salt = batch.column("salt").to_numpy()
            for p in np.unique(position):
                here = np.flatnonzero(position == p)
                for books in history[:-1]:
                    here = here[nearest(part[here], books[p])[0] == entry[here]]
                now, _ = nearest(part[here], history[-1][p])
                moves = now != entry[here]
                here, now = here[moves], now[moves]
                if len(here):
                    yield _part_rows(position[here], now, part[here], entry[here], salt[here])

    return run


@dataclass
class Codes:
    """Final codebooks, and the function that writes codes with them."""

    width: int
    books: Codebooks

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()


def train(kept: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codebooks after ``rounds`` rounds of Lloyd over all parts of all kept vectors."""
    books = first_codebooks(kept, width, parts, entries)
    if not books or not rounds:
        return Codes(width, books)
    spark = kept.sparkSession
    n = kept.count()
    # a third of all parts may share one entry; salted, its owners hold no more than others
    salts = -(-n // RESIDENTS)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    step = width // parts
    salted = kept.select("vec", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(salts)).cast("int").alias("salt"))
    home = ("position", "entry", "salt")
    settled = salted.mapInArrow(_settle(books, width), "position int, entry int, salt int, part array<int>")
    residents: list[tuple[DataFrame, list[Codebooks]]] = [(cut_lineage(settled.repartition(owners, *home)), [])]

    def sums(rows: DataFrame, entry: str) -> dict[tuple[int, int], np.ndarray]:
        """Count and component sums of the parts of each entry: at most parts * entries rows."""
        added = [F.sum(F.col("part")[j].cast("bigint")).alias(f"s{j}") for j in range(step)]
        return {(r[0], r[1]): np.array(r[2:], object) for r in rows.groupBy("position", entry).agg(F.count("*"), *added).collect()}

    totals = sums(residents[0][0], "entry")
    for k in range(rounds):
        if k:
            # the residents that stay are in the totals already: add who came, take off who left
            came = residents[-1][0]
            for change, sign in ((sums(came, "entry"), 1), (sums(came, "left"), -1)):
                for key, value in change.items():
                    totals[key] = totals.get(key, 0) + sign * value
        books = [book.copy() for book in books]
        for (position, entry), (count, *added) in totals.items():
            if count:
                books[position][entry] = [int(s) // int(count) for s in added]
        if k + 1 == rounds:
            break
        moved = None
        for rows, history in residents:
            history.append(books)
            some = rows.select("position", "entry", "salt", "part").mapInArrow(_movers(list(history)), "position int, entry int, left int, salt int, part array<int>")
            moved = some if moved is None else moved.unionAll(some)
        residents.append((cut_lineage(moved.repartition(owners, *home)), []))
    return Codes(width, books)


def _write_codes(codes: Codes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                whole = components(some.column("vec"), codes.width)
                error, text = np.zeros(len(whole), np.int64), np.zeros((len(whole), len(codes.books)), np.uint8)
                for position, cut in enumerate(np.split(whole, len(codes.books), axis=1)):
                    entry, far = nearest(cut, codes.books[position])
                    text[:, position] = entry
                    error += far
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.array([t.tobytes().hex() for t in text], pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the sum over the rows of equal labels (nulls together).

    A label of more than a thousandth of all rows meets its sum by broadcast, of at most 1,000 rows; the others meet it in a shuffle.
    """
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"), F.count("*").alias("rows"))
    sums = cut_lineage(sums)
    n = sums.agg(F.sum("rows")).first()[0] or 0
    common = sums.where(F.col("rows") * 1000 > n).select(F.col("label").alias("l"), "label_error")
    rare = sums.where(F.col("rows") * 1000 <= n).select(F.col("label").alias("l"), "label_error")
    met = coded.join(F.broadcast(common), coded["label"].eqNullSafe(common["l"]), "left")
    near = met.where("label_error is not null").drop("l")
    far = met.where("label_error is null").drop("l", "label_error")
    return near.unionByName(far.join(rare, far["label"].eqNullSafe(rare["l"])).drop("l"))


def encode_vectors(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codes]:
    """``vec_id, label, code, error, label_error`` of each kept row, and the codebooks.

    Dropped are rows whose vector is null, empty, holds null or non-finite components or components whose size times SCALE
    is LARGEST or more, or whose length is not the table's (the commonest multiple of ``parts``, then the smallest).
    Rows that repeat an id are coded each; a null id counts as the largest; a table with fewer than ``entries`` kept rows has
    smaller codebooks; an empty one gives no rows. Other columns are not read. Codes are two hex digits a part
    (``entries`` up to 256). What reaches the driver are the first ``entries`` vectors and the sums of all entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    kept, width = kept_vectors(rows, vector, parts)
    codes = train(kept, width, parts, entries, rounds)
    if not codes.books:
        return kept.sparkSession.createDataFrame([], "vec_id bigint, label bigint, code string, error bigint, label_error bigint"), codes
    coded = cut_lineage(kept.mapInArrow(_write_codes(codes), "vec_id bigint, label bigint, code string, error bigint"))
    return with_label_error(coded), codes
