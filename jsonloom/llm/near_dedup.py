"""Near duplicates: banded MinHash candidates, odd sketches, exact shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from jsonloom.llm import text as T
from jsonloom.llm.components import components
from jsonloom.session import cut_lineage

SHINGLE = 5
#: a link needs 100 * intersection >= SIMILARITY * union
SIMILARITY = 75
#: bands of ROWS MinHashes each: a pair at the threshold shares none with probability (1 - 0.75 ** 3) ** 32 = 2.4e-8
BANDS, ROWS = 32, 3
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: documents of a bucket or cluster that one task holds; larger ones are dealt in blocks, and pairs of blocks compared
BLOCK = 512
#: rows of candidate buckets that a task looks at together
ROWS_AT_ONCE = 20_000
#: candidates from which on a set is held against its whole block
MANY = 8
#: bits of the filter that keeps texts of documents without candidates from being shuffled; it lets some through
FILTER_BITS = 1 << 26

_rng = np.random.default_rng(5)
_FACTORS = (_rng.integers(0, 2**63, SAMPLES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_BAND = (_rng.integers(0, 2**63, ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def sketch_limit() -> float:
    """Most differing sketch bits of a pair at the threshold: the mean and 6 standard deviations.

    Of SAMPLES MinHashes a share of 1 - J differs, and each difference puts two elements into the symmetric difference
    of the two folded sets; d elements set n / 2 * (1 - exp(-2 d / n)) of n parity bits in the mean.
    """
    n, miss = SKETCH_BITS, 1 - SIMILARITY / 100
    d, spread = 2 * SAMPLES * miss, 2 * np.sqrt(SAMPLES * miss * (1 - miss))
    mean = n / 2 * (1 - np.exp(-2 * d / n))
    noise = np.sqrt(n / 4 * (1 - np.exp(-4 * d / n)) + (spread * np.exp(-2 * d / n)) ** 2)
    return mean + 6 * noise


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of texts: the first one's place and each one's sorted distinct shingle hashes."""
    for first, last, body, at in T.pieces(column):
        _, _, hashes, word_at = T.words(body, at)
        shingles, cut = T.grams(hashes, word_at, SHINGLE, short=True)
        yield first, [np.unique(shingles[cut[i] : cut[i + 1]]) for i in range(last - first)]


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """The SAMPLES minima of every set; sets are not empty."""
    flat = np.concatenate(sets)
    cut = np.concatenate(([0], np.cumsum([len(x) for x in sets])))[:-1]
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        h = flat * _FACTORS[k] + _SHIFTS[k]
        h ^= h >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(h, cut)
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """MinHash samples folded into parity bitmaps, packed."""
    n = len(minima)
    bit = (T.mixed(minima + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    counts = np.bincount((np.arange(n)[:, None] * SKETCH_BITS + bit).ravel(), minlength=n * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, text, text_a, text_b -> row, doc_id, text_a, text_b, n_shingles, set_a, set_b (a digest of the set), bands, sketch."""
    for batch in batches:
        for first, sets in shingle_sets(batch.column(2)):
            n = len(sets)
            sizes = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(sizes)
            digests, bands, sketches = np.zeros((n, 2), np.uint64), [None] * n, [None] * n
            if len(full):
                some = [sets[i] for i in full]
                flat, cut = np.concatenate(some), np.concatenate(([0], np.cumsum(sizes[full])))[:-1]
                digests[full, 0] = np.add.reduceat(T.mixed(flat), cut)
                digests[full, 1] = np.add.reduceat(T.mixed(flat + np.uint64(77)), cut)
                minima = minhashes(some)
                keys = T.mixed((minima.reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _FACTORS[0])
                packed = odd_sketches(minima)
                for j, i in enumerate(full):
                    bands[i], sketches[i] = keys[j].view(np.int64), packed[j].tobytes()
            part = batch.slice(first, n)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in (0, 1, 3, 4)), pa.array(sizes), pa.array(digests[:, 0].view(np.int64)), pa.array(digests[:, 1].view(np.int64)),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["row", "doc_id", "text_a", "text_b", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )


def block_pairs(rows: DataFrame, key: str, member: str) -> DataFrame:
    """``rows`` with ``n`` (rows of the key) dealt to pairs of blocks: adds ``first`` and ``second``.

    Two rows of a key meet in at least one pair. A key with up to BLOCK rows has the one pair (0, 0).
    """
    return (
        rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64(member, key), F.col("blocks")).cast("int"))
        .withColumn("against", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumns({"first": F.least("block", "against"), "second": F.greatest("block", "against")})
        .drop("blocks", "against")
    )


class Forest:
    """Union-find over 0 .. n - 1 whose labels can be read as an array."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def labels(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return above
            self.up = above


def similar_sizes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= SIMILARITY * np.maximum(a, b)


def sketch_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """band, first, second, id, n_shingles, sketch, in this order -> a, b: a spanning forest of the pairs of a block
    pair whose sketches differ in few enough bits. Only whole groups are worked on, about ROWS_AT_ONCE rows at once."""
    limit, held, rows = sketch_limit(), [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ROWS_AT_ONCE:
            got = pa.Table.from_batches(held)
            starts = np.flatnonzero(group_starts(got))
            if len(starts) > 1:
                yield from _forest(got.slice(0, starts[-1]), limit)
                held, rows = got.slice(starts[-1]).combine_chunks().to_batches(), got.num_rows - int(starts[-1])
    if rows:
        yield from _forest(pa.Table.from_batches(held), limit)


def group_starts(rows: pa.Table) -> np.ndarray:
    new = np.ones(rows.num_rows, bool)
    keys = [rows.column(c).to_numpy() for c in ("band", "first", "second")]
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _forest(rows: pa.Table, limit: float) -> list[pa.RecordBatch]:
    starts = np.flatnonzero(group_starts(rows))
    after = np.repeat(np.append(starts[1:], rows.num_rows), np.diff(np.append(starts, rows.num_rows))) - np.arange(rows.num_rows)
    ids, at = np.unique(rows.column("id").to_numpy(), return_inverse=True)
    sizes = rows.column("n_shingles").to_numpy()
    bits = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
    forest, left, right, label = Forest(len(ids)), [], [], np.arange(len(ids))
    for d in range(1, int(after.max())):
        i = np.flatnonzero(after > d)
        i = i[(label[at[i]] != label[at[i + d]]) & similar_sizes(sizes[i], sizes[i + d])]
        i = i[np.bitwise_count(bits[i] ^ bits[i + d]).sum(axis=1) <= limit]
        for a, b in zip(at[i].tolist(), at[i + d].tolist(), strict=True):
            if forest.join(a, b):
                left.append(ids[a])
                right.append(ids[b])
        if len(i):
            label = forest.labels()
    return [pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])]


def exact_links(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of one block pair -> a, b: a spanning forest of the pairs whose sets are similar enough.

    Pairs that are connected already need no check. A set with many candidates is held against all rows in one pass.
    """
    limit, n = sketch_limit(), len(rows)
    rows = rows.sort_values("id", kind="stable")
    ids, sets = rows["id"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
    sizes = np.array([len(x) for x in sets])
    bits = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(n, -1)
    cut = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    flat, vocabulary, forest, found = None, 0, Forest(n), []
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        label = forest.labels()
        j = j[(label[j] != label[i]) & similar_sizes(sizes[j], sizes[i])]
        j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1) <= limit]
        if len(j) > MANY:
            if flat is None:
                flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
                vocabulary = int(flat.max()) + 1
            has = np.zeros(vocabulary, np.int32)
            has[flat[cut[i] : cut[i] + sizes[i]]] = 1
            both = np.add.reduceat(has[flat], cut)[j]
        else:
            both = np.array([len(np.intersect1d(sets[i], sets[k], assume_unique=True)) for k in j], np.int64)
        for k in j[100 * both >= SIMILARITY * (sizes[i] + sizes[j] - both)].tolist():
            if forest.join(i, k):
                found.append((ids[i], ids[k]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def hashed_bit(column: str):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("bigint")


def text_key() -> list[Column]:
    """128 bits that name a text wherever and however often it is read; no place in a plan does."""
    return [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(1), F.col("text")).alias("text_b")]


def id_filter(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap of FILTER_BITS hashed text keys, as its words that are not 0: at most FILTER_BITS / 64 of them."""
    rows = (
        texts.select(hashed_bit("text_a").alias("at")).select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    )
    return np.array([r.word for r in rows], np.int64), np.array([r.bits for r in rows], np.int64)


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: ``row, doc_id, n_shingles, component_id, kept``; ``row`` tells the rows of this result apart.

    1. One pass over the texts gives each document its set size, a 128-bit digest of its set, BANDS band keys and an odd
       sketch. Documents with equal sets become one member, so a group of copies of any size is one row from here on.
    2. Members that share a band are compared by sketches: the XOR's population count estimates how many MinHashes
       differ, and pairs that even six standard deviations cannot bring to the threshold are no candidates. A task
       gives a spanning forest, never all pairs; a bucket of over BLOCK members is dealt in pairs of blocks.
    3. The components of these forests are clusters: a linked pair is always in one. Only members of clusters have their
       sets built again (a second pass over the texts, which meets the first by a hash of each text; a bitmap lets the others
       go) and compared exactly, in pairs of blocks again. The forests of confirmed links give the classes.

    A pair at exactly 0.75 is missed by the bands with probability 2.4e-8; the sketches' 6 deviations add about 1e-9.
    Null and empty texts have no shingles and are linked with nothing. ``component_id`` is the smallest doc_id of the
    class; documents without id have none and come last. Of repeated rows with the class's smallest id exactly one is
    kept; a text without shingles is always kept. An empty table gives no rows; other columns are not read.
    """
    return _classified(docs).drop("text_a", "text_b")


def _classified(docs: DataFrame) -> DataFrame:
    """:func:`near_dedup` with the keys of the texts."""
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text", *text_key())
    signed = cut_lineage(
        source.mapInArrow(
            signatures, "row bigint, doc_id bigint, text_a bigint, text_b bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch binary"
        )
    )
    shingled = signed.where("n_shingles > 0")
    key = ["n_shingles", "set_a", "set_b"]
    members = shingled.groupBy(*key).agg(
        F.min("row").alias("id"), F.min("doc_id").alias("least_doc"), F.min_by("bands", "row").alias("bands"), F.min_by("sketch", "row").alias("sketch"),
        F.min_by("text_a", "row").alias("text_a"), F.min_by("text_b", "row").alias("text_b"),
    )
    members = cut_lineage(members)
    bands = members.select("id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    buckets = bands.join(shared, "band").join(members.select("id", "n_shingles", "sketch"), "id")
    close = (
        block_pairs(buckets, "band", "id")
        .select("band", "first", "second", "id", "n_shingles", "sketch")
        .repartition("band", "first", "second")
        .sortWithinPartitions("band", "first", "second", "id")
        .mapInArrow(sketch_links, "a bigint, b bigint")
    )
    clusters = cut_lineage(components(close))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    clustered = clusters.join(sizes, "root").withColumnRenamed("node", "id")

    asked = clustered.join(members.select("id", "sketch", "text_a", "text_b"), "id")
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(asked))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        bits[wanted.value[0]] = wanted.value[1]
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            batch = batch.filter(pa.array((bits[bit >> 6] >> (bit & 63)) & 1 == 1))
            keys = list(zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True))
            # of copies one is enough
            first_ones = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
            batch = batch.take(pa.array(first_ones, pa.int64()))
            for first, found in shingle_sets(batch.column("text")):
                part = batch.slice(first, len(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("text_a"), part.column("text_b"), pa.array([x.tobytes() for x in found], pa.binary())], ["text_a", "text_b", "shingles"]
                )

    again = docs.select("text", *text_key()).withColumn("bit", hashed_bit("text_a")).mapInArrow(sets, "text_a bigint, text_b bigint, shingles binary")
    full = again.dropDuplicates(["text_a", "text_b"]).join(asked, ["text_a", "text_b"])
    links = (
        block_pairs(full, "root", "id")
        .select("root", "first", "second", "id", "sketch", "shingles")
        .groupBy("root", "first", "second")
        .applyInPandas(exact_links, "a bigint, b bigint")
    )
    classes = components(links)
    rooted = members.join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        *key, F.coalesce("root", "id").alias("root"), "least_doc"
    )
    names = rooted.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    named = rooted.join(names, "root").select(*key, "component_id")
    text = ["text_a", "text_b"]
    placed = shingled.select("row", "doc_id", *text, *key).join(named, key).select("row", "doc_id", *text, "n_shingles", "component_id")
    owners = (
        placed.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id").agg(F.min("row").alias("owner")).withColumnRenamed("component_id", "named")
    )
    return _with_owner(placed, owners).unionAll(
        signed.where("n_shingles = 0").select("row", "doc_id", *text, "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    )


def _with_owner(placed: DataFrame, owners: DataFrame) -> DataFrame:
    return placed.join(owners, placed["component_id"].eqNullSafe(owners["named"]), "left").select(
        "row", "doc_id", "text_a", "text_b", "n_shingles", "component_id", (F.col("row") == F.col("owner")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, in their own columns, whatever these are.

    The rows meet what was found by doc_id and text, so the table may be read in another way the second time. Of rows equal
    in both of which one stays, it is the one with the smallest hash of all columns, or one of rows equal in all. Rows
    without id or text, empty texts, repeated rows and empty tables are as in ``near_dedup``. Only rows that the bitmap of
    texts with dropped rows cannot tell from these are shuffled.
    """
    key = ["_doc", "text_a", "text_b"]
    found = _classified(docs).groupBy(F.col("doc_id").alias("_doc"), "text_a", "text_b").agg(F.count_if("kept").alias("stay"), F.count("*").alias("rows"))
    partly = cut_lineage(found.where("stay < rows"))
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(partly))
    rows = docs.select(F.struct("*").alias("document"), F.col("doc_id").cast("bigint").alias("_doc"), *text_key())
    given = rows.select("document", *key, hashed_bit("text_a").alias("bit"))
    schema = StructType([*given.schema.fields[:4], StructField("maybe", BooleanType())])

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        bits[wanted.value[0]] = wanted.value[1]
        for batch in batches:
            bit = batch.column(4).to_numpy()
            maybe = pa.array((bits[bit >> 6] >> (bit & 63)) & 1 == 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), maybe], ["document", *key, "maybe"])

    flagged = given.mapInArrow(flag, schema)
    unsure = flagged.where("maybe")
    there = partly.select(*[F.col(c).alias(f"found{c}") for c in key], "stay")
    met = unsure.join(there, [unsure[c].eqNullSafe(F.col(f"found{c}")) for c in key], "left")
    one = Window.partitionBy(*key).orderBy(F.xxhash64(F.to_json("document")))
    single = met.where("stay = 1").withColumn("rank", F.row_number().over(one)).where("rank = 1")
    parts = [flagged.where("not maybe"), met.where("stay is null"), single]
    return parts[0].select("document.*").unionAll(parts[1].select("document.*")).unionAll(parts[2].select("document.*"))
