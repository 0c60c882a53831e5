"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from jsonloom.llm import text as T

#: words of a seed
SEED = 4
#: alignment scores of a matching word, another word and a gap
MATCH, OTHER, GAP = 2, -1, -1
#: share of a whole copy's score from which on a document counts as contaminated
SCORE = 0.5
#: items and bytes of items in a block; each block is one broadcast and one pass over the documents
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16_000_000
#: bits of the table that sorts out most n-grams that are no seeds
FILTER_BITS = 22

MATCHES = ArrayType(
    StructType(
        [
            StructField("item_id", LongType()), StructField("score", DoubleType()), StructField("word_start", LongType()),
            StructField("word_end", LongType()), StructField("seeds", LongType()),
        ]
    )
)


@dataclass
class Items:
    """A block of items as word hashes, and its distinct n-grams with the places that have them."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray
    place_at: np.ndarray
    place_item: np.ndarray
    place_word: np.ndarray

    @staticmethod
    def of(ids: list, texts: list[str]) -> Items:
        words, grams, owners, places = [], [], [], []
        for i, text in enumerate(texts):
            body, at = T.buffer(pa.array([text], pa.string()))
            _, _, hashes, word_at = T.words(body, at, T.MARKS)
            found, _ = T.grams(hashes, word_at, SEED)
            words.append(hashes)
            grams.append(found)
            owners.append(np.full(len(found), i))
            places.append(np.arange(len(found)))
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        distinct, first = np.unique(flat[order], return_index=True)
        return Items(
            ids, words, distinct, np.append(first, len(flat)),
            np.concatenate([*owners, np.zeros(0, np.int64)])[order], np.concatenate([*places, np.zeros(0, np.int64)])[order],
        )

    def shared(self, docs: DataFrame):
        """A broadcast of the block's parts; ``Items(*value)`` in tasks."""
        return docs.sparkSession.sparkContext.broadcast(tuple(vars(self).values()))


class Finder:
    """Places of a block's n-grams in texts."""

    def __init__(self, items: Items):
        self.grams = items.grams
        self.some = np.zeros(1 << FILTER_BITS, bool)
        self.some[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes, their offsets by text; and of each hit the n-gram, the text and the word it begins at."""
        _, _, hashes, word_at = T.words(body, at, T.MARKS)
        found, cut = T.grams(hashes, word_at, SEED)
        maybe = np.flatnonzero(self.some[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        index = np.searchsorted(self.grams, found[maybe])
        index[index == len(self.grams)] = 0
        sure = self.grams[index] == found[maybe] if len(self.grams) else np.zeros(0, bool)
        maybe, index = maybe[sure], index[sure]
        owner = np.searchsorted(cut, maybe, "right") - 1
        return hashes, word_at, index, owner, maybe - cut[owner]


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local score, and the last word of the item and of the text in it (exclusive).

    One row per item word; along a row, gaps in the text are a running maximum.
    """
    steps = np.arange(len(words) + 1) * -GAP
    row, best = np.zeros(len(words) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(item):
        step = np.maximum(row + GAP, 0)
        step[1:] = np.maximum(step[1:], row[:-1] + np.where(words == word, MATCH, OTHER))
        row = np.maximum.accumulate(step + steps) - steps
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), i + 1, at)
    return best


def reachable(held: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The best alignment score that items could reach, given which of their words a text holds at all (``held``, item
    after item, cut at ``cuts``, no item empty): a held word scores a match, any other one costs a gap, and the stretch
    of the item is free. No alignment scores above it, so an item below SCORE here needs none."""
    total = np.concatenate(([0], np.cumsum(np.where(held, MATCH, GAP))))
    sizes = np.diff(cuts)
    # a large step down from item to item lets one running minimum serve all
    drop = np.repeat(np.arange(len(sizes)) * -(2 * (MATCH - GAP) * (len(held) + 1)), sizes)
    low = np.minimum.accumulate(total[:-1] + drop) - drop
    return np.maximum(np.maximum.reduceat(total[1:] - low, cuts[:-1]), 0)


def matches(items: Items, words: np.ndarray, grams: np.ndarray, begins: np.ndarray) -> list[dict]:
    """The items that one text holds, from the seeds found in it."""
    places = items.place_at[grams + 1] - items.place_at[grams]
    at = np.repeat(items.place_at[grams] - np.cumsum(places) + places, places) + np.arange(places.sum())
    owner, diagonal, seed = items.place_item[at], np.repeat(begins, places) - items.place_word[at], np.repeat(grams, places)
    order = np.argsort(owner, kind="stable")
    owner, diagonal, seed = owner[order], diagonal[order], seed[order]
    near, starts = np.unique(owner, return_index=True)
    ends = np.append(starts[1:], len(owner))
    cuts = np.concatenate(([0], np.cumsum([len(items.words[i]) for i in near])))
    some = reachable(np.isin(np.concatenate([items.words[i] for i in near]), words), cuts) >= SCORE * MATCH * np.diff(cuts)
    out = []
    for item, a, b in zip(near[some].tolist(), starts[some], ends[some], strict=True):
        hashes = items.words[item]
        slack = len(hashes) // 2 + SEED
        spans: list[list[int]] = []
        for d in np.unique(diagonal[a:b]).tolist():
            low, high = max(0, d - slack), min(len(words), d + len(hashes) + slack)
            if spans and low <= spans[-1][1]:
                spans[-1][1] = max(high, spans[-1][1])
            else:
                spans.append([low, high])
        best = (0, 0, 0)
        for low, high in spans:
            if reachable(np.isin(hashes, words[low:high]), np.array([0, len(hashes)]))[0] < SCORE * MATCH * len(hashes):
                continue
            score, i, j = align(hashes, words[low:high])
            if score > best[0]:
                back, _, k = align(hashes[:i][::-1], words[low : low + j][::-1])
                best = (score, low + j - k, low + j)
        share = best[0] / (MATCH * len(hashes))
        if share >= SCORE:
            out.append({"item_id": items.ids[item], "score": share, "word_start": best[1], "word_end": best[2], "seeds": len(np.unique(seed[a:b]))})
    return out


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, dealt by a hash of their text."""
    given = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = given.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(-(-size.n // BLOCK_ITEMS), -(-size.bytes // BLOCK_BYTES))
    for part in range(parts):
        rows = given.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()  # about a block's size at most
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        yield Items.of([r.item_id for r in rows], [r.text for r in rows])


def with_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row`` (the whole input row as a struct) and ``matches``, the items its text holds: item_id, score (share of a
    whole copy's alignment score), word_start and word_end in the text (words are runs of letters and digits), seeds.

    Each block of items is one pass that finds the items' n-grams, frequent ones too, in the documents and aligns the item
    with the words around them; nothing is shuffled. Where the words that a text shares with an item cannot reach SCORE in
    any order, the alignment is left out (``reachable``), which loses nothing. Work follows the documents' bytes and the
    seeds found; a text that repeats an item is aligned once over the joint stretch.
    Null texts hold nothing. Items with fewer than SEED words, and null ones, cannot be told from chance and are not
    looked for. Equal items, null and repeated ids are looked for one by one.
    """
    out = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), F.array().cast(MATCHES).alias("matches"))
    for items in blocks(benchmark):
        seeds = items.shared(docs)
        schema = StructType([out.schema["row"], out.schema["text"], StructField("matches", MATCHES)])

        def find(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            items = Items(*seeds.value)
            finder = Finder(items)
            for batch in batches:
                found = batch.column("matches").to_pylist()
                for first, _, body, at in T.pieces(batch.column("text")):
                    hashes, word_at, gram, owner, begin = finder.hits(body, at)
                    if not len(owner):
                        continue
                    cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    for a, b in zip(cuts, np.append(cuts[1:], len(owner)), strict=True):
                        i = owner[a]
                        more = matches(items, hashes[word_at[i] : word_at[i + 1]], gram[a:b], begin[a:b])
                        found[first + i] = found[first + i] + more
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("text"), pa.array(found, batch.schema.field("matches").type)], ["row", "text", "matches"]
                )

        out = out.mapInArrow(find, schema)
    return out.select("row", "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: ``doc_id, item_id, score, word_start, word_end, seeds, contaminated``."""
    found = with_matches(docs.select("doc_id", "text"), benchmark).where(F.size("matches") > 0)
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", "m.score", "m.word_start", "m.word_end", "m.seeds", F.lit(True).alias("contaminated")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, in their own columns."""
    return with_matches(docs, benchmark).where(F.size("matches") == 0).select("row.*")
