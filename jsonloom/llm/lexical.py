"""Ranked lexical search over K2-treaps of the term-document grid.

The grid has a row per term and a column per document; a cell that is not empty holds its impact, the term's part of the
document's score without the term's weight. The grid is cut by documents into tiles of bounded text. A tile's treap is a
quadtree over it: a node stands for a square of rows and columns, has a four-bit mask of its quadrants that hold
anything, and the greatest impact within it, kept as the difference to its parent's. A search follows, for every term
of an item, the path of the term's row; all paths are at the same range of documents, so the weighted sum of their nodes'
maxima bounds every score in the range, and ranges are opened best first.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonloom.llm.blocks import offsets, packed, text_blocks, unpacked
from jsonloom.llm.text import MARKS, buffer
from jsonloom.session import cut_lineage

#: items that are searched in one pass over the index, and bytes of their terms
ITEMS, ITEM_BYTES = 2_000, 4_000_000
#: ranges of an item that are opened at once
OPENED = 48
#: (item, term) pairs that are searched together in a tile, and paths that are followed at once
PAIRS, PATHS = 1_500, 100_000
#: bytes of text in a tile; a longer document is a tile of its own
TILE = 4_000_000
#: one tile in so many is searched first; its scores are floors for the others
FIRST = 8

TILES = "tile bigint, n_docs bigint, terms binary, treap binary"
FOUND = "item int, doc_id bigint, score bigint"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)


def terms_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, folded, and the texts' offsets in them."""
    body, at = buffer(text)
    inside = ~MARKS[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = at[1:-1]
    cuts = cuts[cuts < len(body)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    kept = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    ends = np.append(kept[starts], kept[-1])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(_FOLD[body[inside]].tobytes())])
    return terms, np.searchsorted(starts, at, "left")


# --- totals -----------------------------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, 2_000_000):
        body, at = buffer(block.column("text").chunk(0))
        first = ~MARKS[body]
        inside = first.copy()
        first[1:] &= ~inside[:-1]
        cuts = at[1:-1]
        cuts = cuts[cuts < len(body)]
        first[cuts] = inside[cuts]
        n = np.diff(np.concatenate(([0], np.cumsum(first, dtype=np.int64)))[at])
        yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["docs", "terms"])


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    row = docs.select("text").mapInArrow(_count, "docs bigint, terms bigint").agg(F.sum("docs").alias("n"), F.sum("terms").alias("l")).first()
    return row.n or 0, row.l or 0


# --- index ------------------------------------------------------------------------------------------------------------


def spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits, moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def treap(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, side: int) -> list[dict[str, np.ndarray]]:
    """Levels of the treap of a grid of ``2 ** side`` rows and columns, root first: masks of quadrants, and falls from the parent's maximum.

    A quadrant's number is twice its half of the rows and its half of the columns. The last level has no masks.
    """
    codes = (spread(rows) << np.uint64(1)) | spread(columns)
    order = np.argsort(codes)
    codes, most = codes[order], impacts[order]
    levels = [{"most": most}]
    for _ in range(side):
        parents = codes >> np.uint64(2)
        begins = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]))
        bits = (1 << (codes & np.uint64(3)).astype(np.int64)).astype(np.uint8)
        up = np.maximum.reduceat(most, begins)
        levels[0]["fall"] = np.repeat(up, np.diff(np.append(begins, len(codes)))) - levels[0].pop("most")
        levels.insert(0, {"mask": np.bitwise_or.reduceat(bits, begins), "most": up})
        codes, most = parents[begins], up
    levels[0]["fall"] = -levels[0].pop("most")
    return levels


def _tiles(n_docs: int, n_terms: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, size):
            words, at = terms_of(block.column("text").chunk(0))
            has = np.diff(at) > 0
            if not has.any():
                continue
            n = np.diff(at)[has]
            listed = words.dictionary_encode()
            terms = listed.dictionary
            # rows by falling number of cells: frequent terms lie together, and squares of rare ones are mostly empty
            column = np.repeat(np.arange(len(n)), n)
            cells, tf = np.unique(listed.indices.to_numpy().astype(np.int64) * len(n) + column, return_counts=True)
            held = np.bincount(cells // len(n), minlength=len(terms))
            order = np.argsort(-held, kind="stable")
            row = np.empty(len(order), np.int64)
            row[order] = np.arange(len(order))
            columns = cells % len(n)
            m = 50 + (50 * n * n_docs) // n_terms
            impacts = (1_000_000_000 * tf) // (1000 * tf + 20 * m[columns])
            side = max(len(terms) - 1, len(n) - 1, 1).bit_length()
            levels = treap(row[cells // len(n)], columns, impacts, side)
            parts = {"docs": packed(pa.table({"doc_id": block.column("doc_id").filter(pa.array(has))}))}
            for k, level in enumerate(levels):
                parts |= {f"{name}{k}": packed(pa.table({"v": values.astype(np.uint8 if name == "mask" else np.int32)})) for name, values in level.items()}
            whole = pa.table({name: pa.array([value], pa.large_binary()) for name, value in parts.items()})
            words_of = pa.table({"term": terms.take(pa.array(order)), "df": held[order].astype(np.int32)})
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("key").chunk(0).slice(0, 1),
                    pa.array([len(n)], pa.int64()), pa.array([packed(words_of)], pa.binary()), pa.array([packed(whole)], pa.binary()),
                ],
                ["tile", "n_docs", "terms", "treap"],
            )

    return run


class Index:
    """An index in the shared folder: ``tiles`` (one row per tile), documents with a term, and all their terms."""

    def __init__(self, tiles: DataFrame, n_docs: int, n_terms: int):
        self.tiles, self.n_docs, self.n_terms = tiles, n_docs, n_terms


def build_index(docs: DataFrame, tile_bytes: int = TILE) -> Index:
    """Index all terms of all documents (``doc_id``, ``text``; other columns are not read)."""
    given = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    n_docs, n_terms = totals(given)
    keyed = given.withColumn("key", F.xxhash64("doc_id", F.length("text")))
    return Index(cut_lineage(keyed.mapInArrow(_tiles(n_docs, max(n_terms, 1), tile_bytes), TILES)), n_docs, n_terms)


# --- search -----------------------------------------------------------------------------------------------------------


def _held(asked: pa.Array):
    """For every tile, how many of its documents hold each of the asked terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("terms"):
                table = unpacked(payload.as_py())
                place = pc.index_in(table.column("term").chunk(0), asked)
                got = place.is_valid()
                yield pa.RecordBatch.from_arrays([place.filter(got).cast(pa.int32()), table.column("df").chunk(0).filter(got).cast(pa.int64())], ["term", "df"])

    return run


class Tile:
    """A tile's treap, ready for searches."""

    def __init__(self, terms: bytes, body: bytes, asked: pa.Array):
        whole = unpacked(body)
        read = lambda name: unpacked(whole.column(name)[0].as_py())
        self.doc_ids = read("docs").column("doc_id").combine_chunks()
        self.side = sum(name.startswith("mask") for name in whole.column_names)
        self.mask, self.start, self.most = [], [], []
        for k in range(self.side + 1):
            fall = read(f"fall{k}").column("v").to_numpy().astype(np.int64)
            if k:
                mask = self.mask[-1]
                fall = np.repeat(self.most[-1], _BITS[mask]) - fall
                self.start.append(offsets(_BITS[mask]))
            else:
                fall = -fall
            self.most.append(fall)
            if k < self.side:
                self.mask.append(read(f"mask{k}").column("v").to_numpy())
        row = pc.index_in(asked, unpacked(terms).column("term").chunk(0))
        #: of each asked term its row; -1 if no document here holds it
        self.row = row.fill_null(-1).to_numpy().astype(np.int64)

    def below(self, level: np.ndarray, node: np.ndarray, half: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The child on the term's row and in the half of the columns, or -1."""
        out = np.full(len(node), -1, np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            quadrant = 2 * ((rows[here] >> (self.side - 1 - k)) & 1) + half[here]
            mask = self.mask[k][node[here]].astype(np.int64)
            child = self.start[k][node[here]] + _BITS[mask & ((1 << quadrant) - 1)]
            out[here] = np.where((mask >> quadrant) & 1, child, -1)
        return out

    def maxima(self, level: np.ndarray, node: np.ndarray) -> np.ndarray:
        out = np.zeros(len(node), np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            out[here] = self.most[k][node[here]]
        return out


def search_tile(tile: Tile, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, columns and scores of each item's ``k`` best documents of the tile, and of all that tie with the last.

    ``owner`` (ascending), ``term`` and ``weight`` list the items' terms; no score below an item's ``floor`` (1 at least)
    is wanted. Every step opens, for each item, the ranges with its greatest bounds, and drops ranges whose bound is below the
    item's k-th best score so far.
    """
    here = (tile.row[term] >= 0) & (weight > 0)
    owner, row, weight = owner[here], tile.row[term[here]], weight[here]
    floor = np.maximum(floor, 1)
    none = np.zeros(0, np.int64)
    got = [(none, none, none)]
    # a range: item, level, first column; its paths are a slice of (node, row, weight)
    items, begins, paths = np.unique(owner, return_index=True, return_counts=True)
    waiting = {"item": items, "level": np.zeros(len(items), np.int64), "column": np.zeros(len(items), np.int64), "n": paths}
    bound = np.add.reduceat(tile.most[0][0] * weight, begins) if len(items) else none
    path_node, path_row, path_weight = np.zeros(len(owner), np.int64), row, weight
    best: dict[int, np.ndarray] = {}
    while len(waiting["item"]):
        keep = bound >= floor[waiting["item"]]
        kept_paths = np.repeat(keep, waiting["n"])
        waiting = {name: v[keep] for name, v in waiting.items()}
        bound = bound[keep]
        path_node, path_row, path_weight = path_node[kept_paths], path_row[kept_paths], path_weight[kept_paths]
        if not len(bound):
            break
        # the best ranges of every item
        order = np.lexsort((-bound, waiting["item"]))
        ranked = waiting["item"][order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        most = np.zeros(len(order), bool)
        most[order[place < OPENED]] = True
        most &= np.cumsum(np.where(most, waiting["n"], 0)) <= max(PATHS, int(waiting["n"][np.argmax(most)]))
        chosen_paths = np.repeat(most, waiting["n"])
        opened = {name: v[most] for name, v in waiting.items()}
        node, prow, pweight = path_node[chosen_paths], path_row[chosen_paths], path_weight[chosen_paths]
        # both halves of each
        which = np.repeat(np.arange(len(opened["item"])), opened["n"])
        level = opened["level"][which]
        new = []
        for half in (0, 1):
            child = tile.below(level, node, np.full(len(node), half, np.int64), prow)
            lives = child >= 0
            part = which[lives]
            if not len(part):
                continue
            value = tile.maxima(level[lives] + 1, child[lives]) * pweight[lives]
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            entry = part[at]
            sums = np.add.reduceat(value, at)
            column = opened["column"][entry] + (half << (tile.side - 1 - opened["level"][entry]))
            counts = np.diff(np.append(at, len(part)))
            new.append((opened["item"][entry], opened["level"][entry] + 1, column, counts, sums, child[lives], prow[lives], pweight[lives]))
        rest = ~most
        rest_paths = ~chosen_paths
        lists = [(*(waiting[x][rest] for x in ("item", "level", "column", "n")), bound[rest], path_node[rest_paths], path_row[rest_paths], path_weight[rest_paths])]
        for item, lev, column, counts, sums, child, prow_, pweight_ in new:
            done = lev == tile.side
            if done.any():
                well = done & (sums >= floor[item])
                got.append((item[well], column[well], sums[well]))
                for i in np.unique(item[well]):
                    mine = np.concatenate((best.get(i, none), sums[well & (item == i)]))
                    if len(mine) >= k:
                        mine = np.partition(mine, len(mine) - k)[len(mine) - k :]
                        floor[i] = max(floor[i], mine.min())
                    best[i] = mine
            open_paths = np.repeat(~done, counts)
            lists.append((item[~done], lev[~done], column[~done], counts[~done], sums[~done], child[open_paths], prow_[open_paths], pweight_[open_paths]))
        joined = [np.concatenate(x) for x in zip(*lists)]
        waiting = dict(zip(("item", "level", "column", "n"), joined[:4]))
        bound, path_node, path_row, path_weight = joined[4:]
    item, column, score = (np.concatenate(x) for x in zip(*got))
    well = score >= floor[item]
    return item[well], column[well], score[well]


def _search(asked: pa.Array, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, floor: np.ndarray, k: int):
    # items in groups, so that what is open in a tile at once does not grow with the items
    items, firsts = np.unique(owner, return_index=True)
    group = firsts // PAIRS
    cuts = [*firsts[np.flatnonzero(np.append(True, group[1:] != group[:-1]))], len(owner)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, body in zip(batch.column("terms"), batch.column("treap")):
                tile = Tile(terms.as_py(), body.as_py(), asked)
                found = [search_tile(tile, owner[a:b], term[a:b], weight[a:b], floor.copy(), k) for a, b in zip(cuts, cuts[1:])]
                item, column, score = (np.concatenate(x) for x in zip(*found))
                ids = tile.doc_ids.take(pa.array(column))
                order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), -score, item))
                begins = np.searchsorted(item[order], item[order], "left")
                order = order[np.arange(len(order)) - begins < k]
                yield pa.RecordBatch.from_arrays([pa.array(item[order], pa.int32()), ids.take(pa.array(order)), pa.array(score[order], pa.int64())], ["item", "doc_id", "score"])

    return run


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their distinct terms, in blocks that are bounded by items and by bytes; items stream through the driver."""
    held, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        words, _ = terms_of(pa.array([row.text or ""], pa.large_string()))
        words = words.unique().to_pylist()
        weight = sum(map(len, words))
        if held and (len(held) == ITEMS or size + weight > ITEM_BYTES):
            yield held
            held, size = [], 0
        held.append((row.item_id, words))
        size += weight
    if held:
        yield held


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """Each item's ``k`` best documents: ``item_id, rank, doc_id, score``.

    Equal scores go by ascending doc_id (null last); documents that repeat an id are ranked each. An item without terms
    or without a document of score above 0 has no rows; items that repeat an id are ranked apart. Items are searched in
    blocks, each with two passes over the index: one tile in FIRST gives floors (an item's k-th best score there bounds its
    final one from below), so the others open few ranges. A tile returns at most k rows per item.
    """
    spark = items.sparkSession
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in item_blocks(items):
        places: dict[bytes, int] = {}
        owner, term = [], []
        for i, (_, words) in enumerate(block):
            for w in words:
                owner.append(i)
                term.append(places.setdefault(w, len(places)))
        if not places:
            continue
        asked = pa.array(list(places), pa.large_binary())
        df = Counter({r.term: r.df for r in index.tiles.select("terms").mapInArrow(_held(asked), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()})
        weights = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df[t] + 1))) for t in range(len(places))], np.int64)
        owners, terms = np.array(owner), np.array(term)
        order = ["item", F.desc("score"), F.asc_nulls_last("doc_id")]
        best = Window.partitionBy("item").orderBy(*order[1:])

        def found(tiles: DataFrame, floor: np.ndarray) -> DataFrame:
            run = _search(asked, owners, terms, weights[terms], floor, k)
            ranked = tiles.select("terms", "treap").mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best))
            return cut_lineage(ranked.where(F.col("rank") <= k))

        leads = F.pmod(F.xxhash64("tile", "n_docs"), F.lit(FIRST)) == 0
        lead = found(index.tiles.where(leads), np.ones(len(block), np.int64))
        floor = np.ones(len(block), np.int64)
        for row in lead.where(F.col("rank") == k).select("item", "score").collect():
            floor[row.item] = row.score
        rest = found(index.tiles.where(~leads), floor)
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id bigint")
        both = lead.unionAll(rest).drop("rank").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        out = out.unionAll(both.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    return out
