"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from jsonloom.llm import text as T


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows of each class that the model is fitted on at most (the smallest id hashes)."""

    bits: int = 20
    sample: int = 6_000
    passes: int = 5
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 20.0
    l2: float = 0.5
    threshold: float = 0.7


def held_out():
    """True for the documents whose labels are not learned from."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1


def features(body: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of words, word pairs and pairs with one word between them, and the text each is of; repeats included."""
    _, _, hashes, word_at = T.words(body, at, T.MARKS)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(word_at))
    near, near_owner = T.pairs(hashes, word_at, 1)
    skip, skip_owner = T.pairs(hashes, word_at, 2)
    slots = (np.concatenate((hashes, near, skip)) >> np.uint64(64 - bits)).astype(np.int64)
    return slots, np.concatenate((owner, near_owner, skip_owner))


def distinct(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct slots, text by text, and their offsets."""
    parts, counts = [], []
    for first, last, body, at in T.pieces(column):
        slots, owner = features(body, at, bits)
        keys = np.unique((owner << bits) | slots)
        parts.append((keys & ((1 << bits) - 1)).astype(np.int32))
        counts.append(np.bincount(keys >> bits, minlength=last - first))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def ftrl(slots: np.ndarray, at: np.ndarray, labels: np.ndarray, order: np.ndarray, s: Settings) -> np.ndarray:
    """Weights after ``passes`` passes over the rows in ``order``. The last slot is the intercept, free of L1.

    z gathers the gradients less the pull to the current weights and n their squares: a slot's rate is
    alpha / (beta + sqrt(n)), and a slot whose z stays within L1 has no weight at all.
    """
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for _ in range(s.passes):
        for i in order:
            x = np.append(slots[at[i] : at[i + 1]], size - 1)
            zx, root = z[x], np.sqrt(n[x])
            shrunk = np.maximum(np.abs(zx) - s.l1, 0.0)
            shrunk[-1] = abs(zx[-1])
            w = -np.sign(zx) * shrunk / ((s.beta + root) / s.alpha + s.l2)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - labels[i]) * weight[i]
            n[x] += g * g
            z[x] += g - (np.sqrt(n[x]) - root) / s.alpha * w
    shrunk = np.maximum(np.abs(z) - s.l1, 0.0)
    shrunk[-1] = abs(z[-1])
    return -np.sign(z) * shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> dict[int, float]:
    """The weights that are not 0, by slot; ``1 << bits`` is the intercept.

    Fitted by one task on at most ``sample`` toxic and ``sample`` other labelled documents that are not held out,
    those with the smallest hash of their id. Labels are joined by doc_id; rows without id or label are not used; of
    several labels of an id the largest counts, of several documents the one whose text has the smallest hash.
    """
    marked = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~held_out()).withColumn("turn", F.xxhash64(F.lit(8), F.col("doc_id")))
    chosen = marked.where("toxic = 1").orderBy("turn", "doc_id").limit(s.sample).unionAll(
        marked.where("toxic = 0").orderBy("turn", "doc_id").limit(s.sample)
    )  # at most two samples of ids
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("nth", F.row_number().over(one)).where("nth = 1").select("toxic", "turn", "text")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = distinct(batch.column("text"), s.bits)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), batch.column("turn"), lists], ["toxic", "turn", "slots"])

    def learn(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("turn", kind="stable")
        at = np.concatenate(([0], np.cumsum([len(x) for x in sample["slots"]])))
        w = ftrl(np.concatenate([*sample["slots"], np.zeros(0, np.int32)]).astype(np.int64), at, sample["toxic"].to_numpy(), np.arange(len(sample)), s)
        found = np.flatnonzero(w)
        return pd.DataFrame({"slot": found, "weight": w[found]})

    marks = rows.mapInArrow(slots, "toxic int, turn bigint, slots array<int>")
    model = marks.groupBy(F.lit(0).alias("model")).applyInPandas(learn, "slot bigint, weight double")  # a bounded sample
    return {r.slot: r.weight for r in model.collect()}  # at most 1 << bits


def scored(docs: DataFrame, weights: dict[int, float], s: Settings = Settings(), carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all by default) of every row and ``score``, from its whole text alone."""
    dense = np.zeros((1 << s.bits) + 1, np.float32)
    for slot, weight in weights.items():
        dense[slot] = weight
    shared = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(dense), dense[np.flatnonzero(dense)]))
    carry = docs.columns if carry is None else carry
    bits = s.bits

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros((1 << bits) + 1, np.float32)
        w[shared.value[0]] = shared.value[1]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            total = np.full(batch.num_rows, float(w[-1]))
            for first, last, body, at in T.pieces(texts):
                slots, owner = features(body, at, bits)
                used = np.flatnonzero(w[slots])
                keys = np.unique((owner[used] << bits) | slots[used])
                total[first:last] += np.bincount(keys >> bits, w[keys & ((1 << bits) - 1)].astype(np.float64), last - first)
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*batch.schema.names[:-1], "score"])

    if "score" in carry:
        raise ValueError("a column named score is in the way; rename it first")
    given = docs.select(*carry, F.col("text").alias("_scored_text"))
    schema = StructType([*given.schema.fields[:-1], StructField("score", DoubleType())])
    return given.mapInArrow(score, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``. Null and empty texts get the intercept's score."""
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels, s), s, ["doc_id"])
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, in their own columns, whatever these are.

    Null and empty texts have the intercept's score; rows without id or label are scored like others; equal rows are equal in
    score and stay or go together; an empty table gives no rows.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col("text"))
    return scored(packed, fit(docs, labels, s), s, ["row"]).where(F.col("score") < s.threshold).select("row.*")
