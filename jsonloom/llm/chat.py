"""Chat formatting as a prefix tree: shared turns once, depth first, with positions and attention intervals."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage

#: the role whose text is trained on
TRAINED = "assistant"
#: stands for a null conv_id inside the operator
NO_ID = -(2**63)

# ---- template: <turn role="user">text</turn>, control strings in texts escaped


_CODES = {"\\": "\\\\", "<": "\\l", '"': "\\q"}
_NAMED = {code[1]: char for char, code in _CODES.items()}


def escaped(text: str) -> str:
    """Backslash, < and double quote as two characters each, so a text holds no control string."""
    return re.sub(r'[\\<"]', lambda m: _CODES[m[0]], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _NAMED[m[1]], text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the place of its text in it."""
    head, body = f'<turn role="{escaped(role)}">', escaped(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


TURN = re.compile(r'<turn role="((?:[^\\"]|\\.)*)">((?:[^\\<]|\\.)*)</turn>\n', re.DOTALL)


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = TURN.fullmatch(turn)
    if found is None:
        raise ValueError("not one formatted turn")
    return unescaped(found[1]), unescaped(found[2])


# ---- passes along conversations, which only keep a running state


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, role, text, in order -> conv, idx, chain, start, n_chars, loss_start, loss_end, trained, formatted.

    ``chain`` is a digest of all turns up to this one: conversations share a prefix where they share the chain.
    """
    last, idx, start, chain = None, 0, 0, b""
    for batch in batches:
        out = {k: [] for k in ("idx", "chain", "start", "n_chars", "loss_start", "loss_end", "trained", "formatted")}
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != last:
                last, idx, start, chain = conv, 0, 0, b""
            whole, a, b = formatted(role, text)
            chain = hashlib.sha256(chain + whole.encode()).digest()[:16]
            for k, v in zip(out, (idx, chain, start, len(whole), a, b, role == TRAINED, whole), strict=True):
                out[k].append(v)
            idx, start = idx + 1, start + len(whole)
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]], ["conv", *out])


CHAINED = "conv bigint, idx bigint, chain binary, start bigint, n_chars bigint, loss_start bigint, loss_end bigint, trained boolean, formatted string"


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, formatted, loss_start, loss_end, trained, in order -> a row of digests per conversation."""
    state = None

    def row():
        conv, n, turns, loss_chars, loss, chars = state
        return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    for batch in batches:
        done = []
        for conv, whole, a, b, trained in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parsed(whole)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            if trained:
                under = unescaped(whole[a:b])
                state[3] += len(under)
                state[4].update(under.encode())
            state[5] += len(whole)
        yield batch_of(done)
    if state is not None:
        yield batch_of([row()])


READ_BACK = "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class PrefixTree:
    """The packed output.

    ``sections``: tree, conv, offset, length, position, ancestors. What a conversation adds to its tree: ``length`` code
    points from ``offset`` of the tree's sequence on, at positions from ``position`` on; its tokens attend to the
    intervals ``ancestors`` of the sequence, all before it, and to what precedes them in the section itself.
    ``turns``: tree, conv, idx, offset, position, n_chars, loss_start, loss_end, trained, formatted. The sections' turns;
    the loss mask of a trained turn is [loss_start, loss_end) of it.
    ``places``: conv, idx, owner. The section (its conv) that has each turn of each conversation.
    """

    def __init__(self, sections: DataFrame, turns: DataFrame, places: DataFrame):
        self.sections, self.turns, self.places = sections, turns, places

    def conversations(self) -> DataFrame:
        """Every conversation read back from the tree: counts and digests of its turns, loss text and length."""
        held = self.turns.select(F.col("conv").alias("owner"), "idx", "formatted", "loss_start", "loss_end", "trained")
        rows = self.places.join(held, ["owner", "idx"])
        return (
            rows.select("conv", "idx", "formatted", "loss_start", "loss_end", "trained")
            .repartition("conv").sortWithinPartitions("conv", "idx").drop("idx")
            .mapInArrow(read_back, READ_BACK)
        )


def prefix_tree(conversations: DataFrame) -> PrefixTree:
    """All conversations (conv_id, turn, role, text; rows by turn, ties by role and text) merged by shared first turns.

    1. One pass along each conversation formats its turns and chains their digests. It keeps a digest and two numbers,
       so a conversation of any length needs no memory; its digests have to follow its order, in one task.
    2. The owner of a prefix is the smallest conv_id that has it, found by an aggregate over chains. Along a
       conversation owners only grow, and each owns one run of it: the path from the root to the conversation's section.
    3. Sections in the order of their paths (deeper branches first, then by id) are the tree depth first. Offsets are
       prefix sums: within range partitions, and over the partitions' totals, so a tree of any size is no hot task.
    4. The section a path's run lies in gives the ancestors' intervals.

    Null roles and texts are empty; null turns come first; null ids form one conversation. Repeated rows are turns of
    their own. A conversation that is a prefix of another, or its copy, has no section unless its id is smaller. An
    empty table gives empty tables; other columns are not read.
    """
    given = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NO_ID)).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = given.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    turns = cut_lineage(ordered.select("conv", "role", "text").mapInArrow(chained, CHAINED))
    owners = turns.groupBy("chain").agg(F.min("conv").alias("owner"))
    placed = cut_lineage(turns.select("conv", "idx", "chain", "start", "n_chars").join(owners, "chain").drop("chain"))
    runs = placed.groupBy("conv", "owner").agg(F.min("idx").alias("idx"), F.min("start").alias("start"), F.sum("n_chars").alias("length"))
    paths = runs.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("idx", "owner", "start", "length"))).alias("path"))
    own = F.element_at("path", -1)
    emitted = paths.where(own["owner"] == F.col("conv")).select(
        "conv", F.col("path")[0]["owner"].alias("tree"), own["start"].alias("position"), own["length"].alias("length"),
        F.transform("path", lambda x: F.struct((-x["idx"]).alias("depth"), x["owner"].alias("owner"))).alias("order"),
        F.slice("path", 1, F.size("path") - 1).alias("above"),
    )
    ranged = cut_lineage(emitted.repartitionByRange("order").withColumn("part", F.spark_partition_id()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("part").agg(F.sum("length").alias("length")).select("part", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    located = ranged.join(F.broadcast(totals), "part").withColumn("at", F.col("before") + F.coalesce(F.sum("length").over(inside), F.lit(0)))
    firsts = located.groupBy("tree").agg(F.min("at").alias("first"))
    located = cut_lineage(
        located.join(firsts, "tree").select("tree", "conv", (F.col("at") - F.col("first")).alias("offset"), "length", "position", "above")
    )
    spans = (
        located.select("conv", F.explode("above").alias("a")).select(F.col("conv").alias("child"), F.col("a.owner").alias("owner"), F.col("a.length").alias("n"))
        .join(located.select(F.col("conv").alias("owner"), "offset"), "owner")
        .groupBy("child")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("offset").alias("start"), (F.col("offset") + F.col("n")).alias("end")))).alias("ancestors"))
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    sections = located.join(spans, located["conv"] == spans["child"], "left").select(
        "tree", "conv", "offset", "length", "position", F.coalesce("ancestors", none).alias("ancestors")
    )
    kept = turns.join(placed.where("conv = owner").select("conv", "idx"), ["conv", "idx"])
    nodes = kept.join(located.select("conv", "tree", "offset", F.col("position").alias("from")), "conv").select(
        "tree", "conv", "idx", (F.col("offset") + F.col("start") - F.col("from")).alias("offset"), F.col("start").alias("position"), "n_chars",
        "loss_start", "loss_end", "trained", "formatted",
    )
    return PrefixTree(sections, cut_lineage(nodes), placed.select("conv", "idx", "owner"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation, read back from the tree: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``."""
    rows = prefix_tree(conversations).conversations()
    return rows.select(F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), *rows.columns[1:])
