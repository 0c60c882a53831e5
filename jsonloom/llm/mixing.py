"""Mix sources to target weights by a minimum-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: what a token's first, second and third use costs: repeats cost more the more there are
REPEAT_COSTS = (0, 1, 3)
#: fine parts of the hash range; only the part that holds a cut is ordered row by row
PART_BITS = 12
#: membership patterns that the flow is solved for; more raises an error
MAX_PATTERNS = 100_000


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> dict[str | None, float]:
    """Share all sizes by weight (sources by code point, null last, weights repeating); nothing gets over ``most``
    times its size, and what is over goes to the others by weight until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return {s: out[s] for s in names}


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int], costs: tuple[int, ...] = REPEAT_COSTS) -> list[int]:
    """Tokens routed from each pattern: patterns feed their sources up to ``quota``, each use layer of a pattern
    holds ``capacity`` tokens at its cost, as many tokens flow as can, at the least total cost.

    Shortest augmenting paths. The graph has one arc per pattern, layer and membership, not per document.
    """
    n, m = len(capacity), len(quota)
    start, end = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    arcs: list[list[int]] = []  # to, capacity left, cost; the reverse arc is the neighbour by ^ 1

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        graph[a].append(len(arcs))
        arcs.append([b, cap, cost])
        graph[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    layers = []
    for p in range(n):
        for cost in costs:
            layers.append((p, len(arcs)))
            arc(start, p, capacity[p], cost)
        for s in members[p]:
            arc(p, n + s, capacity[p] * len(costs), 0)
    for s in range(m):
        arc(n + s, end, quota[s], 0)
    while True:
        far = [None] * (n + m + 2)
        far[start], came, waiting, queue = 0, {}, {start}, deque([start])
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for i in graph[a]:
                b, cap, cost = arcs[i]
                if cap > 0 and (far[b] is None or far[a] + cost < far[b]):
                    far[b], came[b] = far[a] + cost, i
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if far[end] is None:
            break
        path, b = [], end
        while b != start:
            path.append(came[b])
            b = arcs[came[b] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount
    out = [0] * n
    for p, i in layers:
        out[p] += arcs[i ^ 1][1]
    return out


def chance(seed: int) -> Column:
    """The seeded place of a document in its pattern's order, 63 bits; rows equal in id and text share it."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)


def slim(docs: DataFrame, seed: int, membership: Column | None = None) -> DataFrame:
    """``doc_id, source, size, place, pattern``: what the mix is decided from."""
    members = F.array(F.col("source")) if membership is None else F.array_sort(F.array_distinct(membership))
    return docs.select(F.col("doc_id"), F.col("source"), words(F.col("text")).alias("size"), chance(seed).alias("place"), members.alias("pattern"))


def decide(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> tuple[DataFrame, dict[str | None, int], dict[str | None, float]]:
    """``pattern, times, cut`` (every document of a pattern is taken ``times`` times, those placed up to ``cut`` once
    more), the sizes of the sources and their targets.

    Per pattern only its total comes to the driver. The cut is found without ordering a source: sums per part of the
    hash range give the part that holds it, and only that part's rows are ordered.
    """
    spark = rows.sparkSession
    most = len(REPEAT_COSTS)
    totals = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    totals.sort(key=lambda r: [(s is None, s or "") for s in r.pattern])
    sizes: dict[str | None, int] = {}
    for r in totals:
        for s in r.pattern:
            sizes[s] = sizes.get(s, 0) + r["size"]
    targets = source_targets(sizes, weights, most)
    names = list(targets)
    at = {s: i for i, s in enumerate(names)}
    flow = min_cost_flow([r["size"] for r in totals], [[at[s] for s in r.pattern] for r in totals], [round(targets[s]) for s in names])
    plan = []
    for r, tokens in zip(totals, flow, strict=True):
        times = min(most, tokens // r["size"]) if r["size"] else 0
        plan.append((r.pattern, times, tokens - times * r["size"]))
    schema = "pattern array<string>, times int, rest bigint"
    plans = spark.createDataFrame(plan, schema)  # at most MAX_PATTERNS rows
    shift = 63 - PART_BITS
    parts = (
        rows.withColumn("part", F.shiftright("place", shift))
        .groupBy("pattern", "part").agg(F.sum("size").alias("size"))
        .join(F.broadcast(plans.where("rest > 0")), "pattern")
        .withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("part")))
        .where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
        .select("pattern", "part", (F.col("rest") - F.col("upto") + F.col("size")).alias("need"))
    )
    tied = rows.withColumn("part", F.shiftright("place", shift)).join(F.broadcast(parts), ["pattern", "part"])  # one part a pattern
    last = (
        tied.groupBy("pattern", "part", "need", "place").agg(F.sum("size").alias("size"))
        .withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("place")))
        .groupBy("pattern", "part", "need")
        .agg(F.min(F.struct(F.abs(F.col("upto") - F.col("need")).alias("miss"), F.col("place").alias("place"))).alias("best"))
        .select("pattern", F.when(F.col("best.miss") < F.col("need"), F.col("best.place")).otherwise(F.shiftleft("part", shift) - 1).alias("cut"))
    )
    cuts = {tuple(r.pattern): r.cut for r in last.collect()}
    decided = spark.createDataFrame([(p, times, cuts.get(tuple(p), -1)) for p, times, _ in plan], "pattern array<string>, times int, cut bigint")
    return decided, sizes, targets


def with_times(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """``rows`` (with ``pattern`` and ``place``) and ``uses``, how often each is taken."""
    at = decided.withColumnRenamed("pattern", "_pattern")
    return (
        rows.join(F.broadcast(at), F.col("pattern") == F.col("_pattern"))
        .withColumn("uses", F.col("times") + (F.col("place") <= F.col("cut")).cast("int"))
        .drop("_pattern", "times", "cut")
    )


def mix_report(rows: DataFrame) -> DataFrame:
    """One row per document of ``slim`` rows: ``doc_id, source, size, source_size, target, uses, taken``."""
    decided, sizes, targets = decide(rows)
    by = rows.sparkSession.createDataFrame(
        [(s, sizes[s], targets[s]) for s in targets], "_source string, source_size bigint, target double"
    )
    return (
        with_times(rows, decided)
        .join(F.broadcast(by), F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "source", "size", "source_size", "target", "uses", (F.col("size") * F.col("uses")).alias("taken"))
    )


def mix_documents(docs: DataFrame, seed: int = 9) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken (up to three times), in its own columns.

    Null and empty texts have no words and are not taken; null is a source of its own; equal rows are taken alike.
    No text is shuffled: a row's uses follow from its source and its seeded hash.
    """
    decided, _, _ = decide(slim(docs, seed))
    keyed = docs.select(
        F.struct("*").alias("row"), F.array(F.col("source")).alias("pattern"), chance(seed).alias("place"), (words(F.col("text")) > 0).alias("has_words")
    )
    taken = with_times(keyed, decided).where("has_words and uses > 0").withColumn("use", F.explode(F.expr("sequence(1, uses)")))
    return taken.select("row.*")
