"""Integrity in arrival order, kept up to date batch by batch.

The answer is that of the batch analysis over all documents so far, for any cut into batches and also where a document that
belongs before others comes after them. What is kept per parent key is small and merges: where it was first seen, its last
declaration and the limit given there. A child that came after its parent stays in order whatever comes later, as a first
sight only moves forward; so only children that were early are kept, and for counts only those after the last declaration.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jsonloom.operators.arrival import ArrivalRules, arrival_rows, issue
from jsonloom.operators.large import LARGE_FILE, shred_files
from jsonloom.operators.quality.rows import details
from jsonloom.operators.shred import QUARANTINE, RECORD_POSITION, shred
from jsonloom.sources.documents import read_documents, stream_files
from jsonloom.sources.store import Batch, TableStore

PARENTS, REPEATS, EARLY, CHILDREN, BROKEN = "_arrival_parents", "_arrival_repeats", "_arrival_early", "_arrival_children", "_arrival_broken"
_AT = "struct<file_order: bigint, path: string, block_start: bigint, line_id: bigint, table_pos: int, rec_pos: int>"
_SCHEMAS = {
    PARENTS: f"table_name string, key string, field string, first {_AT}, last {_AT}, limit_text string",
    REPEATS: f"table_name string, key string, at {_AT}",
    EARLY: f"kind string, parent string, field string, key string, child string, at {_AT}",
    CHILDREN: f"key string, at {_AT}",
    BROKEN: "path string",
}


def _schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_SCHEMAS[table])


def update_arrivals(store: TableStore, records: DataFrame, rules: ArrivalRules, token: tuple[str, int] | None = None) -> bool:
    """Add a batch of shredded records (with rejects) to the state; False when it had been published before.

    A call reads its own rows and the buckets of the parents they name.
    """
    batch = store.batch(token=token)
    if batch.published:
        return False
    spark = store.spark
    rows = arrival_rows(records, rules)
    at = F.struct(*RECORD_POSITION).cast(_AT).alias("at")
    watched = {(t, k) for t, k in rules.keys.items()} | {(r.parent, r.primary_key) for r in rules.references}
    limit_of = {}
    if rules.capacity:
        parent, key, limit, _, _ = rules.capacity
        watched.add((parent, key))
        limit_of[parent, key] = limit
    for table in _SCHEMAS:
        batch.create(table, _schema(table), ["table_name", "field", "key"] if table == PARENTS else None)

    def of(table: str) -> DataFrame:
        return rows.where(F.col("_table") == table)

    declared = [
        of(t).where(F.col(k).isNotNull()).select(
            F.lit(t).alias("table_name"), F.lit(k).alias("field"), F.col(k).alias("key"), at,
            (F.col(limit_of[t, k]) if (t, k) in limit_of else F.lit(None).cast("string")).alias("limit_text"),
        )
        for t, k in sorted(watched)
    ]
    declared = batch.kept(reduce(DataFrame.unionByName, declared) if declared else spark.createDataFrame([], f"table_name string, field string, key string, at {_AT}, limit_text string"))
    keys = ["table_name", "field", "key"]
    fresh = declared.groupBy(*keys).agg(F.min("at").alias("first"), F.max("at").alias("last"), F.max_by(F.struct("limit_text"), "at")["limit_text"].alias("limit_text"))
    old = _near(batch, fresh.select(*keys))
    merged = batch.kept(
        old.unionByName(fresh).groupBy(*keys).agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.max_by(F.struct("limit_text"), "last")["limit_text"].alias("limit_text")
        )
    )
    # all declarations of a key but the first are repeats; one that was first may become one
    was_first = old.join(fresh.select(*keys), keys, "left_semi").select("table_name", "field", "key", F.col("first").alias("at"))
    if rules.keys:
        own = reduce(lambda a, b: a | b, [(F.col("table_name") == t) & (F.col("field") == k) for t, k in rules.keys.items()])
        seen = declared.select(*keys, "at").unionByName(was_first).where(own)
        firsts = merged.select(*[F.col(c).alias(f"_{c}") for c in keys], "first")
        on = [F.col(c) == F.col(f"_{c}") for c in keys]
        repeats = seen.join(firsts, on).where(F.col("at") != F.col("first"))
        batch.append(REPEATS, repeats.select("table_name", "key", "at"), _schema(REPEATS))

    def first_of(table: str, field: str, asked: DataFrame, columns: list[str]) -> DataFrame:
        """State of the asked keys of a parent: after this batch for those it declares, else the stored one."""
        wanted = asked.select(F.lit(table).alias("table_name"), F.lit(field).alias("field"), "key").distinct()
        stored = _near(batch, wanted).join(merged.select(*keys), keys, "left_anti")
        own = merged.where((F.col("table_name") == table) & (F.col("field") == field))
        both = own.unionByName(stored.where((F.col("table_name") == table) & (F.col("field") == field)))
        return both.select(F.col("key").alias("_key"), *columns)

    early = []
    for ref in rules.references:
        child = of(ref.child).where(F.col(ref.foreign_key).isNotNull()).select(
            F.col(ref.foreign_key).alias("key"), F.col(ref.child_id).alias("child"), at
        )
        met = child.join(first_of(ref.parent, ref.primary_key, child, ["first"]), F.col("key") == F.col("_key"), "left")
        early.append(met.where(F.col("first").isNull() | (F.col("first") > F.col("at"))).select(
            F.lit(ref.kind).alias("kind"), F.lit(ref.parent).alias("parent"), F.lit(ref.primary_key).alias("field"), "key", "child", "at"
        ))
    if early:
        batch.append(EARLY, batch.kept(reduce(DataFrame.unionByName, early)), _schema(EARLY), skip_empty=True)
    if rules.capacity:
        parent, key, _, child_table, child_key = rules.capacity
        child = of(child_table).where(F.col(child_key).isNotNull()).select(F.col(child_key).alias("key"), at)
        met = child.join(first_of(parent, key, child, ["last"]), F.col("key") == F.col("_key"), "left")
        # a child before a declaration is never counted; one without a declaration may come after one that is late
        batch.append(CHILDREN, met.where(F.col("last").isNull() | (F.col("at") > F.col("last"))).select("key", "at"), _schema(CHILDREN), skip_empty=True)
    batch.append(BROKEN, of(QUARANTINE).select("path"), _schema(BROKEN), skip_empty=True)
    batch.upsert(PARENTS, merged.select(*_schema(PARENTS).fieldNames()), ["table_name", "field", "key"], ["last"], _schema(PARENTS))
    batch.commit()
    return True


def _near(batch: Batch, keys: DataFrame) -> DataFrame:
    """Stored parents in the buckets of these keys, and only the asked ones."""
    columns = ["table_name", "field", "key", "first", "last", "limit_text"]
    if PARENTS not in batch.store.manifest(batch.id - 1):
        return batch.store.spark.createDataFrame([], _schema(PARENTS)).select(*columns)
    near = batch.store.read_near(PARENTS, keys, batch.id - 1)
    return near.join(keys.distinct(), ["table_name", "field", "key"], "left_semi").select(*columns)


def arrival_state_issues(store: TableStore, rules: ArrivalRules) -> DataFrame:
    """The issues of :func:`~jsonloom.operators.arrival.arrival_issues` over all documents so far."""
    parents = store.read(PARENTS)
    repeats = store.read(REPEATS).where(F.col("table_name").isin(*rules.keys)).withColumn("path", F.col("at.path"))
    parts = [
        issue(repeats.where(F.col("table_name") == table), "duplicate_id", table, "key") for table in rules.keys
    ]
    firsts = parents.select(F.col("table_name").alias("_t"), F.col("field").alias("_f"), F.col("key").alias("_k"), "first")
    on = (F.col("parent") == F.col("_t")) & (F.col("field") == F.col("_f")) & (F.col("key") == F.col("_k"))
    early = store.read(EARLY).join(firsts, on, "left").where(F.col("first").isNull() | (F.col("first") > F.col("at")))
    early = early.withColumn("path", F.col("at.path"))
    for ref in rules.references:
        parts.append(issue(early.where(F.col("kind") == ref.kind), "orphan", ref.kind, "child", "key"))
    if rules.capacity:
        parent, key, *_ = rules.capacity
        current = parents.where((F.col("table_name") == parent) & (F.col("field") == key)).selectExpr(
            "key as _key", "last", "last.path as path", "coalesce(try_cast(limit_text as bigint), 0) as capacity"
        )
        after = store.read(CHILDREN).join(current, F.col("key") == F.col("_key")).where(F.col("at") > F.col("last"))
        counts = after.groupBy("key").agg(F.count(F.lit(1)).alias("enrolled"))
        over = current.join(counts, F.col("_key") == F.col("key"), "left").withColumn("enrolled", F.coalesce("enrolled", F.lit(0))).where("enrolled > capacity")
        info = details(enrolled="enrolled", capacity="capacity", violation="enrolled - capacity")
        parts.append(issue(over, "capacity", parent, "_key", info=info))
    parts.append(issue(store.read(BROKEN), "unreadable", "document", "null"))
    return reduce(DataFrame.unionByName, parts)


def compact_arrivals(store: TableStore, rules: ArrivalRules) -> None:
    """Drop children that a later declaration or a first sight has settled, and write each table's parts as one."""
    parents = store.read(PARENTS)
    with store.batch() as batch:
        firsts = parents.select(F.col("table_name").alias("_t"), F.col("field").alias("_f"), F.col("key").alias("_k"), "first")
        on = (F.col("parent") == F.col("_t")) & (F.col("field") == F.col("_f")) & (F.col("key") == F.col("_k"))
        early = store.read(EARLY).join(firsts, on, "left").where(F.col("first").isNull() | (F.col("first") > F.col("at")))
        batch.replace(EARLY, early.select(*_schema(EARLY).fieldNames()))
        if rules.capacity:
            last = parents.where((F.col("table_name") == rules.capacity[0]) & (F.col("field") == rules.capacity[1])).select(F.col("key").alias("_k"), "last")
            kept = store.read(CHILDREN).join(last, F.col("key") == F.col("_k"), "left").where(F.col("last").isNull() | (F.col("at") > F.col("last")))
            batch.replace(CHILDREN, kept.select("key", "at"))
        for table in (REPEATS, BROKEN):
            batch.compact(table)


def start_arrival(
    spark: SparkSession, source: str, store: TableStore, checkpoint: str, rules: ArrivalRules, stream: str, lines: bool = False,
    glob: str = "*.json", interval: str | None = None, max_files: int | None = None, large: int = LARGE_FILE,
) -> StreamingQuery:
    """Watch the files under ``source``; ``stream`` names this stream in the store, a new checkpoint needs a new name."""
    arrived = stream_files(spark, source, glob, max_files)

    def add(frame: DataFrame, epoch: int) -> None:
        paths = [row.path for row in frame.select("path").collect()]
        if paths:
            records = shred(read_documents(spark, paths, True, "*"), keep_rejects=True) if lines else shred_files(spark, paths, "*", keep_rejects=True, large=large)
            update_arrivals(store, records, rules, (stream, epoch))

    writer = arrived.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
