"""Ingest of one batch of documents into a table store."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.contracts import Contract, check_documents, document_records
from jsonloom.operators.large import LARGE_FILE, shred_files
from jsonloom.operators.quality.rows import text
from jsonloom.operators.shred import DOCUMENT, QUARANTINE, RECORD_POSITION, shred, typed_records
from jsonloom.plans.catalog import Catalog, discover
from jsonloom.sources.documents import DOC_POSITION
from jsonloom.sources.store import Batch, TableStore

REJECTS = "_rejects"
METRICS = "_metrics"
CATALOG_TABLES, CATALOG_FIELDS = "_catalog_tables", "_catalog_fields"

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("batch", T.LongType()), T.StructField("processed", T.LongType()),
        T.StructField("failed", T.LongType()), T.StructField("skipped", T.LongType()),
        T.StructField("started_at", T.TimestampType()), T.StructField("finished_at", T.TimestampType()),
    ]
)
REJECT_COLUMNS = [*RECORD_POSITION, "table", "reason", "record"]


@dataclass(frozen=True)
class IngestOptions:
    """``frozen``: only tables of the stored catalog are loaded, its types are not changed.

    ``parallel_tables`` merges run at a time; each is a Spark job of its own.
    """

    frozen: bool = False
    mode: str = "default"
    plurals: str = "basic"
    parallel_tables: int = 4


def stored_catalog(store: TableStore, options: IngestOptions = IngestOptions(), batch: int | None = None) -> Catalog | None:
    if CATALOG_FIELDS not in store.manifest(batch):
        return None
    return Catalog(
        store.read(CATALOG_TABLES, batch), store.read(CATALOG_FIELDS, batch), options.mode, options.plurals
    )


def save_catalog(batch: Batch, catalog: Catalog) -> None:
    batch.replace(CATALOG_TABLES, catalog.table_facts.coalesce(1))
    batch.replace(CATALOG_FIELDS, catalog.field_facts.coalesce(1))


def initialize(store: TableStore, catalog: Catalog) -> None:
    """Publish a catalog with an empty typed table for every table it knows."""
    keys = catalog.keys()
    with store.batch() as batch:
        save_catalog(batch, catalog)
        for table, schema in catalog.schemas().items():
            key = keys.get(table)
            batch.create(table, schema, [key] if key else None)


def _staged(store: TableStore, records: DataFrame, version: str) -> DataFrame:
    """One pass over the input: records land in a folder per table, from which everything else reads."""
    path = f"{store.root}/_staging/{version}"
    records.withColumn("_table", F.col("table")).write.mode("overwrite").partitionBy("_table").parquet(path)
    # the folder name may look like a number; the column inside keeps the name as it is
    return store.spark.read.option("basePath", path).schema(
        T.StructType([*records.schema.fields, T.StructField("_table", T.StringType())])
    ).parquet(path)


def _drop_staging(store: TableStore, version: str) -> None:
    for name in (version, f"{version}_typed"):
        store._fs().delete(store._path("_staging", name), True)


@dataclass
class Extra:
    """What goes into a batch beside its documents: ``write`` is called with the batch before it is published, and returns rejects (or
    None) and the number of documents that failed with them."""

    write: Callable[[Batch], tuple[DataFrame | None, int]]


def ingest_documents(
    store: TableStore, docs: DataFrame, batch_id: int | None = None, options: IngestOptions = IngestOptions(),
    token: tuple[str, int] | None = None,
) -> bool:
    """Shred, type and merge a batch; False when it had been published before.

    All tables of the batch, its rejects, its catalog and its counters become visible together.
    """
    return ingest_records(store, lambda: shred(docs, keep_rejects=True, mark_documents=True), batch_id, options, token)


def ingest_files(
    store: TableStore, path: str | list[str], glob: str = "*.json", recursive: bool = False, batch_id: int | None = None,
    options: IngestOptions = IngestOptions(), token: tuple[str, int] | None = None, large: int = LARGE_FILE,
) -> bool:
    """:func:`ingest_documents` for whole-file documents of any size; files above ``large`` bytes are read by several tasks."""

    def records() -> DataFrame:
        return shred_files(store.spark, path, glob, recursive, keep_rejects=True, mark_documents=True, large=large)

    return ingest_records(store, records, batch_id, options, token)


def ingest_records(
    store: TableStore, records_of: Callable[[], DataFrame], batch_id: int | None = None, options: IngestOptions = IngestOptions(),
    token: tuple[str, int] | None = None, extra: Extra | None = None,
) -> bool:
    """Type and merge the shredded records (with rejects and document marks) that ``records_of`` gives."""
    batch = store.batch(batch_id, token)
    if batch.published:
        return False
    batch_id = batch.id
    started = datetime.now(timezone.utc)
    staged = _staged(store, records_of(), batch.version)
    records = staged.where(~F.col("_table").isin(QUARANTINE, DOCUMENT) & F.col("reason").isNull()).drop("_table")

    before = stored_catalog(store, options, batch_id - 1)
    if options.frozen and before is not None:
        catalog = before
    else:
        found = discover(records, options.mode, options.plurals, before, stored=True)
        catalog = before.merge(found) if before is not None else found
        save_catalog(batch, catalog)
    schemas, keys = catalog.schemas(), catalog.keys()
    present = {r[0] for r in staged.select("_table").distinct().collect()} - {QUARANTINE, DOCUMENT}
    known = sorted(present & set(schemas))

    order = [f"_at_{c}" for c in RECORD_POSITION]

    def typed(table: str) -> DataFrame:
        """Typed records, parsed once and kept as files for the merge and for the rejects."""
        rows = staged.where((F.col("_table") == table) & F.col("reason").isNull()).select(
            *[F.col(c).alias(f"_at_{c}") for c in RECORD_POSITION], "record"
        )
        parsed = typed_records(rows, schemas[table], keep=[*order, "record"])
        path = f"{store.root}/_staging/{batch.version}_typed/{known.index(table)}"
        parsed.selectExpr(
            *[c for c in parsed.columns if c not in ("record", "lost_fields")], "size(lost_fields) > 0 as _lost",
            "if(size(lost_fields) > 0, record, null) as _record", "array_join(lost_fields, ', ') as _fields",
        ).write.mode("overwrite").parquet(path)
        return store.spark.read.parquet(path)

    def load(table: str) -> DataFrame:
        rows = typed(table)
        good = rows.where("not _lost").drop("_lost", "_record", "_fields")
        key = keys.get(table)
        stored_key = batch.entries[table].key if table in batch.entries else None
        if stored_key or (key and table not in batch.entries):
            batch.upsert(table, good, stored_key or [key], order, schemas[table])
        else:
            batch.append(table, good.drop(*order), schemas[table])
        return rows.where("_lost").selectExpr(
            *[f"_at_{c} as {c}" for c in RECORD_POSITION], f"{text(table)} as table",
            "concat('value does not fit its type: ', _fields) as reason", "_record as record",
        )

    with ThreadPoolExecutor(options.parallel_tables) as pool:
        lost = list(pool.map(load, known))

    rejects = staged.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)
    more, failed = extra.write(batch) if extra else (None, 0)
    lost += [more] if more is not None else []
    batch.append(REJECTS, reduce(DataFrame.unionByName, lost, rejects), skip_empty=True)
    _count(batch, staged, started, sorted(present - set(schemas)), failed)
    batch.commit()
    _drop_staging(store, batch.version)
    return True


def _count(batch: Batch, staged: DataFrame, started: datetime, unknown: list[str], failed: int = 0) -> None:
    """Every document counts once: failed if it is no JSON object, skipped if all its tables are unknown, else processed
    (also one without records)."""
    per_document = staged.groupBy(*DOC_POSITION).agg(
        F.max(F.col("_table") == QUARANTINE).alias("bad"),
        F.coalesce(F.min(F.when(F.col("_table") != DOCUMENT, F.col("_table").isin(unknown))), F.lit(False)).alias("foreign"),
    )
    counts = per_document.agg(
        F.count(F.when(~F.col("bad") & ~F.col("foreign"), F.lit(1))).alias("processed"),
        F.count(F.when(F.col("bad"), F.lit(1))).alias("failed"),
        F.count(F.when(~F.col("bad") & F.col("foreign"), F.lit(1))).alias("skipped"),
    ).first()
    finished = datetime.now(timezone.utc)
    row = [(batch.id, counts.processed, counts.failed + failed, counts.skipped, started, finished)]
    batch.append(METRICS, batch.store.spark.createDataFrame(row, METRICS_SCHEMA))


def ingest_contracts(
    store: TableStore, docs: DataFrame, batch_id: int | None, contracts: list[Contract],
    token: tuple[str, int] | None = None, extra: Extra | None = None, scope: str = "document",
) -> bool:
    """Validated ingest with declared schemas: a document with one bad record is rejected whole, or (``scope="record"``) the
    record alone."""
    batch = store.batch(batch_id, token)
    if batch.published:
        return False
    batch_id = batch.id
    started = datetime.now(timezone.utc)
    path = f"{store.root}/_staging/{batch.version}"
    check_documents(docs, contracts, scope).write.mode("overwrite").parquet(path)
    checked = store.spark.read.parquet(path)
    order = [*DOC_POSITION, "rec_pos"]
    for contract in contracts:
        rows = document_records(checked, contract)
        batch.create(contract.table, contract.schema, [contract.key])
        batch.upsert(contract.table, rows, [contract.key], order, contract.schema)
    rejects = checked.where(F.size("violations") > 0).select(
        *DOC_POSITION, F.lit(0).alias("table_pos"), F.lit(0).alias("rec_pos"), F.lit(QUARANTINE).alias("table"),
        F.array_join("violations", "; ").alias("reason"), F.col("text").alias("record"),
    )
    more, failed = extra.write(batch) if extra else (None, 0)
    rejects = rejects.select(*REJECT_COLUMNS)
    if scope == "record":
        alone = checked.where("size(violations) = 0").select(*DOC_POSITION, F.explode("rejected").alias("r"))
        rejects = rejects.unionByName(alone.select(*DOC_POSITION, F.lit(0).alias("table_pos"), "r.rec_pos", "r.table", "r.reason", "r.record"))
    batch.append(REJECTS, rejects if more is None else rejects.unionByName(more), skip_empty=True)
    counts = checked.agg(
        F.count(F.when(F.size("violations") == 0, F.lit(1))).alias("processed"),
        F.count(F.when(F.size("violations") > 0, F.lit(1))).alias("failed"),
    ).first()
    row = [(batch_id, counts.processed, counts.failed + failed, 0, started, datetime.now(timezone.utc))]
    batch.append(METRICS, store.spark.createDataFrame(row, METRICS_SCHEMA))
    batch.commit()
    _drop_staging(store, batch.version)
    return True
