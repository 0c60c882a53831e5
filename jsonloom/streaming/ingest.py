"""Continuous ingest: a file stream merged into a table store, one micro-batch at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jsonloom.operators.contracts import Contract
from jsonloom.operators.large import LARGE_FILE, shred_files
from jsonloom.operators.quality.suite import Rules, count_checks, run_checks
from jsonloom.operators.shred import shred
from jsonloom.plans.catalog import discover
from jsonloom.plans.ingest import (
    METRICS, REJECT_COLUMNS, REJECTS, Extra, IngestOptions, ingest_contracts, ingest_records, initialize, stored_catalog,
)
from jsonloom.plans.incremental import recount_changes, update_checks
from jsonloom.plans.validate import recount
from jsonloom.sources.documents import read_documents, sample_documents, stream_files
from jsonloom.sources.reports import read_text, schema_documents, schema_markdown, write_text
from jsonloom.sources.store import Batch, BatchConflict, TableStore
from jsonloom.streaming.retries import record_outcomes, reject_rows, unreadable, waiting_files

QUALITY = "_quality"

# Called after a micro-batch is in the store: (store, stream, epoch). It may be called again for the
# same epoch after a failure, so it publishes under a token of its own.
AfterBatch = Callable[[TableStore, str, int], None]


def _stream_id(store: TableStore, checkpoint: str) -> str:
    """Name of the stream with this checkpoint, kept beside it.

    A stream with a new checkpoint has a new name, so its files are merged (again, if an older stream
    had merged them) and never taken for a replay.
    """
    path = f"{checkpoint.rstrip('/')}/stream_id.txt"
    kept = read_text(store.spark, path)
    if kept is None:
        kept = uuid.uuid4().hex
        write_text(store.spark, path, kept)
    return kept


def start_ingest(
    spark: SparkSession,
    source: str,
    store: TableStore,
    checkpoint: str,
    lines: bool = False,
    glob: str = "*.json",
    interval: str | None = None,
    max_files: int | None = None,
    archive_dir: str | None = None,
    options: IngestOptions = IngestOptions(),
    contracts: list[Contract] | None = None,
    after_batch: AfterBatch | None = None, large: int = LARGE_FILE,
) -> StreamingQuery:
    """Start the stream. Without ``interval`` it drains what is there and stops.

    The stream hands over the names of files that arrived, each once, and the store skips a batch it has published, so a
    restart repeats nothing. With ``contracts`` the documents are validated, otherwise tables are discovered; whole-file
    documents above ``large`` bytes are then read by several tasks. Malformed documents go to the reject table with their
    whole text. A file that cannot be read does not keep the others of its batch: the ledger ``_files`` has it wait, later
    batches try it again, and after three attempts it is a reject without text.
    """
    arrived = stream_files(spark, source, glob, max_files, archive_dir)
    stream = _stream_id(store, checkpoint)

    def merge(frame: DataFrame, epoch: int) -> None:
        paths = [row.path for row in frame.select("path").collect()]
        load_files(store, paths, lines, options, contracts, (stream, epoch), archive_dir, large)
        if after_batch is not None:
            after_batch(store, stream, epoch)

    writer = arrived.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def load_files(
    store: TableStore, paths: list[str], lines: bool = False, options: IngestOptions = IngestOptions(),
    contracts: list[Contract] | None = None, token: tuple[str, int] | None = None, archive_dir: str | None = None, large: int = LARGE_FILE,
) -> bool:
    """Load these files and those that wait for another attempt, as one batch. False when it had been published before.

    Call it without paths to try waiting files when no new ones come.
    """
    spark = store.spark
    if store.batch(token=token).published:
        return False
    attempts = waiting_files(store)
    # a waiting file may be in the archive by now
    asked = {path: _present(spark, path, archive_dir) for path in [*paths, *(p for p in attempts if p not in paths)]}
    if not asked:
        return False

    def load(failed: dict[str, str]) -> bool:
        good = [path for path in asked if path not in failed]
        where = [asked[path] for path in good]

        def extra(batch: Batch) -> tuple[DataFrame | None, int]:
            done = record_outcomes(batch, good, failed, attempts)
            return reject_rows(spark, done, failed, REJECT_COLUMNS), len(done)

        if contracts is not None or lines or not where:
            docs = read_documents(spark, where, lines, "*") if where else _no_documents(spark)
            if contracts is not None:
                return ingest_contracts(store, docs, None, contracts, token, Extra(extra))
            return ingest_records(store, lambda: shred(docs, keep_rejects=True, mark_documents=True), None, options, token, Extra(extra))
        settings = {"keep_rejects": True, "mark_documents": True, "large": large}
        return ingest_records(store, lambda: shred_files(spark, where, "*", **settings), None, options, token, Extra(extra))

    try:
        return load({})
    except BatchConflict:
        raise
    except Exception:  # noqa: BLE001 - a read error has many shapes; without an unreadable file it is raised again
        failed = unreadable(spark, list(asked.values()), lines)
        if not failed:
            raise
    return load({path: failed[place] for path, place in asked.items() if place in failed})


def _no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file_order bigint, path string, block_start bigint, text string, line_id bigint")


def _present(spark: SparkSession, path: str, archive_dir: str | None) -> str:
    """The path, or its place under the archive if it is there by now."""
    if archive_dir is None:
        return path
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return path
    return f"{archive_dir.rstrip('/')}{at.toUri().getPath()}"


def discover_then_ingest(
    spark: SparkSession, source: str, store: TableStore, checkpoint: str, sample_files: int = 50,
    sample_records: int = 100, lines: bool = False, glob: str = "*.json", **settings,
) -> StreamingQuery:
    """Two phases: discover the tables on a sample of files (and records of each table in them), then stream with that
    catalog."""
    if stored_catalog(store) is None:
        sample = sample_documents(spark, source, sample_files, lines, glob)
        initialize(store, discover(shred(sample, sample_records)))
    settings.setdefault("options", IngestOptions(frozen=True))
    return start_ingest(spark, source, store, checkpoint, lines, glob, **settings)


def check_each_batch(rules: Rules) -> AfterBatch:
    """Keep the quality counters of the store after every batch in the table ``_quality``."""

    def check(store: TableStore, stream: str, epoch: int) -> None:
        with store.batch(token=(f"{stream}/quality", epoch)) as batch:
            if not batch.published:
                counted = count_checks(run_checks(store.spark, store.read_all(), rules))
                batch.append(QUALITY, counted.selectExpr(f"bigint({batch.id}) as batch", "*").coalesce(1))

    return check


def check_changes(rules: Rules) -> AfterBatch:
    """:func:`check_each_batch` from what the batch changed: its cost follows the batch, not the store."""

    def check(store: TableStore, stream: str, epoch: int) -> None:
        update_checks(store, rules, (f"{stream}/quality", epoch), QUALITY)

    return check


def recount_each_batch(parent: str, key: str, child: str, child_key: str, column: str, whole: bool = False) -> AfterBatch:
    """Recount children after every batch: of the parents that the batch touched, or of all (``whole``)."""

    def count(store: TableStore, stream: str, epoch: int) -> None:
        run = recount if whole else recount_changes
        run(store, parent, key, child, child_key, column, (f"{stream}/recount", epoch))

    return count


def document_every(documents: int, folder: str, timestamp: Callable[[], str]) -> AfterBatch:
    """Write the schema documents after the first batch and then whenever another ``documents`` documents have come in."""

    def write(store: TableStore, stream: str, epoch: int) -> None:
        came = F.col("processed") + F.col("failed") + F.col("skipped")
        counts = store.read(METRICS).agg(F.sum(came).alias("all"), F.max_by(came, "batch").alias("last")).first()
        if counts["all"] is None:
            return
        before = counts["all"] - counts["last"]
        if before == 0 or counts["all"] // documents > before // documents:
            catalog = stored_catalog(store)
            schema, graph = schema_documents(catalog, timestamp())
            write_text(store.spark, f"{folder}/schema_documentation.json", schema)
            write_text(store.spark, f"{folder}/table_relationships.json", graph)
            write_text(store.spark, f"{folder}/DATA_STRUCTURE_README.md", schema_markdown(catalog, timestamp()))

    return write


def compact_every(batches: int, tables: tuple[str, ...] = (REJECTS, METRICS, QUALITY)) -> AfterBatch:
    """Compact tables that grow by one part per batch, after every ``batches`` batches."""

    def compact(store: TableStore, stream: str, epoch: int) -> None:
        if (epoch + 1) % batches == 0:
            with store.batch(token=(f"{stream}/compact", epoch)) as batch:
                for table in tables:
                    batch.compact(table)

    return compact


def in_turn(*hooks: AfterBatch) -> AfterBatch:
    """Several hooks after one batch."""

    def run(store: TableStore, stream: str, epoch: int) -> None:
        for hook in hooks:
            hook(store, stream, epoch)

    return run
