"""Files that cannot be read: found among the others, tried again with later batches, set aside in the end."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.shred import QUARANTINE
from jsonloom.sources.documents import read_documents
from jsonloom.sources.store import Batch, TableStore

FILES = "_files"
#: a file is set aside when this many batches could not read it; fixed value
MAX_ATTEMPTS = 3
WAITING, LOADED, SET_ASIDE = "waiting", "loaded", "set aside"

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("state", T.StringType()),
        T.StructField("error", T.StringType()), T.StructField("batch", T.LongType()),
    ]
)
#: groups that are read side by side while a batch's bad files are looked for
GROUPS = 8


def waiting_files(store: TableStore) -> dict[str, int]:
    """Files that wait for another attempt, and the attempts so far."""
    if FILES not in store.manifest():
        return {}
    rows = store.read(FILES).where(F.col("state") == WAITING).select("path", "attempts").collect()
    return {row.path: row.attempts for row in rows}


def unreadable(spark: SparkSession, paths: list[str], lines: bool = False) -> dict[str, str]:
    """The files among ``paths`` that raise an error when read to their end, and the error.

    Groups are read as a whole; only a group that fails is taken apart, so a few bad files among many cost a few small reads
    of their neighbours. Reading is as for ingest, so what this finds good can be loaded.
    """

    def error_of(group: list[str]) -> str | None:
        try:
            read_documents(spark, group, lines, "*").agg(F.sum(F.octet_length("text"))).collect()
        except Exception as error:  # noqa: BLE001 - whatever the reader raises is the file's error
            return str(error).strip().split("\n")[0][:500] or type(error).__name__
        return None

    bad: dict[str, str] = {}
    step = max(1, -(-len(paths) // GROUPS))
    open_groups = [paths[i : i + step] for i in range(0, len(paths), step)]
    with ThreadPoolExecutor(GROUPS) as pool:
        while open_groups:
            parts = []
            for group, error in zip(open_groups, pool.map(error_of, open_groups)):
                if error is None:
                    continue
                if len(group) == 1:
                    bad[group[0]] = error
                else:
                    middle = len(group) // 2
                    parts += [group[:middle], group[middle:]]
            open_groups = parts
    return bad


def record_outcomes(batch: Batch, loaded: list[str], failed: dict[str, str], attempts: dict[str, int]) -> list[str]:
    """Write the outcome of waiting and failed files into the ledger; the files that are set aside now."""
    rows = [(path, attempts[path] + 1, LOADED, None, batch.id) for path in loaded if path in attempts]
    done = []
    for path, error in failed.items():
        tried = attempts.get(path, 0) + 1
        if tried >= MAX_ATTEMPTS:
            done.append(path)
        rows.append((path, tried, SET_ASIDE if tried >= MAX_ATTEMPTS else WAITING, error, batch.id))
    if rows:
        ledger = batch.store.spark.createDataFrame(rows, LEDGER)
        batch.upsert(FILES, ledger, ["path"], ["batch"], LEDGER)
    return done


def reject_rows(spark: SparkSession, paths: list[str], failed: dict[str, str], columns: list[str]) -> DataFrame | None:
    """Files that are set aside, as rejects without text."""
    if not paths:
        return None
    rows = spark.createDataFrame([(p, f"unreadable in {MAX_ATTEMPTS} attempts: {failed[p]}") for p in paths], "path string, reason string")
    nothing = {"file_order": "bigint", "block_start": "bigint", "line_id": "bigint", "table_pos": "int", "rec_pos": "int"}
    filled = rows.withColumns({c: F.lit(0).cast(t) for c, t in nothing.items()} | {"table": F.lit(QUARANTINE), "record": F.lit(None).cast("string")})
    return filled.select(*columns)
