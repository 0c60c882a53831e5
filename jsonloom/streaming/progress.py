"""Progress and errors of running streams, kept in the store beside the ingest counters."""

from __future__ import annotations

import json
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from jsonloom.sources.store import TableStore

PROGRESS = "_progress"
PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()), T.StructField("run", T.StringType()),
        T.StructField("batch", T.LongType()), T.StructField("event", T.StringType()),
        T.StructField("at", T.StringType()), T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()), T.StructField("rows_per_second", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """Collects a row per trigger and one per end of a query; :meth:`save` appends them to the store.

    Add it with ``spark.streams.addListener`` before the queries start. Rows that are not saved yet wait in the driver, a few
    hundred bytes each.
    """

    def __init__(self):
        self._rows: list[tuple] = []
        self._lock = Lock()

    def _add(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        self._add((str(event.id), str(event.runId), None, "started", event.timestamp, None, None, None, None))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        self._add(
            (
                p["id"], p["runId"], p["batchId"], "progress", p["timestamp"], sum(s["numInputRows"] for s in p["sources"]),
                p.get("batchDuration"), _number(p.get("processedRowsPerSecond")), None,
            )
        )

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        error = event.exception.split("\n")[0][:500] if event.exception else None
        self._add((str(event.id), str(event.runId), None, "ended", None, None, None, None, error))

    def rows(self) -> list[tuple]:
        with self._lock:
            return list(self._rows)

    def save(self, store: TableStore) -> int:
        """Append what came since the last call to the table ``_progress``; the number of rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            with store.batch() as batch:
                batch.append(PROGRESS, store.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1))
        return len(rows)


def _number(value) -> float | None:
    """JSON has no infinities; Spark writes them as text."""
    return float(value) if isinstance(value, (int, float)) else None


def progress_summary(progress: DataFrame) -> DataFrame:
    """Per query: batches with rows, input rows, time spent, the last error."""
    return progress.groupBy("query").agg(
        F.count_distinct(F.when(F.col("input_rows") > 0, F.col("batch"))).alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("duration_ms"),
        F.max("error").alias("last_error"),
    )
