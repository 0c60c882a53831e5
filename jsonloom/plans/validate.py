"""Quality validation of a table store or of given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.operators.metrics import table_stats
from jsonloom.operators.quality.suite import Rules, load_failure, run_checks, summarize
from jsonloom.operators.relate import with_child_count
from jsonloom.plans.catalog import held
from jsonloom.sources.reports import quality_report_json, quality_report_markdown, write_text
from jsonloom.sources.store import TableStore


@dataclass
class Validation:
    checks: DataFrame
    summary: DataFrame

    def write(self, spark: SparkSession, folder: str, timestamp: str) -> None:
        """JSON and Markdown reports."""
        write_text(spark, f"{folder}/data_quality_report.json", quality_report_json(self.checks, self.summary, timestamp))
        write_text(spark, f"{folder}/QUALITY_REPORT.md", quality_report_markdown(self.checks, self.summary, timestamp))


def validate(spark: SparkSession, tables: dict[str, DataFrame] | None, rules: Rules) -> Validation:
    """Run the suite once; ``tables`` is None when a table could not be read."""
    if tables is None:
        checks = held(load_failure(spark))
        return Validation(checks, summarize(checks, 0, 0, len(rules.references)))
    checks = held(run_checks(spark, tables, rules))  # as many rows as checks
    records = table_stats(tables).agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0] if tables else 0
    return Validation(checks, summarize(checks, len(tables), records, len(rules.references)))


def recount(
    store: TableStore, parent: str, key: str, child: str, child_key: str, column: str,
    token: tuple[str, int] | None = None,
) -> bool:
    """Rewrite the child count kept in a parent table. False, and no change, when a table or key is absent."""
    batch = store.batch(token=token)
    if batch.published or parent not in batch.entries or child not in batch.entries:
        return False
    parents, children = store.read(parent), store.read(child)
    if key not in parents.columns or child_key not in children.columns:
        return False
    with batch:
        batch.replace(parent, with_child_count(parents, key, children, child_key, column))
    return True
