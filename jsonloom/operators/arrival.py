"""Integrity of a stream of records in the order they arrived."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.scores import arrival_score
from jsonloom.operators.quality.rows import details, name, text
from jsonloom.operators.relate import count_since_reset, last_declaration, repeated_occurrences, unseen_parents
from jsonloom.operators.shred import QUARANTINE, RECORD_POSITION
from jsonloom.session import scratch_path


@dataclass(frozen=True)
class ArrivalReference:
    """``child.foreign_key`` must have arrived in ``parent.primary_key`` before."""

    kind: str
    child: str
    foreign_key: str
    parent: str
    primary_key: str
    child_id: str


@dataclass(frozen=True)
class ArrivalRules:
    """What to look for in the stream; ``capacity`` is (parent, key, limit, child, child key)."""

    keys: dict[str, str] = field(default_factory=dict)
    references: tuple[ArrivalReference, ...] = ()
    capacity: tuple[str, str, str, str, str] | None = None


    def columns(self) -> dict[str, list[str]]:
        """Fields read from each table."""
        needed: dict[str, dict[str, None]] = {}
        for table, key in self.keys.items():
            needed.setdefault(table, {})[key] = None
        for ref in self.references:
            needed.setdefault(ref.child, {}).update({ref.child_id: None, ref.foreign_key: None})
            needed.setdefault(ref.parent, {})[ref.primary_key] = None
        if self.capacity:
            parent, key, limit, child, child_key = self.capacity
            needed.setdefault(parent, {}).update({key: None, limit: None})
            needed.setdefault(child, {})[child_key] = None
        return {table: list(fields) for table, fields in needed.items()}


def entity_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("table").agg(F.count(F.lit(1)).alias("n"))


def arrival_rows(records: DataFrame, rules: ArrivalRules) -> DataFrame:
    """The fields the rules need, as text, with the position of their record.

    They are taken out of the JSON once and kept as a table in the shared folder, with a folder per table;
    every rule then reads only its own table and columns.
    """
    needed = rules.columns()
    names = list(dict.fromkeys(n for fields in needed.values() for n in fields))
    schema = ", ".join(f"{name(n)} string" for n in names)
    wanted = F.col("table").isin(QUARANTINE, *needed)
    # empty text counts as absent
    fields = [f"nullif(_f.{name(n)}, '') as {name(n)}" for n in names]
    rows = records.where(wanted).withColumn("_f", F.from_json("record", schema)).selectExpr(*RECORD_POSITION, "table", *fields)
    path = scratch_path(records.sparkSession, "arrival")
    rows.withColumn("_table", F.col("table")).write.partitionBy("_table").parquet(path)
    read = T.StructType([*rows.schema.fields, T.StructField("_table", T.StringType())])
    return records.sparkSession.read.schema(read).parquet(path)


def _of(rows: DataFrame, table: str, fields: list[str]) -> DataFrame:
    return rows.where(F.col("_table") == table).select(*RECORD_POSITION, *dict.fromkeys(fields))


def issue(rows: DataFrame, label: str, kind: str, key: str, missing: str = "null", info: str = details()) -> DataFrame:
    return rows.selectExpr(
        f"{text(label)} as issue", f"{text(kind)} as kind", f"cast({key} as string) as id",
        f"cast({missing} as string) as missing", "path as file", f"{info} as details",
    )


def duplicate_ids(rows: DataFrame, rules: ArrivalRules) -> list[DataFrame]:
    """Every repeat of a declared id."""
    return [
        issue(repeated_occurrences(_of(rows, table, [key]), key, RECORD_POSITION), "duplicate_id", table, name(key))
        for table, key in rules.keys.items()
    ]


def arrival_orphans(rows: DataFrame, rules: ArrivalRules) -> list[DataFrame]:
    """References to a parent that had not arrived yet."""
    out = []
    for ref in rules.references:
        child = _of(rows, ref.child, [ref.child_id, ref.foreign_key])
        parent = _of(rows, ref.parent, [ref.primary_key]).withColumnRenamed(ref.primary_key, "_parent")
        early = unseen_parents(child, ref.foreign_key, parent, "_parent", RECORD_POSITION)
        out.append(issue(early, "orphan", ref.kind, name(ref.child_id), name(ref.foreign_key)))
    return out


def arrival_violations(rows: DataFrame, rules: ArrivalRules) -> list[DataFrame]:
    """Parents with more children since their last declaration than it allows."""
    if rules.capacity is None:
        return []
    parent, key, limit, child, child_key = rules.capacity
    declared, children = _of(rows, parent, [key, limit]), _of(rows, child, [child_key])
    enrolled = count_since_reset(declared, key, children, child_key, RECORD_POSITION, "enrolled")
    current = last_declaration(declared, key, RECORD_POSITION).selectExpr(
        f"{name(key)} as _key", "path", f"coalesce(try_cast({name(limit)} as bigint), 0) as capacity"
    )
    over = current.join(enrolled, F.col("_key") == F.col(key)).where("enrolled > capacity")
    info = details(enrolled="enrolled", capacity="capacity", violation="enrolled - capacity")
    return [issue(over, "capacity", parent, "_key", info=info)]


def arrival_issues(records: DataFrame, rules: ArrivalRules) -> DataFrame:
    """All issues of a stream of shredded records, one row each.

    Records shredded with ``keep_rejects`` bring the unreadable documents along.
    """
    rows = arrival_rows(records, rules)
    parts = duplicate_ids(rows, rules) + arrival_orphans(rows, rules) + arrival_violations(rows, rules)
    parts.append(issue(_of(rows, QUARANTINE, []), "unreadable", "document", "null"))
    return reduce(DataFrame.unionByName, parts)


def score_issues(issues: DataFrame) -> DataFrame:
    """Counts per kind of issue and the integrity score."""
    counts = issues.agg(
        F.expr("count_if(issue = 'duplicate_id') as duplicate_ids"),
        F.expr("count_if(issue = 'orphan') as orphaned_references"),
        F.expr("count_if(issue = 'capacity') as capacity_violations"),
        F.expr("count_if(issue = 'unreadable') as unreadable_files"),
    )
    score = arrival_score(
        F.col("duplicate_ids"), F.col("orphaned_references"), F.col("capacity_violations"), F.col("unreadable_files")
    )
    return counts.withColumn("integrity_score", score)


METRICS = ["integrity_score", "orphaned_references", "capacity_violations", "duplicate_ids", "unreadable_files"]


def compare_metrics(first: DataFrame, second: DataFrame, metrics: list[str]) -> DataFrame:
    """Two one-row metric tables side by side: ``(metric, first, second, difference)``."""

    def long(df, label):
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(label)) for m in metrics])
        return df.select(F.explode(cells).alias("c")).select("c.*")

    joined = long(first, "first").join(long(second, "second"), "metric", "full_outer")
    return joined.withColumn("difference", F.col("second") - F.col("first"))
