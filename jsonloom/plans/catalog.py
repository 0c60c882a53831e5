"""Discovery: from shredded records to a catalog of tables, fields, keys and relationships."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators import keys as K
from jsonloom.operators import profile as P
from jsonloom.operators.quality.suite import Rules
from jsonloom.sources.tables import references_of


def held(df: DataFrame) -> DataFrame:
    """Catalog rows (bounded by tables × fields) as a local relation, so they are computed once."""
    return df.sparkSession.createDataFrame(df.toArrow())


@dataclass
class Catalog:
    """Facts that merge across runs, and what follows from them."""

    table_facts: DataFrame
    field_facts: DataFrame
    mode: str = "default"
    plurals: str = "basic"

    @cached_property
    def profile(self) -> DataFrame:
        return held(P.field_profile(self.field_facts, self.table_facts, self.mode))

    @cached_property
    def primary_keys(self) -> DataFrame:
        return held(K.primary_keys(self.profile))

    @cached_property
    def foreign_keys(self) -> DataFrame:
        return held(
            K.foreign_keys(self.profile, self.table_facts, self.primary_keys, self.plurals, self.mode)
        )

    @property
    def relationships(self) -> DataFrame:
        return K.relationships(self.foreign_keys)

    @property
    def summary(self) -> DataFrame:
        return K.schema_summary(self.table_facts, self.profile, self.primary_keys, self.foreign_keys)

    def merge(self, other: Catalog) -> Catalog:
        """Both sets of facts together."""
        tables = P.merge_table_facts(self.table_facts.unionByName(other.table_facts))
        fields = P.merge_facts(self.field_facts.unionByName(other.field_facts))
        return Catalog(held(tables), held(fields), self.mode, self.plurals)

    def schemas(self) -> dict[str, T.StructType]:
        """Resolved schema of every table, in first-seen field order."""
        found: dict[str, list[tuple[str, str]]] = {r.table: [] for r in self.table_facts.select("table").collect()}
        for r in self.profile.select("table", "field", "data_type", "field_order").orderBy("table", "field_order").collect():
            found[r.table].append((r.field, r.data_type))
        return {table: P.spark_schema(fields) for table, fields in found.items()}

    def keys(self) -> dict[str, str]:
        return {r.table: r.primary_key for r in self.primary_keys.collect()}

    def rules(self) -> Rules:
        """Check rules that follow from the catalog alone."""
        return Rules(references=references_of(self.relationships), primary_keys=self.keys())


def discover(
    records: DataFrame, mode: str = "default", plurals: str = "basic", known: Catalog | None = None, stored: bool = False
) -> Catalog:
    """Profile shredded records (``stored``: as columns of files). ``mode="reference"`` and ``plurals`` select the type and
    naming rules.

    With ``known``, the catalog so far, sample values are looked up only for fields that lack them.
    """
    chunks = P.chunk_facts(records, stored)
    tables, facts = held(P.table_facts(chunks)), held(P.field_facts(chunks))
    wanted = None
    if known is not None:
        full = known.field_facts.where(F.size("samples") >= P.SAMPLES).select("table", "field")
        wanted = held(facts.select("table", "field").join(full, ["table", "field"], "left_anti"))
        if wanted.isEmpty():
            wanted_samples = facts.select("table", "field", F.array().cast(P.SAMPLES_TYPE).alias("samples"))
            return Catalog(tables, held(P.with_samples(facts, wanted_samples)), mode, plurals)
    samples = P.field_samples(records, chunks, wanted)
    return Catalog(tables, held(P.with_samples(facts, samples)), mode, plurals)


def completeness(catalog: Catalog) -> DataFrame:
    return K.catalog_completeness(catalog.summary)


def described_fields(catalog: Catalog) -> DataFrame:
    from jsonloom.functions.names import EXTENDED_DESCRIPTIONS

    return K.field_descriptions(catalog.profile, catalog.foreign_keys, EXTENDED_DESCRIPTIONS).select(
        "table", "field", "field_order", "data_types", "list_element_types", "data_type", "nullable", "is_list",
        "max_length", F.col("to_table").alias("foreign_key_to"), F.slice("samples", 1, 3).alias("sample_values"),
        "description",
    )
