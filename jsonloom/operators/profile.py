"""Field profiles of JSON records and type resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from jsonloom.functions.json_values import last_entries, named_type, parsed_entries, type_name
from jsonloom.operators.ordering import top_per_group
from jsonloom.operators.shred import RECORD_POSITION
from jsonloom.operators.sketches import column_sketches, sketched_profile
from jsonloom.session import cut_lineage

SAMPLES = 10
SCALARS = ("str", "int", "float", "bool", "dict")
ELEMENTS = (*SCALARS, "list")
FLAGS = [f"has_{t}" for t in (*SCALARS, "list")] + [f"of_{t}" for t in ELEMENTS]


# Where a table or field was first seen: file, block, and a number that orders the places in a block.
BLOCK = ["file_order", "path", "block_start"]
# line (33 bits), record and field (31 bits each) in one decimal: exact for every size, and hash aggregates take it
_PLACE = "cast(({}) & 8589934591 as decimal(10,0)) * cast(4611686018427387904 as decimal(19,0)) + cast({} as bigint) * 2147483648 + {}"
# Lines (2 ** 6) and records of a line (2 ** 13) whose values are summed up together.
LINE_BITS, RECORD_BITS = 6, 13
CHUNK = [*BLOCK, "line_chunk", "rec_chunk"]
SAMPLES_TYPE = "array<struct<at: struct<file_order: bigint, path: string, block_start: bigint, line_id: bigint, table_pos: int, rec_pos: int, pos: int>, sample: string>>"


def _values(records: DataFrame) -> DataFrame:
    """One row per field of every record, and one with nulls for a record without any: the columns beside ``record``,
    ``field, pos, value, type``."""
    kept = [c for c in records.columns if c != "record"]
    # parsed, and keys made one, in steps of their own: the generator would do both each time it names its fields
    parsed = records.select(*kept, parsed_entries(F.col("record")).alias("_parsed"))
    once = parsed.select(*kept, last_entries(F.col("_parsed")).alias("_entries"))
    fields = once.select(*kept, F.posexplode_outer("_entries").alias("pos", "f"))
    kinds = fields.select(
        *kept, "pos", F.col("f.key").alias("field"), F.col("f.value").alias("value"), F.schema_of_variant("f.value").alias("kind"),
    )
    return kinds.withColumn("type", named_type(F.col("kind"))).drop("kind")


# Two numbers stand for a block beside every field of stored records, 128 bits of hashes: file paths would be copied, hashed and compared there.
BLOCK_HASHES = {"block_a": F.xxhash64, "block_b": lambda order, path, start: F.xxhash64(F.lit("b"), start, path, order)}


def _hashed_blocks(records: DataFrame) -> DataFrame:
    return records.withColumns({name: hashed(*[F.col(c) for c in BLOCK]) for name, hashed in BLOCK_HASHES.items()})


def _in_chunks(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {"line_chunk": F.shiftright("line_id", LINE_BITS), "rec_chunk": F.shiftright("rec_pos", RECORD_BITS)}
    )


def chunk_facts(records: DataFrame, stored: bool = False) -> DataFrame:
    """Mergeable facts per table, field and chunk, from one pass over the records; kept in the shared folder.

    ``stored``: the records are read from stored columns, so that their blocks can be listed for next to nothing.

    Type sets are kept as bits: they combine before the shuffle like any other
    aggregate, and their size does not depend on the data. A record counts for its table where its first field is.
    """
    elements = F.when(
        F.col("type") == "list",
        F.array_distinct(F.transform(F.try_variant_get("value", "$", "array<variant>"), type_name)),
    )
    # a chunk's place fits a number: line (6 bits), record (13) and field (31)
    line, here = f"(line_id & {2 ** LINE_BITS - 1})", f"(rec_pos & {2 ** RECORD_BITS - 1})"
    block = [*BLOCK_HASHES] if stored else BLOCK
    chunked = _in_chunks(_hashed_blocks(records) if stored else records).withColumns(
        {"_near": F.expr(f"shiftleft(shiftleft({line}, {RECORD_BITS}) | {here}, 31)"), "_table_near": F.expr(f"shiftleft({line}, 31) | table_pos")}
    )
    here_only = ["table", *block, "line_chunk", "rec_chunk"]
    values = _values(chunked.select(*here_only, "_near", "_table_near", "record")).withColumns(
        {"elements": elements, "text": F.when(F.col("type") == "str", F.try_variant_get("value", "$", "string"))}
    )
    values = values.withColumn("bits", F.coalesce(_type_bits(), F.lit(0))).withColumn("near", F.expr("_near | coalesce(pos, 0)"))
    found = values.groupBy("field", *here_only).agg(
        F.expr("bit_or(bits) as bits"),
        F.expr("max(length(text)) as max_length"),
        F.expr("count(1) as present_count"),
        F.expr("count_if(type is null) as null_count"),
        F.expr("count_if(coalesce(pos, 0) = 0) as records"),
        F.expr("min(near) as near"),
        F.expr("min(if(type is null, null, near)) as value_near"),
        F.expr("max(if(type is null, null, near)) as last_near"),
        F.expr("min(_table_near) as table_near"),
    )
    if stored:
        found = found.join(_hashed_blocks(records.select(*BLOCK).distinct()), [*BLOCK_HASHES])
    first_line, first_record = f"shiftleft(line_chunk, {LINE_BITS})", f"shiftleft(cast(rec_chunk as bigint), {RECORD_BITS})"

    def place(near: str) -> Column:
        of_line = f"{first_line} | shiftright({near}, {31 + RECORD_BITS})"
        record = f"({first_record} | (shiftright({near}, 31) & {2 ** RECORD_BITS - 1}))"
        return F.expr(_PLACE.format(of_line, record, f"({near} & 2147483647)"))

    table_place = F.expr(_PLACE.format(f"{first_line} | shiftright(table_near, 31)", "0", "(table_near & 2147483647)"))
    flags = [(F.col("bits").bitwiseAND(1 << i) != 0).alias(flag) for i, flag in enumerate(FLAGS)]
    return cut_lineage(
        found.select(
            "table", "field", *CHUNK, *flags, (F.col("null_count") > 0).alias("nullable"), "max_length", "present_count", "null_count",
            "records", place("near").alias("place"), place("value_near").alias("value_place"), place("last_near").alias("last_place"),
            table_place.alias("table_place"),
        )
    )


def _type_bits() -> Column:
    """FLAGS of a value in one number: many maxima in an aggregate would be too much code to compile."""
    bit = {flag: 1 << i for i, flag in enumerate(FLAGS)}
    elements = sum((F.when(F.array_contains("elements", t), F.lit(bit[f"of_{t}"])).otherwise(F.lit(0)) for t in ELEMENTS), F.lit(bit["has_list"]))
    chain = F.when(F.col("type") == "list", elements)
    for t in SCALARS:
        chain = chain.when(F.col("type") == t, F.lit(bit[f"has_{t}"]))
    return chain


def table_facts(chunks: DataFrame) -> DataFrame:
    """``(table, record_count, first_seen)`` per table."""
    seen = F.min(F.struct(*BLOCK, F.col("table_place").alias("place"))).alias("first_seen")
    return chunks.groupBy("table").agg(F.sum("records").alias("record_count"), seen)


def field_facts(chunks: DataFrame) -> DataFrame:
    """Mergeable facts per (table, field)."""
    flags = [*FLAGS, "nullable", "max_length"]
    return chunks.where(F.col("field").isNotNull()).groupBy("table", "field").agg(
        *[F.max(f).alias(f) for f in flags], F.sum("present_count").alias("present_count"),
        F.sum("null_count").alias("null_count"), F.min(F.struct(*BLOCK, "place")).alias("first_seen"),
    )


def field_samples(records: DataFrame, chunks: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The first values of every field (of the fields in ``wanted``, a list of (table, field), if given).

    Of a field's chunks only the SAMPLES whose first values come first can hold one of its first SAMPLES values, and none
    that begins behind a chunk with so many. The records are read again in these alone; their list is bounded by the fields.
    """
    some = chunks.where(F.col("value_place").isNotNull())
    if wanted is not None:
        some = some.join(wanted, ["table", "field"], "left_semi")
    keys = ["table", "field"]
    near = top_per_group(some, keys, [F.col(c) for c in (*BLOCK, "value_place")], SAMPLES)
    enough = F.when(F.col("present_count") - F.col("null_count") >= SAMPLES, F.struct(*BLOCK, F.col("last_place").alias("place")))
    begins = F.struct(*BLOCK, F.col("value_place").alias("place"))
    near = near.withColumn("_enough", F.min(enough).over(Window.partitionBy(*keys)))
    near = near.where(F.col("_enough").isNull() | (begins <= F.col("_enough"))).select(*keys, "path", "block_start", "line_chunk", "rec_chunk")
    near = near.sparkSession.createDataFrame(near.toArrow())
    lines = F.concat_ws(":", "block_start", F.shiftright("line_id", LINE_BITS), "path")
    places = [r[0] for r in near.select(F.concat_ws(":", "block_start", "line_chunk", "path")).distinct().collect()]
    values = _in_chunks(_values(records.where(lines.isin(places)).select("table", *RECORD_POSITION, "record"))).where("type is not null")
    values = values.join(F.broadcast(near), near.columns, "left_semi")
    shown = F.when(F.col("type") == "str", F.try_variant_get("value", "$", "string")).otherwise(F.to_json("value"))
    at = F.struct(*RECORD_POSITION, "pos").alias("at")
    first = top_per_group(values.select(*keys, at, shown.alias("sample")), keys, [F.col("at")], SAMPLES)
    return first.groupBy(*keys).agg(F.expr("array_sort(collect_list(struct(at, sample))) as samples"))


def with_samples(facts: DataFrame, samples: DataFrame) -> DataFrame:
    """Facts with the samples of their fields, empty where there are none."""
    joined = facts.join(samples, ["table", "field"], "left")
    return joined.withColumn("samples", F.coalesce("samples", F.array().cast(SAMPLES_TYPE)))


def merge_facts(facts: DataFrame) -> DataFrame:
    """Combine facts of several discovery runs: types add up, nullable only turns on, first samples stay."""
    flags = [*FLAGS, "nullable"]
    samples = F.slice(F.array_sort(F.flatten(F.collect_list("samples"))), 1, SAMPLES)  # ≤ 10 per run
    return facts.groupBy("table", "field").agg(
        *[F.max(f).alias(f) for f in flags],
        F.max("max_length").alias("max_length"),
        F.sum("present_count").alias("present_count"),
        F.sum("null_count").alias("null_count"),
        F.min("first_seen").alias("first_seen"),
        samples.alias("samples"),
    )


def merge_table_facts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("table").agg(
        F.sum("record_count").alias("record_count"), F.min("first_seen").alias("first_seen")
    )


def resolve_type(mode: str = "default") -> Column:
    """Spark type of a profiled field.

    Default: a field that mixes text, numbers or booleans is text, so no value is lost. ``mode="reference"``
    lets a number win over text and booleans, and a list take text, then int, then float.
    """
    has = {t: F.coalesce(F.col(f"has_{t}"), F.lit(False)) for t in (*SCALARS, "list")}
    of = {t: F.coalesce(F.col(f"of_{t}"), F.lit(False)) for t in ELEMENTS}
    if mode == "reference":
        return (
            F.when(
                has["list"],
                F.when(of["str"], "array<string>").when(of["int"], "array<bigint>")
                .when(of["float"], "array<double>").otherwise("array<string>"),
            )
            .when(has["int"] & ~has["float"], "bigint")
            .when(has["float"], "double")
            .when(has["bool"], "boolean")
            .otherwise("string")
        )
    number, of_number = has["int"] | has["float"], of["int"] | of["float"]
    not_number = of["str"] | of["bool"] | of["dict"] | of["list"]
    return (
        F.when(has["list"] & (number | has["str"] | has["bool"] | has["dict"]), "string")
        .when(
            has["list"],
            F.when(of_number & ~not_number, F.when(of["float"], "array<double>").otherwise("array<bigint>"))
            .when(of["bool"] & ~(of_number | of["str"] | of["dict"] | of["list"]), "array<boolean>")
            .otherwise("array<string>"),
        )
        .when(has["str"] | has["dict"], "string")
        .when(number & has["bool"], "string")
        .when(has["float"], "double")
        .when(has["int"], "bigint")
        .when(has["bool"], "boolean")
        .otherwise("string")
    )


def field_profile(facts: DataFrame, tables: DataFrame, mode: str = "default") -> DataFrame:
    """Readable profile, one row per (table, field) in first-seen order."""

    def names(prefix: str, types) -> Column:
        return F.array_compact(F.array(*[F.when(F.col(f"{prefix}_{t}"), F.lit(t)) for t in types]))

    order = F.row_number().over(Window.partitionBy("table").orderBy("first_seen"))
    return (
        facts.withColumn("field_order", order)
        .join(tables.select("table", "record_count"), "table")
        .select(
            "table", "field", "field_order",
            names("has", SCALARS).alias("data_types"),
            "nullable",
            F.coalesce("has_list", F.lit(False)).alias("is_list"),
            names("of", ELEMENTS).alias("list_element_types"),
            "max_length",
            resolve_type(mode).alias("data_type"),
            F.col("samples.sample").alias("samples"),
            "record_count", "present_count", "null_count",
            (F.col("record_count") - F.col("present_count")).alias("missing_count"),
        )
    )


def column_profile(df: DataFrame, table: str, approximate: bool = False) -> DataFrame:
    """Profile of a typed table: one row per column from a single pass with exact distinct counts per value.

    ``approximate`` estimates these from sketches; no value is shuffled then.
    """
    if approximate:
        return sketched_profile(column_sketches(df, table))
    from jsonloom.operators.quality.distribution import value_counts

    counts = value_counts(df, df.columns)
    return counts.groupBy("field").agg(
        F.sum("n").alias("record_count"),
        F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), F.lit(0)).alias("null_count"),
        F.max(F.length("text_value")).cast("bigint").alias("max_length"),
        F.count(F.when(~F.col("is_null"), F.lit(1))).alias("unique_values"),
    ).withColumn("table", F.lit(table))


def spark_schema(fields: list[tuple[str, str]]) -> T.StructType:
    """``[(field, type name)]`` as a schema; every column is nullable."""
    return T.StructType([T.StructField(n, T._parse_datatype_string(t), True) for n, t in fields])
