"""Shred JSON documents into table records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.json_values import TEXT_RULES, is_json, is_object, last_entries, last_key_wins, one_object
from jsonloom.sources.documents import DOC_POSITION

# Position of a record in arrival order.
RECORD_POSITION = DOC_POSITION + ["table_pos", "rec_pos"]

QUARANTINE = "_quarantine"
# Table of the one row per document that ``mark_documents`` adds.
DOCUMENT = "_document"
VALUES = "array<struct<key: string, value: variant>>"
# A string of an object that may look like a list or an object; in a text without one, the first character tells kinds.
LOOKALIKE = r':[ \t\r\n]*"[\[{\\]'


def _bodies(docs: DataFrame) -> DataFrame:
    """Add the entries of the object that holds the tables (the envelope is unwrapped): as text and as variants."""
    last_key_wins(docs.sparkSession)
    text = F.col("text")
    read = docs.withColumn("_top", one_object(text))
    datas = F.filter(F.map_entries("_top"), lambda e: e["key"] == "data")
    data = F.try_element_at(datas, F.lit(-1))["value"]
    # text that looks like an object may be a string; a string does not parse as entries
    entries = F.from_json(text, "data map<string,string>", TEXT_RULES)["data"]
    values = F.map_entries(F.from_json(text, "map<string,variant>", TEXT_RULES))
    last = F.try_element_at(F.filter(values, lambda e: e["key"] == "data"), F.lit(-1))["value"]
    # of repeated keys the last counts, which may be no object after one that is
    inner = F.when(data.startswith("{") & ((F.size(datas) == 1) | is_object(last)), entries)
    read = read.withColumns({"_ok": F.col("_top").isNotNull(), "_inner": inner, "_data": data})
    read = read.withColumn("_enveloped", F.col("_inner").isNotNull()).withColumn("_body", F.when(F.col("_enveloped"), F.col("_data")).otherwise(text))
    read = read.withColumn("_alike", F.col("_body").rlike(LOOKALIKE))
    values = F.when(F.col("_alike"), F.from_json("_body", "map<string,variant>", TEXT_RULES))
    return read.withColumns({"_texts": F.coalesce("_inner", "_top"), "_values": values}).drop("_top", "_inner", "_data")


def _entry(e, v):
    """An entry with its text and value. A variant holds 128 MiB; where a value is larger than that, and so none of its object has
    a variant, JSON paths tell a list or an object from a string that only looks like one."""
    path = F.concat(F.lit("$['"), e["key"], F.lit("']"))
    listed = F.call_function("get_json_object", F.col("_body"), F.concat(path, F.lit("[*]"))).isNotNull()
    # a string's text would have its quotes escaped in the object's text
    object_text = F.concat(F.lit(":"), F.substring(e["value"], 1, 64))
    nested = F.when(e["value"].startswith("["), listed).when(e["value"].startswith("{"), F.col("_body").contains(object_text))
    plain = F.col("_values").isNotNull() | ~F.col("_alike")
    known = F.when(plain, F.lit(True)).otherwise(nested)
    return F.struct(e["key"].alias("key"), e["value"].alias("raw"), v["value"].alias("value"), F.coalesce(known, F.lit(False)).alias("known"))


def list_records(raw, first_is_object, values):
    """Members of a list's text as ``array<struct<record, is_record>>``."""
    texts = F.from_json(raw, "array<string>", TEXT_RULES)

    def pair(record, ok):
        return F.struct(record.alias("record"), ok.alias("is_record"))

    # Only a string can look like an object without being one; raw text without a string that
    # starts with a brace needs no second look at its members.
    plain = F.transform(texts, lambda t: pair(t, F.coalesce(t.startswith("{"), F.lit(False))))
    checked = F.zip_with(texts, values, lambda t, v: pair(t, F.coalesce(t.startswith("{"), F.lit(False)) & is_object(v)))
    objects = F.when(raw.contains(',"{') & values.isNotNull(), checked).otherwise(plain)
    typed = F.zip_with(texts, values, lambda t, v: F.struct(t.alias("t"), (F.schema_of_variant(v) == "STRING").alias("q")))
    numbers = F.transform(typed, lambda e, i: pair(numbered(e["t"], i, e["q"]), F.lit(True)))
    unparsed = F.transform(texts, lambda t, i: pair(numbered(t, i, t.isNotNull() & ~is_json(t)), F.lit(True)))
    return F.when(first_is_object, objects).otherwise(F.when(values.isNotNull(), numbers).otherwise(unparsed))


def numbered(value, index, quoted):
    """A list's member that is no object as a record: its value and place."""
    literal = F.concat(F.lit('{"value":'), F.coalesce(value, F.lit("null")), F.lit(',"index":'), index.cast("string"), F.lit("}"))
    return F.when(quoted, F.to_json(F.struct(value.alias("value"), index.alias("index")))).otherwise(literal)


def _records(max_records: int | None):
    """Records of one entry as ``array<struct<record, is_record>>``; empty for scalars, nulls and empty lists."""
    raw, value, known = F.col("_entry.raw"), F.col("_entry.value"), F.col("_entry.known")
    values = F.from_json(F.when(raw.startswith("["), raw), "array<variant>", TEXT_RULES)
    schema = F.schema_of_variant(value)
    is_list = raw.startswith("[") & (raw != "[]") & known & F.coalesce(schema.startswith("ARRAY"), F.lit(True))
    is_row = raw.startswith("{") & known & F.coalesce(schema.startswith("OBJECT"), F.lit(True))
    # a list's text has no white space between its members, and its strings are quoted
    members = list_records(raw, raw.startswith("[{"), values)
    limited = F.slice(members, 1, max_records) if max_records else members
    whole = F.array(F.struct(raw.alias("record"), (~F.col("_entry.key").isin(QUARANTINE, DOCUMENT)).alias("is_record")))
    return F.when(F.col("_entry.key").isin(QUARANTINE, DOCUMENT), whole).when(is_list, limited).when(is_row, whole)


def shred(
    docs: DataFrame, max_records: int | None = None, keep_rejects: bool = False, mark_documents: bool = False
) -> DataFrame:
    """One row per record: position columns, ``table``, ``record`` (JSON text).

    * ``{"data": {...}}`` is unwrapped, otherwise the top level is shredded;
    * a list that starts with an object is a table, another non-empty list becomes
      ``(value, index)`` records, an object is a one-row table, the rest is skipped.

    ``keep_rejects`` adds unreadable documents (table ``_quarantine``) and list members that are
    not objects, both with a ``reason``, so one pass over the input serves tables and quarantine. With it,
    ``mark_documents`` adds a row per document (table ``_document``), also for one that has no records.
    No shuffle: a document is taken apart where it is read.
    """
    known = last_entries(F.map_entries("_values"))
    entries = F.zip_with(last_entries(F.map_entries("_texts")), F.coalesce(known, F.array().cast(VALUES)), _entry)

    def special(key: str, raw):
        none = F.lit(None).cast("variant").alias("value")
        return F.array(F.struct(F.lit(key).alias("key"), raw.alias("raw"), none, F.lit(True).alias("known")))

    broken, mark = special(QUARANTINE, F.col("text")), special(DOCUMENT, F.lit(None).cast("string"))
    bodies = _bodies(docs)
    if keep_rejects:
        every = F.when(F.col("_ok"), entries).otherwise(broken)
        bodies = bodies.withColumn("_entries", F.concat(mark, every) if mark_documents else every)
    else:
        bodies = bodies.where("_ok").withColumn("_entries", entries)
    # The outer form plus a filter on its output: the inner form makes Catalyst filter on the
    # size of the array first, which would parse every document twice.
    tables = bodies.select(*DOC_POSITION, F.posexplode_outer("_entries").alias("table_pos", "_entry")).where(
        F.col("_entry").isNotNull()
    )
    # the entry ends here: beside every record its whole text would be carried along, quadratic in the document's size
    listed = tables.select(*DOC_POSITION, F.col("_entry.key").alias("table"), "table_pos", _records(max_records).alias("_rows"))
    rows = listed.select(*DOC_POSITION, "table", "table_pos", F.posexplode_outer("_rows").alias("rec_pos", "_row")).where(
        F.col("_row").isNotNull()
    )
    out = rows.select(*DOC_POSITION, "table", "table_pos", "rec_pos", "_row.record", "_row.is_record")
    if not keep_rejects:
        return out.where("is_record").drop("is_record")
    reason = F.when(F.col("table") == QUARANTINE, F.lit("not a JSON object")).when(
        ~F.col("is_record") & (F.col("table") != DOCUMENT), F.lit("record is not a JSON object")
    )
    return out.withColumn("reason", reason).drop("is_record")


def typed_records(
    records: DataFrame, schema: T.StructType, text: str = "record", keep: list[str] | None = None
) -> DataFrame:
    """Read record text with the declared types.

    Values are parsed as text first and then cast, so a value that does not fit its type is
    null and named in ``lost_fields`` instead of disappearing.
    """
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = records.withColumn("_raw", F.from_json(text, raw_schema))
    columns, lost = [], []
    for field in schema.fields:
        raw = f"_raw.`{field.name}`"
        typed = cast_sql(raw, field.dataType)
        columns.append(f"{typed} as `{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            lost.append(f"if({raw} is not null and {typed} is null, '{field.name}', null)")
    kept = keep if keep is not None else [c for c in records.columns if c not in (text, *schema.fieldNames())]
    lost_fields = f"array_compact(cast(array({', '.join(lost)}) as array<string>)) as lost_fields"
    return parsed.selectExpr(*[f"`{c}`" for c in kept], *columns, lost_fields)


def cast_sql(raw: str, data_type: T.DataType) -> str:
    """SQL for the text of a JSON value as ``data_type``, null when it does not fit."""
    name = data_type.simpleString()
    if isinstance(data_type, T.StringType):
        return raw
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return f"from_json({raw}, '{name}')"
    if isinstance(data_type, T.IntegralType):
        # "3.0" is a whole number, "3.5" is not
        whole = f"try_cast({raw} as decimal(38,10))"
        return f"coalesce(try_cast({raw} as {name}), if({whole} = floor({whole}), try_cast({whole} as {name}), null))"
    return f"try_cast({raw} as {name})"


def cast_text(raw, data_type: T.DataType):
    """:func:`cast_sql` for a column, also one inside a lambda."""
    if isinstance(data_type, T.StringType):
        return raw
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.from_json(raw, data_type)
    if isinstance(data_type, T.IntegralType):
        # "3.0" is a whole number, "3.5" is not
        whole = raw.try_cast("decimal(38,10)")
        fits = raw.try_cast(data_type)
        return F.coalesce(fits, F.when(whole == F.floor(whole), whole.try_cast(data_type)))
    return raw.try_cast(data_type)
