"""Record contracts: required fields, types, ranges and cross-field rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.shred import _bodies, cast_text
from jsonloom.sources.documents import DOC_POSITION


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = True
    low: float | None = None
    high: float | None = None

    @property
    def spark_type(self) -> T.DataType:
        return T._parse_datatype_string(self.type)


@dataclass(frozen=True)
class Contract:
    """Fields of a table and rules over them (``name -> "field sign field"``) that a valid record meets."""

    table: str
    key: str
    fields: tuple[Field, ...]
    rules: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.VariantType()) for f in self.fields])


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


def _typed(spec: Field, value: Column) -> Column:
    """The value as its declared type, null when it does not fit. Numbers are accepted as text, objects are not."""
    kind, wanted = F.schema_of_variant(value), spec.spark_type
    if isinstance(wanted, T.ArrayType):
        return F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", spec.type))
    scalar = ~kind.rlike("^(ARRAY|OBJECT|VOID)")
    return F.when(scalar, cast_text(F.try_variant_get(value, "$", "string"), wanted))


def typed_record(contract: Contract, raw: Column) -> Column:
    """Struct of typed values from a struct of variants."""
    return F.struct(*[_typed(f, raw[f.name]).alias(f.name) for f in contract.fields])


def field_problems(contract: Contract, raw: Column, typed: Column) -> list[Column]:
    problems = []
    for f in contract.fields:
        has, value = _present(raw[f.name]), typed[f.name]
        label = f"{contract.table}.{f.name}"
        chain = F.when(has & value.isNull(), F.lit(f"{label}: not {f.type}"))
        if f.required:
            chain = chain.when(~has, F.lit(f"{label}: missing"))
        chain = _ranged(f, value, label, chain)
        problems.append(chain)
    return problems


def _ranged(f: Field, value: Column, label: str, chain: Column) -> Column:
    """Each bound that is given is checked on its own."""
    if f.low is None and f.high is None:
        return chain
    outside = F.lit(False)
    if f.low is not None:
        outside |= value < f.low
    if f.high is not None:
        outside |= value > f.high
    shown = ["" if bound is None else f"{bound:g}" for bound in (f.low, f.high)]
    return chain.when(outside, F.lit(f"{label}: outside {'..'.join(shown)}"))


def check_records(records: DataFrame, contract: Contract, text: str = "record") -> DataFrame:
    """Typed columns of every record plus ``violations`` (empty for a valid record). Unknown fields are ignored."""
    parsed = records.withColumn("_raw", F.from_json(text, contract.raw_schema)).withColumn(
        "_typed", typed_record(contract, F.col("_raw"))
    )
    kept = [c for c in records.columns if c not in (text, *contract.schema.fieldNames())]
    flat = parsed.select(
        *kept, F.array(*field_problems(contract, F.col("_raw"), F.col("_typed"))).alias("_problems"), "_typed.*"
    )
    return _with_rules(flat, contract)


def check_table(df: DataFrame, contract: Contract) -> DataFrame:
    """The same contract over a typed table."""
    problems = []
    for f in contract.fields:
        value, label = F.col(f.name), f"{contract.table}.{f.name}"
        chain = F.when(F.lit(False), F.lit(""))
        if f.required:
            chain = chain.when(value.isNull(), F.lit(f"{label}: missing"))
        chain = _ranged(f, value, label, chain)
        problems.append(chain)
    return _with_rules(df.withColumn("_problems", F.array(*problems)), contract)


def _with_rules(flat: DataFrame, contract: Contract) -> DataFrame:
    broken = [
        F.when(~_met(rule, F.col), F.lit(f"{contract.table}: {name}")) for name, rule in contract.rules.items()
    ]
    every = F.concat("_problems", F.array(*broken)) if broken else F.col("_problems")
    return flat.withColumn("violations", F.array_compact(every)).drop("_problems")


def check_documents(docs: DataFrame, contracts: list[Contract], scope: str = "document") -> DataFrame:
    """Documents with a column of typed records per table and ``violations``.

    One bad record rejects its document. With ``scope="record"`` it rejects itself only: it is left out of its table and
    listed in ``rejected`` (table, place, reason, record), and only what is wrong with the document as a whole rejects that. All
    records of a document are in one row, so the verdict needs no shuffle. An envelope is unwrapped first.
    """
    if scope not in ("document", "record"):
        raise ValueError("scope is document or record")
    schema = T.StructType([T.StructField(c.table, T.ArrayType(c.raw_schema)) for c in contracts])
    inner = T.StructType([T.StructField("data", schema)])
    tables = F.when(F.col("_enveloped"), F.from_json("text", inner)["data"]).otherwise(F.from_json("text", schema))
    parsed = _bodies(docs).select(
        *DOC_POSITION, "text", "_ok", tables.alias("_tables"), F.col("_texts").alias("_entries")
    )
    violations = [F.array(F.when(~F.col("_ok"), F.lit("not a JSON object")))]
    known = F.arrays_overlap(F.map_keys("_entries"), F.array(*[F.lit(c.table) for c in contracts]))
    violations.append(F.array(F.when(F.col("_ok") & ~known, F.lit("no known table"))))
    columns = []
    for contract in contracts:
        raw = F.col("_tables")[contract.table]
        # a null entry means no records; anything else that is not a list of objects is an error
        given = F.coalesce(F.element_at("_entries", contract.table), F.lit("null")) != "null"
        violations.append(F.array(F.when(given & raw.isNull(), F.lit(f"{contract.table}: not a list of records"))))
        # one step after the other: in one, every use of a value would read it again
        read = F.transform(raw, partial(_read, contract))
        columns.append(F.transform(F.transform(read, partial(_judged, contract)), _kept).alias(contract.table))
    staged = parsed.select(*DOC_POSITION, "text", "_ok", F.concat(*violations).alias("_document"), *columns)
    problems = [F.flatten(F.transform(F.coalesce(F.col(c.table), F.array()), lambda r: r["problems"])) for c in contracts]
    if scope == "record":
        sound = [F.transform(F.filter(F.col(c.table), lambda r: F.size(r["problems"]) == 0), lambda r: r["row"]).alias(c.table) for c in contracts]
        bad = [F.filter(F.transform(F.coalesce(F.col(c.table), F.array()), partial(_rejected, c)), lambda r: r["reason"] != "") for c in contracts]
        whole = F.array_compact(F.col("_document"))
        return staged.select(*DOC_POSITION, "text", whole.alias("violations"), F.flatten(F.array(*bad)).alias("rejected"), *sound)
    rows = [F.transform(F.col(c.table), lambda r: r["row"]).alias(c.table) for c in contracts]
    found = F.array_distinct(F.array_compact(F.concat("_document", *problems)))
    return staged.select(*DOC_POSITION, "text", found.alias("violations"), *rows)


def _read(contract: Contract, raw: Column) -> Column:
    return F.struct(raw.alias("raw"), typed_record(contract, raw).alias("row"))


def _judged(contract: Contract, read: Column) -> Column:
    raw, typed = read["raw"], read["row"]
    problems = field_problems(contract, raw, typed)
    problems.append(F.when(raw.isNull(), F.lit(f"{contract.table}: record is not an object")))
    for name, rule in contract.rules.items():
        problems.append(F.when(~_met(rule, lambda n: typed[n]), F.lit(f"{contract.table}: {name}")))
    return F.struct(raw.alias("raw"), typed.alias("row"), F.array_compact(F.array(*problems)).alias("problems"))


def _kept(judged: Column) -> Column:
    text = F.when(F.size(judged["problems"]) > 0, F.to_json(judged["raw"]))
    return F.struct(judged["row"].alias("row"), judged["problems"].alias("problems"), text.alias("record"))


def _rejected(contract: Contract, checked: Column, place: Column) -> Column:
    reason = F.array_join(F.array_distinct(checked["problems"]), "; ")
    return F.struct(F.lit(contract.table).alias("table"), place.alias("rec_pos"), reason.alias("reason"), checked["record"].alias("record"))


# comparison sign -> Column comparison
_COMPARE = {"<=": Column.__le__, ">=": Column.__ge__, "<": Column.__lt__, ">": Column.__gt__, "=": Column.__eq__}


def _met(rule: str, value) -> Column:
    """A rule ``field sign field`` over ``value(field)``; a missing side meets it."""
    left, sign, right = rule.split()
    return F.coalesce(_COMPARE[sign](value(left), value(right)), F.lit(True))


def document_records(checked: DataFrame, contract: Contract) -> DataFrame:
    """Typed records of one table from the documents without violations, with their positions."""
    good = checked.where(F.size("violations") == 0)
    rows = good.select(*DOC_POSITION, F.posexplode_outer(contract.table).alias("rec_pos", "_row")).where(
        F.col("_row").isNotNull()
    )
    return rows.select(*DOC_POSITION, "rec_pos", "_row.*")
