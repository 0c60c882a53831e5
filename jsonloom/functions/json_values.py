"""Column expressions over JSON text.

VARIANT sorts object keys, so order-sensitive steps read the text with
``map<string,string>`` / ``array<string>`` (which keep order) and take only the
kind of a value from the variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One set of rules for texts of every size: strings of any length, no NaN, no single quotes.
TEXT_RULES = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false", "maxStringLen": "2147483647"}


def last_key_wins(spark) -> None:
    """Variants keep the last of repeated keys, as text parsing into columns does."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def last_entries(entries: Column) -> Column:
    """Entries of an object with each key once: at its first place, with its last value."""
    keys = entries["key"]
    distinct = F.array_distinct(keys)
    once = F.transform(distinct, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1))
    return F.when(F.size(keys) == F.size(distinct), entries).otherwise(once)

# variant type -> type name used in profiles; fixed values. Decimals, arrays and objects carry parameters.
EXACT_TYPES = {"STRING": "str", "BIGINT": "int", "DOUBLE": "float", "FLOAT": "float", "BOOLEAN": "bool"}
PREFIX_TYPES = {"DECIMAL": "float", "OBJECT": "dict", "ARRAY": "list"}


def one_object(text: Column) -> Column:
    """The entries of a text that is one well-formed JSON object, values as text, and nothing behind it; else null.

    The text is read as the first of two members of a list, so text that goes on after the object, or closes the list itself,
    does not give two members.
    """
    looks_like_object = F.btrim(text, F.lit(" \t\r\n")).startswith("{")
    members = F.from_json(F.concat(F.lit("["), text, F.lit(",{}]")), "array<map<string,string>>", TEXT_RULES)
    return F.when(looks_like_object & (F.size(members) == 2), F.get(members, F.lit(0)))


def is_json(text: Column) -> Column:
    """True for the text of one JSON value."""
    members = F.from_json(F.concat(F.lit("["), text, F.lit(",0]")), "array<string>", TEXT_RULES)
    return F.coalesce(F.size(members) == 2, F.lit(False))


def is_object(value: Column) -> Column:
    """True when a variant holds a JSON object."""
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def type_name(value: Column) -> Column:
    """Type name of a variant: str, int, float, bool, dict, list, or null for JSON null.

    ``3.0`` and integers past 64 bits are decimals in a variant, so both count as float.
    """
    return named_type(F.schema_of_variant(value))


def named_type(schema: Column) -> Column:
    """Type name from the schema text of a variant."""
    chain = None
    for kind, name in EXACT_TYPES.items():
        chain = (F if chain is None else chain).when(schema == kind, F.lit(name))
    for kind, name in PREFIX_TYPES.items():
        chain = chain.when(schema.startswith(kind), F.lit(name))
    return chain


def parsed_entries(record: Column) -> Column:
    """Ordered ``array<struct<key,value:variant>>`` of one JSON object, repeated keys included."""
    return F.map_entries(F.from_json(record, "map<string,variant>", TEXT_RULES))
