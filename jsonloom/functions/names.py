"""Naming rules: which field is a key, what it points to, how to describe it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SUFFIX = "_id"

# (word in the field name, description) in order of precedence; fixed values.
BASIC_DESCRIPTIONS = (("date", "Date field"),)
EXTENDED_DESCRIPTIONS = (
    ("date", "Date field"),
    ("email", "Email address"),
    ("phone", "Phone number"),
    ("name", "Name field"),
    ("address", "Address"),
    ("gpa", "Grade Point Average"),
    ("capacity", "Capacity/Count"),
)


def is_key_name(field: Column) -> Column:
    return field.endswith(KEY_SUFFIX)


def key_columns(df) -> list[str]:
    return [c for c in df.columns if c.endswith(KEY_SUFFIX)]


def parent_candidates(field: Column, plurals: str = "basic", mode: str = "default") -> Column:
    """Table names a key field may point to, best first.

    ``mode="reference"`` removes every ``_id`` in the name instead of the suffix only.
    ``plurals="extended"`` adds ``-es`` and ``-y`` → ``-ies``.
    """
    if mode == "reference":
        base = F.replace(field, F.lit(KEY_SUFFIX), F.lit(""))
    else:
        base = F.regexp_replace(field, f"{KEY_SUFFIX}$", "")
    names = [base, F.concat(base, F.lit("s")), F.regexp_replace(base, "s$", "")]
    if plurals == "extended":
        names += [F.concat(base, F.lit("es")), F.regexp_replace(base, "y$", "ies")]
    return F.array(*names)


def describe_field(field: Column, parent: Column, rules=EXTENDED_DESCRIPTIONS) -> Column:
    text = F.when(parent.isNotNull(), F.concat(F.lit("References "), parent)).when(
        is_key_name(field), F.lit("Identifier field")
    )
    for word, description in rules:
        text = text.when(F.lower(field).contains(word), F.lit(description))
    return text.otherwise(F.lit(""))
