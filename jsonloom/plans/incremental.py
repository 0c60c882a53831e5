"""Recounts and checks from what a batch changed.

Rows that came and went since the last run are added to counts per key, and what the touched keys' counts mean for a check
before and after goes into the check's totals. So a run costs the changed parts and the touched buckets of the counts, and
its result is that of the full suite. The counts are tables of the store, published like any other.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.names import key_columns
from jsonloom.operators.quality import capacity, consistency, distribution, integrity
from jsonloom.operators.quality.rows import literal_checks, name, union_checks
from jsonloom.operators.quality.suite import Rules, count_checks
from jsonloom.operators.relate import comparable
from jsonloom.plans.validate import recount
from jsonloom.sources.store import Batch, TableStore

COUNTS, KEY_COUNTS, TOTALS = "_child_counts", "_check_keys", "_check_totals"
_COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()), T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
_KEYS_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()), T.StructField("key", T.StringType()),
        T.StructField("c", T.LongType()), T.StructField("p", T.LongType()), T.StructField("cap", T.DoubleType()),
    ]
)
_TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)
#: the key under which null is counted; no key's text begins with this character
_NULL = "\u0000null"


def key_text(column: str, own: T.DataType, other: T.DataType) -> Column:
    """A key as text that is equal exactly where the keys match; null for keys whose types never match."""
    if not comparable(own, other):
        return F.lit(None).cast("string")
    if own == other and not isinstance(own, (T.FloatType, T.DoubleType)):
        return F.col(column).cast("string")
    whole = (T.IntegralType,)
    if isinstance(own, whole) and isinstance(other, whole):
        return F.col(column).cast("bigint").cast("string")
    return (F.col(column).cast("double") + F.lit(0.0)).cast("string")


def _since(store: TableStore, table: str) -> dict[str, int]:
    """The batch that each rule's counts are of."""
    if table not in store.manifest():
        return {}
    return {row.rule: row.value for row in store.read(table).where(F.col("name") == "as of").select("rule", "value").collect()}


# -- recount -------------------------------------------------------------------------------------


def recount_changes(
    store: TableStore, parent: str, key: str, child: str, child_key: str, column: str, token: tuple[str, int] | None = None
) -> bool:
    """Child counts of the parents that were written, or whose children were, since the last call; others are not touched.

    The result is that of :func:`~jsonloom.plans.validate.recount`. False, and no change, when a table or key is absent.
    """
    batch = store.batch(token=token)
    if batch.published or parent not in batch.entries or child not in batch.entries:
        return False
    entry = batch.entries[parent]
    parents, children = entry.schema, batch.entries[child].schema
    if key not in parents.fieldNames() or child_key not in children.fieldNames():
        return False
    if entry.key != [key]:
        return recount(store, parent, key, child, child_key, column, token)
    rule = f"{parent}.{key}<{child}.{child_key}>{column}"
    since, until = _since(store, TOTALS).get(rule, 0), batch.id - 1
    own, other = parents[key].dataType, children[child_key].dataType
    parent_key = F.coalesce(key_text(key, own, own), F.lit(_NULL))
    came, written = store.changed(child, since, until), store.changed(parent, since, until)
    none = store.spark.createDataFrame([], "key string, d bigint")
    deltas = none if came is None else came.select(key_text(child_key, other, own).alias("key"), "_sign").where("key is not null").groupBy(
        "key"
    ).agg(F.sum("_sign").alias("d")).where("d <> 0")
    deltas = batch.kept(deltas)
    counts = _added(batch, COUNTS, _COUNTS_SCHEMA, deltas.select(F.lit(rule).alias("rule"), "key", F.col("d").alias("n")), ["n"])
    rows = none.select("key") if written is None else written.where("_sign = 1").select(parent_key.alias("key"))
    touched = batch.kept(rows.unionByName(deltas.select("key")).distinct())
    near = store.read_near(parent, touched.select(F.when(F.col("key") != _NULL, F.col("key")).try_cast(own).alias(key)), until)
    has = column in parents.fieldNames()
    near = near.withColumns({"_key": parent_key, "_before": F.col(column).try_cast("bigint") if has else F.lit(None)})
    asked = near.join(touched, near["_key"] == touched["key"], "left_semi")
    found = _of_keys(batch, counts, touched, rule).select(F.col("key").alias("_k"), "n")
    fresh = asked.join(found, F.col("_key") == F.col("_k"), "left").withColumn(column, F.coalesce("n", F.lit(0)).cast("bigint"))
    count = T.StructField(column, T.LongType())
    fields = [count if f.name == column else f for f in parents.fields] + ([] if has else [count])
    changed = fresh.where(~F.col(column).eqNullSafe(F.col("_before"))).select(*[f.name for f in fields])
    batch.upsert(parent, batch.kept(changed), [key], [key], T.StructType(fields))
    _note(batch, {rule: {"as of": batch.id}})
    batch.commit()
    return True


def _added(batch: Batch, table: str, schema: T.StructType, deltas: DataFrame, values: list[str], cap: str | None = None) -> DataFrame:
    """Add the deltas to the counts of their keys and write these; ``deltas`` with the new counts (``<value>``) and the old
    (``old_<value>``). A ``cap`` is not added up: the one in ``capped`` takes the place of the old one."""
    keys = ["rule", "key"]
    batch.create(table, schema, keys)
    old = _stored(batch, table, deltas.select(*keys), schema)
    extra = [cap] if cap else []
    written = F.when(F.col("capped").isNotNull(), F.col("capped.cap")).otherwise(F.col(f"old_{cap}")) if cap else None
    before = old.select(*keys, *[F.col(v).alias(f"old_{v}") for v in [*values, *extra]])
    # sorted by key first: a rule has many
    met = deltas.join(before, ["key", "rule"], "left").withColumns({f"old_{v}": F.coalesce(f"old_{v}", F.lit(0)) for v in values})
    met = met.withColumns({v: F.col(v) + F.col(f"old_{v}") for v in values} | ({cap: written} if cap else {}))
    met = batch.kept(met)
    batch.upsert(table, met.select(*schema.fieldNames()), keys, keys, schema, unique=True)
    return met


def _stored(batch: Batch, table: str, keys: DataFrame, schema: T.StructType) -> DataFrame:
    if table not in batch.store.manifest(batch.id - 1):
        return batch.store.spark.createDataFrame([], schema)
    return batch.store.read_near(table, keys, batch.id - 1)


def _of_keys(batch: Batch, fresh: DataFrame, keys: DataFrame, rule: str) -> DataFrame:
    """Child counts of the given keys: those just added to, else the stored ones."""
    asked = keys.select(F.lit(rule).alias("rule"), "key")
    stored = _stored(batch, COUNTS, asked, _COUNTS_SCHEMA)
    older = stored.join(asked, ["rule", "key"], "left_semi").join(fresh.select("rule", "key"), ["rule", "key"], "left_anti")
    return fresh.select("key", "n").unionByName(older.select("key", "n"))


def _note(batch: Batch, totals: dict[str, dict[str, int]]) -> None:
    rows = [(rule, counter, value) for rule, counters in totals.items() for counter, value in counters.items()]
    frame = batch.store.spark.createDataFrame(rows, _TOTALS_SCHEMA)
    batch.upsert(TOTALS, frame.coalesce(1), ["rule", "name"], ["value"], _TOTALS_SCHEMA)


# -- checks --------------------------------------------------------------------------------------


@dataclass
class Watch:
    """A check as counts per key and what they mean.

    ``children`` and ``parents`` name a table, a column and its partner's type; ``cap`` a column of the parents. ``means`` are
    SQL expressions over c, p and cap, each added up over all keys (with null on the sides in ``nulls``); ``counters`` SQL
    expressions added up over a table's rows.
    """

    rule: str
    children: tuple[str, str, T.DataType] | None = None
    parents: tuple[str, str, T.DataType] | None = None
    cap: str | None = None
    means: dict[str, str] = field(default_factory=dict)
    nulls: str = ""
    counters: dict[str, str] = field(default_factory=dict)
    table: str | None = None

    def tables(self) -> set[str]:
        return {t for t in (self.children and self.children[0], self.parents and self.parents[0], self.table) if t}


def watches(tables: dict[str, DataFrame], rules: Rules) -> list[Watch]:
    """What has to be counted for the rules' checks over these tables (schemas are looked at, no rows)."""
    out = []
    for r in rules.references:
        if integrity.precondition(r, tables, rules.primary_keys) is None:
            pk = integrity.target_key(r, tables, rules.primary_keys)
            left, right = tables[r.from_table].schema[r.foreign_key].dataType, tables[r.to_table].schema[pk].dataType
            match = comparable(left, right)
            out.append(Watch(
                _reference_rule(r), (r.from_table, r.foreign_key, right if match else left), (r.to_table, pk, left) if match else None,
                means={"total": "c", "refs": "int(c > 0)", "orphans": "if(p = 0, c, 0)", "parents": "int(p > 0)"},
            ))
    for i, rule in enumerate(rules.capacities):
        if capacity.capacity_precondition(rule, tables) is None:
            key = tables[rule.parent].schema[rule.key].dataType
            over = "c > coalesce(cap, 0)"
            out.append(Watch(
                f"capacity:{i}", (rule.child, rule.child_key, key), (rule.parent, rule.key, key), rule.limit,
                {"parents": "p", "over": f"if(p > 0 and {over}, p, 0)", "children": "p * c"}, "p",
            ))
    for table, df in tables.items():
        key = rules.primary_keys.get(table)
        if key in df.columns:
            kind = df.schema[key].dataType
            out.append(Watch(
                f"unique:{table}.{key}", (table, key, kind), nulls="c", means={"rows": "if(c > 1, c, 0)", "values": "int(c > 1)"},
            ))
        out.append(Watch(f"rows:{table}", table=table, counters={"total": "1"}))
        for column in key_columns(df):
            out.append(Watch(f"nulls:{table}.{column}", table=table, counters={"n": f"int({name(column)} is null)"}))
        for column in distribution.numeric_columns(df):
            kind = df.schema[column].dataType
            out.append(Watch(f"values:{table}.{column}", (table, column, kind), means={"unique": "int(c > 0)", "total": "c"}))
    for i, rule in enumerate(rules.limits):
        if rule.table in tables and rule.key in tables[rule.table].columns:
            kind = tables[rule.table].schema[rule.key].dataType
            out.append(Watch(f"limit:{i}", (rule.table, rule.key, kind), means={"over": f"int(c > {rule.limit})"}))
    for i, rule in enumerate(rules.field_rules):
        if rule.table in tables and set(rule.columns) <= set(tables[rule.table].columns):
            out.append(Watch(f"field:{i}", table=rule.table, counters={"bad": f"int(coalesce({rule.violation}, false))"}))
    return out


def _reference_rule(r) -> str:
    return f"reference:{r.from_table}.{r.foreign_key}>{r.to_table}"


def _key_deltas(store: TableStore, wanted: list[Watch], as_of: dict[str, int], until: int) -> DataFrame | None:
    """What changed in the counts of every key: ``rule, key, c, p, capped`` (the cap of a parent that was written).

    The changed rows of a table are read once for all checks that look at it, and a column's keys counted once for all that
    count them alike.
    """
    sides: dict[tuple[str, int], list[tuple[Watch, str, str, T.DataType]]] = {}
    for w in wanted:
        for side, place in (("c", w.children), ("p", w.parents)):
            if place and w.means:
                sides.setdefault((place[0], as_of[w.rule]), []).append((w, side, *place[1:]))
    parts = []
    for (table, since), some in sides.items():
        changed = store.changed(table, since, until)
        if changed is None:
            continue
        cells: dict[tuple, tuple[Column, list[Column]]] = {}
        for w, side, column, partner in some:
            own, capped = changed.schema[column].dataType, side == "p" and w.cap
            key = key_text(column, own, partner)
            key = F.coalesce(key, F.lit(_NULL)) if side in w.nulls else key
            cap = F.col(w.cap).cast("double") if capped else F.lit(None).cast("double")
            alike = (column, partner.simpleString(), side in w.nulls, capped)
            counted = F.struct(F.lit(len(cells)).alias("cell"), key.alias("key"), cap.alias("cap"))
            cells.setdefault(alike, (counted, []))[1].append(F.struct(F.lit(w.rule).alias("rule"), F.lit(side).alias("side")))
        rows = changed.select("_sign", F.inline(F.array(*[c for c, _ in cells.values()]))).where("key is not null")
        counts = rows.groupBy("cell", "key", "cap").agg(F.sum("_sign").alias("d")).where("d <> 0")
        uses = F.array(*[F.array(*rules) for _, rules in cells.values()])
        parts.append(counts.select("key", "cap", "d", F.inline(F.get(uses, F.col("cell")))))
    if not parts:
        return None
    count = {s: F.sum(F.when(F.col("side") == s, F.col("d")).otherwise(0)).alias(s) for s in "cp"}
    # numbers only: a struct's maximum would have the rows sorted
    came = (F.col("side") == "p") & (F.col("d") > 0)
    caps = [F.count_if(came).alias("came"), F.max(F.when(came, F.col("cap"))).alias("cap")]
    sums = reduce(DataFrame.unionByName, parts).groupBy("rule", "key").agg(*count.values(), *caps)
    return sums.select("rule", "key", "c", "p", F.when(F.col("came") > 0, F.struct("cap")).alias("capped"))


def update_checks(store: TableStore, rules: Rules, token: tuple[str, int] | None = None, append_to: str | None = None) -> DataFrame | None:
    """The check rows of the whole store, from what changed since the last call; None when the token was published before.

    Names, results, messages, severities and counts of affected records are those of
    :func:`~jsonloom.operators.quality.suite.run_checks`; affected records and the details that need them are left out, and
    rules of the user's own are run in full. A rule that is new, or whose tables have new columns, is counted from all rows
    once. Capacity rules expect one parent row per key. With ``append_to`` the counters go to that table. The batch of the last
    call has to be there still (see ``TableStore.vacuum``).
    """
    batch = store.batch(token=token)
    if batch.published:
        return None
    spark, until = store.spark, batch.id - 1
    tables = store.read_all(until)
    wanted = watches(tables, rules)
    # a watch is counted anew when the columns of its tables change, under a name of its own
    marks = {w.rule: f"{w.rule}#{'|'.join(','.join(sorted(f'{f.name}:{f.dataType.simpleString()}' for f in tables[t].schema)) for t in sorted(w.tables()))}" for w in wanted}
    wanted = [Watch(_short(marks[w.rule]), w.children, w.parents, w.cap, w.means, w.nulls, w.counters, w.table) for w in wanted]
    names = {rule: _short(mark) for rule, mark in marks.items()}
    totals: dict[str, dict[str, int]] = {}
    if TOTALS in store.manifest(until):
        for row in store.read(TOTALS).collect():
            totals.setdefault(row.rule, {})[row.name] = row.value
    as_of = {w.rule: totals.get(w.rule, {}).get("as of", 0) for w in wanted}

    deltas = _key_deltas(store, wanted, as_of, until)
    if deltas is not None:
        met = _added(batch, KEY_COUNTS, _KEYS_SCHEMA, batch.kept(deltas), ["c", "p"], "cap")
        means = {w.rule: w.means for w in wanted if w.means}
        slots = max(len(m) for m in means.values())
        new, old = [], []
        for i in range(slots):
            for out, prefix in ((new, ""), (old, "old_")):
                cases = [f"when {_sql(rule)} then bigint({_with_prefix(list(m.values())[i], prefix)})" for rule, m in means.items() if i < len(m)]
                out.append(F.expr(f"case rule {' '.join(cases)} else 0 end"))
        sums = met.groupBy("rule").agg(*[F.sum(a - b).alias(f"v{i}") for i, (a, b) in enumerate(zip(new, old))])
        for row in sums.collect():
            for i, counter in enumerate(means[row.rule]):
                totals.setdefault(row.rule, {})[counter] = totals.get(row.rule, {}).get(counter, 0) + (row[f"v{i}"] or 0)
    by_table: dict[tuple[str, int], list[Watch]] = {}
    for w in wanted:
        if w.counters:
            by_table.setdefault((w.table, as_of[w.rule]), []).append(w)
    for (table, since), some in by_table.items():
        changed = store.changed(table, since, until)
        if changed is None:
            continue
        listed = [(w.rule, counter, sql) for w in some for counter, sql in w.counters.items()]
        row = changed.agg(*[F.coalesce(F.sum(F.expr(f"_sign * ({sql})")), F.lit(0)).alias(f"v{i}") for i, (_, _, sql) in enumerate(listed)]).first()
        for i, (rule, counter, _) in enumerate(listed):
            totals.setdefault(rule, {})[counter] = totals.get(rule, {}).get(counter, 0) + row[f"v{i}"]
    current = {w.rule: {c: totals.get(w.rule, {}).get(c, 0) for c in (*w.means, *w.counters)} for w in wanted}
    checks = check_rows(spark, tables, rules, {rule: current[short] for rule, short in names.items()})
    _note(batch, {w.rule: current[w.rule] | {"as of": until} for w in wanted})
    if append_to:
        counted = count_checks(checks)
        batch.append(append_to, counted.selectExpr(f"bigint({batch.id}) as batch", "*").coalesce(1))
    batch.commit()
    return checks


def _short(mark: str) -> str:
    """A rule's name with a digest of its tables' columns."""
    rule, columns = mark.split("#", 1)
    return f"{rule}#{hashlib.sha256(columns.encode()).hexdigest()[:12]}"


def _sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with_prefix(sql: str, prefix: str) -> str:
    return re.sub(r"\b(cap|c|p)\b", lambda m: prefix + m.group(1), sql) if prefix else sql


def check_rows(spark: SparkSession, tables: dict[str, DataFrame], rules: Rules, totals: dict[str, dict[str, int]]) -> DataFrame:
    """Check rows from totals, in the suite's order."""

    def one(values: dict[str, object], **types: str) -> DataFrame:
        columns = [f"cast({'null' if v is None else v} as {types.get(k, 'bigint')}) as `{k}`" for k, v in values.items()]
        return spark.range(1).selectExpr(*columns)

    failed = [row for row in (integrity.precondition(r, tables, rules.primary_keys) for r in rules.references) if row]
    parts = [literal_checks(spark, failed)] if failed else []
    for r in rules.references:
        if integrity.precondition(r, tables, rules.primary_keys) is None:
            pk = integrity.target_key(r, tables, rules.primary_keys)
            summary = one(totals[_reference_rule(r)] | {"values_": None}, values_="array<string>")
            parts.append(integrity.reference_row(summary, r, pk))
            parts += integrity.key_type_checks(spark, r, tables[r.from_table].schema[r.foreign_key].dataType, tables[r.to_table].schema[pk].dataType)
    for i, rule in enumerate(rules.capacities):
        lacking = capacity.capacity_precondition(rule, tables)
        if lacking:
            parts.append(literal_checks(spark, [lacking]))
        else:
            summary = one(totals[f"capacity:{i}"] | {"max_excess": None, "worst": None}, worst="array<string>")
            parts.append(capacity.capacity_row(summary, rule))
    for table, df in tables.items():
        key = rules.primary_keys.get(table)
        if key in df.columns:
            parts.append(consistency.uniqueness_row(one(totals[f"unique:{table}.{key}"]), table, key))
        columns = key_columns(df)
        nulls = {f"n{i}": totals[f"nulls:{table}.{c}"]["n"] for i, c in enumerate(columns)}
        parts.append(consistency.table_rows(one(totals[f"rows:{table}"] | nulls), table, columns))
        for column in distribution.numeric_columns(df):
            found = totals[f"values:{table}.{column}"]
            facts = one({"unique_values": found["unique"], "total_values": found["total"], "a_value": None, "common": None}, a_value="string", common="string")
            facts = facts.selectExpr(f"{_sql(column)} as field", "*", "unique_values / nullif(total_values, 0) as unique_ratio")
            parts.append(distribution.variation_rows(facts.where(distribution.VARIES_LITTLE), table))
    for i, rule in enumerate(rules.limits):
        if f"limit:{i}" in totals:
            summary = one(totals[f"limit:{i}"] | {"most": None, "mean": None}, mean="double")
            parts.append(capacity.entity_limit_row(summary, rule))
    for i, rule in enumerate(rules.field_rules):
        if f"field:{i}" in totals:
            parts.append(consistency.field_rule_row(one(totals[f"field:{i}"] | {"total": totals[f"rows:{rule.table}"]["total"]}), rule))
    parts += [check(tables) for check in rules.extra]
    return union_checks(spark, parts)
