"""JSON documents made from the given tables, read back, shredded and profiled."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.functions.names import EXTENDED_DESCRIPTIONS
from jsonloom.operators import keys as K
from jsonloom.operators import metrics as M
from jsonloom.operators.align import align_columns as aligned
from jsonloom.operators.align import union_batches
from jsonloom.operators.contracts import Contract, Field, check_documents, check_table
from jsonloom.operators.ordering import with_previous
from jsonloom.operators.profile import column_profile
from jsonloom.operators.shred import shred as shredded
from jsonloom.operators.shred import typed_records
from jsonloom.plans.catalog import completeness, discover
from jsonloom.session import scratch_path
from jsonloom.sources import tables as sidecars
from jsonloom.sources.documents import list_files, quarantine, read_documents, sample_documents
from jsonloom.sources.export import documents
from jsonloom.sources.reports import schema_documents, write_text
from jsonloom.workload.registry import query
from jsonloom.workload.tables import (
    ROWS_PER_DOCUMENT, customer_files, exported, load, numbered, registry_documents,
)

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _customer_docs(spark, folder):
    return read_documents(spark, customer_files(spark, folder), glob="*", recursive=True)


def _registry_records(spark, folder):
    return shredded(read_documents(spark, registry_documents(spark, folder), lines=True, glob="*"))


def _catalog(spark, folder, **settings):
    return discover(_registry_records(spark, folder), **settings)


def _document_of(path="path"):
    return F.regexp_extract(path, "batch=([0-9]+)", 1).cast("bigint")


# -- sources -------------------------------------------------------------------------------------


@query("""
select c_custkey // 500 as doc, count(*) as records, min(c_custkey) as first_key, max(c_custkey) as last_key
from customer group by 1
""")
def json_scan(spark, folder):
    docs = _customer_docs(spark, folder)
    keys = F.from_json(F.get_json_object("text", "$.customer"), "array<struct<c_custkey: bigint>>")["c_custkey"]
    return docs.select(
        _document_of().alias("doc"), F.size(keys).cast("bigint").alias("records"),
        F.array_min(keys).alias("first_key"), F.array_max(keys).alias("last_key"),
    )


@query("""
select doc, count(*) as sampled from (select c_custkey // 500 as doc, row_number() over
 (partition by c_custkey // 500 order by c_custkey) as rn from customer
 where c_custkey // 500 in (select distinct c_custkey // 500 from customer order by cast(c_custkey // 500 as varchar) limit 2)) t
where rn <= 100 group by doc
""")
def json_scan_sampled(spark, folder):
    docs = sample_documents(spark, customer_files(spark, folder), files=2, glob="*", recursive=True)
    return shredded(docs, max_records=100).groupBy(_document_of().alias("doc")).agg(F.count(F.lit(1)).alias("sampled"))


@query("""
select doc_id, 'not a JSON object' as reason, length(text) as n_chars from documents
""")
def json_quarantine(spark, folder):
    """Event properties are JSON objects; prose is not and must come out whole."""
    props = load(spark, folder, "events").select(F.lit(None).cast("bigint").alias("doc_id"), F.col("props").alias("text"))
    prose = load(spark, folder, "documents").select("doc_id", "text")
    return quarantine(props.unionByName(prose)).select("doc_id", "reason", F.length("text").cast("bigint").alias("n_chars"))


@query("select count(*) as documents, sum(n)::bigint as records from (select c_custkey // 500, count(*) as n from customer group by 1) t")
def file_metrics(spark, folder):
    """File and record counts; the byte sizes are in the same row of the operator but have no SQL counterpart."""
    files = M.size_metrics(list_files(spark, customer_files(spark, folder), recursive=True).where(F.col("path").contains("batch=")))
    records = M.entity_metrics(shredded(_customer_docs(spark, folder)))
    return files.select("files").withColumn("records", records.select("entities_total").scalar()).select(
        F.col("files").alias("documents"), "records"
    )


@query("""
with records as (
  select c_custkey // 500 as doc, c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
   'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) as r from customer),
 files as (select strlen('{"customer":[' || string_agg(r, ',' order by c_custkey) || ']}') + 1 as n from records group by doc),
 span as (select date_diff('microsecond', min(ts), max(ts)) / 1e6 as s from events)
select count(*) as files, avg(n) as size_bytes_avg, min(n) as size_bytes_min, max(n) as size_bytes_max, sum(n)::bigint as size_bytes_total,
 round(count(*) / any_value(s), 6)::double as files_per_second, 100.0::double * count(*) / (1 + (select max(o_custkey) // 500 from orders)) as completion_pct
from files, span
""")
def file_sizes(spark, folder):
    """Sizes of the customers' files, their rate over the span of the events, and how many of those that orders name are there."""
    files = list_files(spark, customer_files(spark, folder), recursive=True).where(F.col("path").contains("batch="))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = load(spark, folder, "events").agg(((F.max(at) - F.min(at)) / 1e6).alias("s")).scalar()
    expected = load(spark, folder, "orders").agg((F.floor(F.max("o_custkey") / ROWS_PER_DOCUMENT) + 1).alias("n")).scalar()
    return M.rates(M.size_metrics(files), seconds, expected).withColumn("files_per_second", F.round("files_per_second", 6))


@query("""
select round(avg(n), 4)::double as entities_avg, min(n) as entities_min, max(n) as entities_max, sum(n)::bigint as entities_total
from (select c_custkey // 500 as doc, count(*) as n from customer group by 1) t
""")
def entities_per_file(spark, folder):
    metrics = M.entity_metrics(shredded(_customer_docs(spark, folder)))
    return metrics.withColumn("entities_avg", F.round("entities_avg", 4))


@query("""
select event_id, epoch_us(case when event_type = 'error' then timestamp '2001-02-03 04:05:06' else ts end) as arrived_us from events
""")
def file_timestamps(spark, folder):
    """Names of the agreed form carry the time; the others fall back to the file time."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd_HHmmss_SSSSSS")
    name = F.when(F.col("event_type") == "error", F.lit("incoming/error.json")).otherwise(
        F.concat(F.lit("incoming/data_"), stamp, F.lit(".json"))
    )
    files = load(spark, folder, "events").select(
        "event_id", name.alias("path"), F.lit("2001-02-03 04:05:06").cast("timestamp").alias("modificationTime")
    )
    return M.arrival_times(files).select("event_id", F.unix_micros("arrived_at").alias("arrived_us"))


@query("""
select event_id, us - lag(us) over (order by us) as waited_us from (select event_id, epoch_us(ts) as us from events) t
""")
def consecutive_waits(spark, folder):
    events = load(spark, folder, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return with_previous(events, "us").select("event_id", (F.col("us") - F.col("previous")).alias("waited_us"))


# -- shredding -----------------------------------------------------------------------------------


@query("""
select 'regions' as table_name, count(*) as n from region union all select 'nations', count(*) from nation
union all select 'customers', count(*) from customer union all select 'suppliers', count(*) from supplier
union all select 'orders', count(*) from orders
""")
def shred(spark, folder):
    records = _registry_records(spark, folder)
    return records.groupBy(F.col("table").alias("table_name")).agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def export_roundtrip(spark, folder):
    records = shredded(_customer_docs(spark, folder)).where("table = 'customer'")
    return typed_records(records, T.StructType.fromDDL(CUSTOMER), keep=[]).drop("lost_fields")


@query("""
select vec_id, i - 1 as index, embedding[i]::double as value from embeddings, unnest(range(1, len(embedding) + 1)) as t(i)
""")
def shred_primitive_list(spark, folder):
    def build():
        values = F.transform("embedding", lambda v: v.cast("double"))
        text = F.to_json(F.struct(values.alias("embedding"), F.struct("vec_id").alias("about")))
        return load(spark, folder, "embeddings").select(text.alias("text"))

    path = exported(spark, folder, "embeddings", build)
    docs = read_documents(spark, path, lines=True, glob="*")
    about = docs.select("path", "block_start", "line_id", F.get_json_object("text", "$.about.vec_id").cast("bigint").alias("vec_id"))
    values = shredded(docs).where("table = 'embedding'")
    schema = T.StructType.fromDDL("value double, index bigint")
    typed = typed_records(values, schema, keep=["path", "block_start", "line_id"])
    return typed.join(about, ["path", "block_start", "line_id"]).select("vec_id", "index", "value")


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def shred_object(spark, folder):
    """One document per supplier whose only entry is an object: a one-row table each."""

    def build():
        supplier = load(spark, folder, "supplier")
        return supplier.select(F.to_json(F.struct(F.struct("*").alias("supplier"))).alias("text"))

    records = shredded(read_documents(spark, exported(spark, folder, "supplier", build), lines=True, glob="*"))
    schema = T.StructType.fromDDL("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return typed_records(records.where("table = 'supplier'"), schema, keep=[]).drop("lost_fields")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def shred_props(spark, folder):
    events = load(spark, folder, "events").select("event_id", "props")
    return typed_records(events, T.StructType.fromDDL("k bigint"), text="props", keep=["event_id"]).drop("lost_fields")


@query("select event_type, count(*) as n from events group by event_type")
def entity_counts(spark, folder):
    from jsonloom.operators.arrival import entity_counts as counts
    from jsonloom.workload.streams import event_documents

    docs = read_documents(spark, event_documents(spark, folder), glob="*", recursive=True)
    return counts(shredded(docs)).withColumnRenamed("table", "event_type")


# -- alignment -----------------------------------------------------------------------------------


@query("""
select event_id, user_id, value, cast(null as varchar) as event_type from events where event_type in ('signup', 'purchase')
union all select event_id, user_id, cast(null as double) as value, event_type from events where event_type not in ('signup', 'purchase')
""")
def union_by_name(spark, folder):
    events = load(spark, folder, "events")
    first = events.where("event_type in ('signup', 'purchase')").select("event_id", "user_id", "value")
    second = events.where("event_type not in ('signup', 'purchase')").select("event_type", "user_id", "event_id")
    return union_batches([first, second])


@query("""
select event_id, case when value = floor(value) then cast(value as bigint) end as value_or_null, cast(null as varchar) as note, event_type,
 case when value = floor(value) then 0 else 1 end as lost from events
""")
def align_columns(spark, folder):
    events = load(spark, folder, "events").select("event_id", F.col("value").alias("whole"), "value", "event_type")
    schema = T.StructType.fromDDL("event_id bigint, whole bigint, note string, event_type string")
    return aligned(events, schema).select(
        "event_id", F.col("whole").alias("value_or_null"), "note", "event_type",
        F.size("lost_fields").cast("bigint").alias("lost"),
    )


_ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(" union all ".join(f"""
select 'orders' as "table", '{c}' as field, count(*) as record_count, count(*) - count({c}) as null_count,
 count(distinct {c}) as unique_values, {"max(length(" + c + "))" if c in ("o_orderstatus", "o_orderpriority") else "null"}::bigint as max_length
 from orders""" for c in _ORDERS_COLUMNS))
def field_profile(spark, folder):
    profile = column_profile(load(spark, folder, "orders"), "orders")
    text = F.col("field").isin("o_orderstatus", "o_orderpriority")
    return profile.withColumn("max_length", F.when(text, F.col("max_length")))


# -- discovery -----------------------------------------------------------------------------------

_FIELDS = {
    "regions": ("region", {"region_id": "bigint", "name": "string"}),
    "nations": ("nation", {"nation_id": "bigint", "name": "string", "region_id": "bigint"}),
    "customers": (
        "customer",
        {"customer_id": "bigint", "name": "string", "nation_id": "bigint", "balance": "double", "segment": "string"},
    ),
    "suppliers": ("supplier", {"supplier_id": "bigint", "name": "string", "nation_id": "bigint", "balance": "double"}),
    "orders": (
        "orders",
        {
            "order_id": "bigint", "customer_id": "bigint", "status": "string", "total_price": "double",
            "order_date": "string", "priority": "string",
        },
    ),
}


@query(" union all ".join(
    f"""select '{t}' as table_name, '{f}' as field, {i} as field_order, '{kind}' as data_type, false as nullable,
 count(*) as record_count from {given}"""
    for t, (given, fields) in _FIELDS.items()
    for i, (f, kind) in enumerate(fields.items(), 1)
))
def json_profile(spark, folder):
    return _catalog(spark, folder).profile.select(
        F.col("table").alias("table_name"), "field", F.col("field_order").cast("bigint").alias("field_order"),
        "data_type", "nullable", "record_count",
    )


@query("""
select event_type as table_name,
 case event_type when 'signup' then 'string' when 'purchase' then 'double' when 'view' then 'string'
  when 'click' then 'array<double>' else 'boolean' end as default_type,
 case event_type when 'signup' then 'bigint' when 'purchase' then 'double' when 'view' then 'boolean'
  when 'click' then 'array<bigint>' else 'boolean' end as reference_type, count(*) as n
from events group by event_type
""")
def resolve_types(spark, folder):
    """Each event type mixes JSON types of its own: int+text, int+float, bool+text, int+float lists, bool."""

    def build():
        number, even = F.floor("value").cast("string"), F.col("event_id") % 2 == 0
        value = (
            F.when(F.col("event_type") == "signup", F.when(even, number).otherwise(F.lit('"n/a"')))
            .when(F.col("event_type") == "purchase", F.when(even, number).otherwise(F.concat(number, F.lit(".5"))))
            .when(F.col("event_type") == "view", F.when(even, F.lit("true")).otherwise(F.lit('"no"')))
            .when(F.col("event_type") == "click", F.concat(F.lit("["), number, F.lit(", "), number, F.lit(".5]")))
            .otherwise(F.when(even, F.lit("true")).otherwise(F.lit("false")))
        )
        text = F.concat(F.lit('{"'), "event_type", F.lit('":[{"v":'), value, F.lit("}]}"))
        return load(spark, folder, "events").select(text.alias("text"))

    records = shredded(read_documents(spark, exported(spark, folder, "mixed", build), lines=True, glob="*"))
    catalog = discover(records)
    reference = type(catalog)(catalog.table_facts, catalog.field_facts, "reference")
    return catalog.profile.select("table", F.col("data_type").alias("default_type"), F.col("record_count").alias("n")).join(
        reference.profile.select("table", F.col("data_type").alias("reference_type")), "table"
    ).withColumnRenamed("table", "table_name")


@query("""
select 'regions' as table_name, 'region_id' as primary_key union all select 'nations', 'nation_id'
union all select 'customers', 'customer_id' union all select 'suppliers', 'supplier_id' union all select 'orders', 'order_id'
""")
def detect_pk(spark, folder):
    return _catalog(spark, folder).primary_keys.withColumnRenamed("table", "table_name")


_EDGES = (("customers", "nation_id", "nations"), ("nations", "region_id", "regions"),
          ("orders", "customer_id", "customers"), ("suppliers", "nation_id", "nations"))


@query(" union all ".join(f"select '{a}' as from_table, '{k}' as foreign_key, '{b}' as to_table" for a, k, b in _EDGES))
def detect_fk(spark, folder):
    return _catalog(spark, folder).foreign_keys.drop("field_order")


@query(" union all ".join(
    f"select '{a}' as from_table, '{k}' as foreign_key, '{b}' as to_table, 'one_to_many' as relationship_type" for a, k, b in _EDGES
))
def relationships(spark, folder):
    return _catalog(spark, folder).relationships


@query(" union all ".join(
    f"""select '{a}' as from_table, '{k}' as foreign_key, '{b}' as to_table,
 '    {b.upper()} ||--o{{ {a.upper()} : "{k}"' as edge""" for a, k, b in _EDGES
))
def er_edges(spark, folder):
    return K.er_edges(_catalog(spark, folder).relationships)


@query("""
select 'regions' as table_name, count(*) as record_count, 2 as field_count, 'region_id' as primary_key, '' as links from region
union all select 'nations', count(*), 3, 'nation_id', 'region_id->regions' from nation
union all select 'customers', count(*), 5, 'customer_id', 'nation_id->nations' from customer
union all select 'suppliers', count(*), 4, 'supplier_id', 'nation_id->nations' from supplier
union all select 'orders', count(*), 6, 'order_id', 'customer_id->customers' from orders
""")
def schema_summary(spark, folder):
    return _catalog(spark, folder).summary.select(
        F.col("table").alias("table_name"), "record_count", "field_count", "primary_key",
        F.array_join("foreign_keys", ",").alias("links"),
    )


_DESCRIBED = {"customer_id": "Identifier field", "order_id": "Identifier field", "supplier_id": "Identifier field",
              "region_id": "Identifier field", "nation_id": "Identifier field", "name": "Name field", "order_date": "Date field"}


@query(" union all ".join(
    "select '{}' as table_name, '{}' as field, '{}' as description, count(*) as record_count from {}".format(
        t, f, next((f"References {b}" for a, k, b in _EDGES if (a, k) == (t, f)), _DESCRIBED.get(f, "")), given
    )
    for t, (given, fields) in _FIELDS.items() for f in fields
))
def field_descriptions(spark, folder):
    catalog = _catalog(spark, folder)
    return K.field_descriptions(catalog.profile, catalog.foreign_keys, EXTENDED_DESCRIPTIONS).select(
        F.col("table").alias("table_name"), "field", "description", "record_count"
    )


@query("""
select field, 2 * count(*) as record_count, 2 * count(*) as present_count, data_type from customer,
 (values ('customer_id', 'bigint'), ('name', 'string'), ('nation_id', 'bigint'), ('balance', 'double'), ('segment', 'string')) as f(field, data_type)
group by field, data_type
""")
def profile_merge(spark, folder):
    """Discovery repeated over the same documents: counts add up, types and keys stay."""
    records = _registry_records(spark, folder).where("table = 'customers'")
    once = discover(records)
    return once.merge(discover(records)).profile.select("field", "record_count", "present_count", "data_type")


@query("""
select 5 as tables, (select count(*) from region) + (select count(*) from nation) + (select count(*) from customer)
 + (select count(*) from supplier) + (select count(*) from orders) as records, 5 as tables_with_key,
 100.0::double as completeness_pct, 100.0::double as score
""")
def catalog_completeness(spark, folder):
    return completeness(_catalog(spark, folder))


@query("select 5 as tables, 20 as fields, 4 as foreign_keys, least(100.0, 10.0 * 5 + 2.0 * 20 + 5.0 * 4)::double as complexity")
def schema_complexity(spark, folder):
    return M.complexity(_catalog(spark, folder).summary)


@query("""
select t.table_name, t.record_count, t.primary_key, e.links from
 (select 'regions' as table_name, count(*) as record_count, 'region_id' as primary_key from region
  union all select 'nations', count(*), 'nation_id' from nation union all select 'customers', count(*), 'customer_id' from customer
  union all select 'suppliers', count(*), 'supplier_id' from supplier union all select 'orders', count(*), 'order_id' from orders) t
 left join (values ('nations', 'region_id->regions'), ('customers', 'nation_id->nations'), ('suppliers', 'nation_id->nations'),
  ('orders', 'customer_id->customers')) as e(table_name, links) on t.table_name = e.table_name
""")
def catalog_load(spark, folder):
    """Schema and relationship documents written for a catalog and loaded again."""
    path = scratch_path(spark, "sidecar")
    schema, graph = schema_documents(_catalog(spark, folder), "2024-01-01T00:00:00")
    write_text(spark, f"{path}/schema_documentation.json", schema)
    write_text(spark, f"{path}/table_relationships.json", graph)
    tables = sidecars.read_schema_sidecar(spark, f"{path}/schema_documentation.json")
    edges = sidecars.sidecar_relationships(spark, tables, f"{path}/table_relationships.json")
    links = edges.groupBy(F.col("from_table").alias("table")).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat("foreign_key", F.lit("->"), "to_table"))), ",").alias("links")
    )
    return tables.join(links, "table", "left").select(F.col("table").alias("table_name"), "record_count", "primary_key", "links")


# -- contracts -----------------------------------------------------------------------------------

ORDER = Contract(
    "orders", "o_orderkey",
    (
        Field("o_orderkey", "bigint"), Field("o_custkey", "bigint"), Field("o_orderpriority"),
        Field("o_totalprice", "double", low=0, high=480000), Field("o_orderstatus", required=False),
    ),
    {"key not below customer": "o_orderkey >= o_custkey"},
)


@query("""
select o_orderstatus, count(*) filter (where ok) as valid, count(*) filter (where not ok) as rejected from
 (select o_orderstatus, o_totalprice between 0 and 480000 and o_orderpriority is not null and o_orderkey >= o_custkey as ok from orders) t
group by o_orderstatus
""")
def record_contract(spark, folder):
    checked = check_table(load(spark, folder, "orders"), ORDER)
    ok = F.size("violations") == 0
    return checked.groupBy("o_orderstatus").agg(
        F.count(F.when(ok, F.lit(1))).alias("valid"), F.count(F.when(~ok, F.lit(1))).alias("rejected")
    )


@query("""
select count(*) as documents, count(*) filter (where good) as accepted, coalesce(sum(n) filter (where good), 0)::bigint as accepted_records
from (select o_orderkey // 10 as doc, count(*) as n, bool_and(o_totalprice between 0 and 480000 and o_orderkey >= o_custkey) as good
 from orders group by 1) t
""")
def reject_documents(spark, folder):
    """Ten orders per document; one bad order rejects its document."""

    def build():
        rows = load(spark, folder, "orders").drop("o_orderdate").withColumn("batch", F.floor(F.col("o_orderkey") / 10))
        return documents({"orders": rows}, "batch")

    docs = read_documents(spark, exported(spark, folder, "tens", build), lines=True, glob="*")
    good = F.size("violations") == 0
    return check_documents(docs, [ORDER]).agg(
        F.count(F.lit(1)).alias("documents"), F.count(F.when(good, F.lit(1))).alias("accepted"),
        F.coalesce(F.sum(F.when(good, F.size("orders").cast("bigint"))), F.lit(0)).alias("accepted_records"),
    )


@query("""
select o_orderkey // 10 as doc, count(*) filter (where ok) as kept, count(*) filter (where not ok) as rejected
from (select o_orderkey, o_totalprice between 0 and 480000 and o_orderkey >= o_custkey as ok from orders) t group by 1
""")
def reject_records(spark, folder):
    """Ten orders per document; a bad order rejects itself only."""

    def build():
        rows = load(spark, folder, "orders").drop("o_orderdate").withColumn("batch", F.floor(F.col("o_orderkey") / 10))
        return documents({"orders": rows}, "batch")

    docs = read_documents(spark, exported(spark, folder, "tens", build), lines=True, glob="*")
    key = F.coalesce(F.get("orders.o_orderkey", F.lit(0)), F.get_json_object(F.get("rejected.record", F.lit(0)), "$.o_orderkey").cast("bigint"))
    return check_documents(docs, [ORDER], "record").select(
        F.floor(key / 10).cast("bigint").alias("doc"), F.size("orders").cast("bigint").alias("kept"), F.size("rejected").cast("bigint").alias("rejected")
    )
