"""Large files, failures, changes, sketches and streams in arrival order, on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.arrival import score_issues
from jsonloom.operators.large import shred_files
from jsonloom.operators.metrics import ingest_status
from jsonloom.operators.profile import column_profile
from jsonloom.operators.quality.capacity import CapacityRule, EntityLimit
from jsonloom.operators.quality.consistency import FieldRule
from jsonloom.operators.quality.distribution import frequent_values, numeric_columns, variation
from jsonloom.operators.quality.integrity import Reference
from jsonloom.operators.quality.suite import Rules
from jsonloom.operators.shred import shred, typed_records
from jsonloom.operators.sketches import column_sketches, merge_sketches, sketched_profile
from jsonloom.plans import ingest
from jsonloom.plans.catalog import discover
from jsonloom.plans.incremental import recount_changes, update_checks
from jsonloom.session import scratch_path, shuffles_removed
from jsonloom.sources.documents import list_files, read_documents
from jsonloom.sources.export import documents, write_lines
from jsonloom.sources.reports import write_text
from jsonloom.sources.store import TableStore
from jsonloom.streaming.arrival import arrival_state_issues, start_arrival
from jsonloom.streaming.ingest import load_files, start_ingest
from jsonloom.streaming.progress import PROGRESS, ProgressLog, progress_summary
from jsonloom.streaming.rates import start_rates
from jsonloom.streaming.retries import FILES, SET_ASIDE, WAITING
from jsonloom.workload.integrity import _LINEITEM_NUMBERS
from jsonloom.workload.registry import query
from jsonloom.workload.streams import SIGNUPS, _positions, event_documents
from jsonloom.workload.tables import exported, load, numbered, registry

LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"


#: rows of the document that its writer sorts at a time
DOCUMENT_RANGE = 2**19


def one_document(spark, folder):
    """All line items as one document in one file, a record per line."""

    def build():
        fields = [c.split()[0] for c in LINE.split(", ")]
        items = load(spark, folder, "lineitem").select(*fields)
        at = F.struct("l_orderkey", "l_linenumber")
        first = at == items.agg(F.min(at)).scalar()
        ends = spark.createDataFrame([(0, '{"metadata": {"kind": "line items, all"}, "data": {"items": ['), (2, "]}}")], "part int, text string")
        rows = items.withColumn("part", F.lit(1)).unionByName(ends, allowMissingColumns=True)
        # the only file has one writer, which sorts a range of the order at a time, so that nothing is spilled; rows are dealt and
        # sorted without their text. The key comes first in their order: they are compared by a number
        place = F.when(F.col("part") == 1, F.col("l_orderkey")).when(F.col("part") == 0, -(2**63)).otherwise(2**63 - 1)
        order = [place, "part", "l_linenumber"]
        ranges = max(1, items.count() // DOCUMENT_RANGE)
        in_order = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).coalesce(1)
        line = F.concat(F.when(first, F.lit("  ")).otherwise(F.lit(", ")), F.to_json(F.struct(*fields)))
        return in_order.select(F.coalesce("text", line).alias("text"))

    with shuffles_removed(spark):
        return exported(spark, folder, "one-document", build)


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag from lineitem")
def shred_large_document(spark, folder):
    """One document that is read by byte ranges."""
    records = shred_files(spark, one_document(spark, folder), "*", large=1000)
    return typed_records(records.where("table = 'items'"), T.StructType.fromDDL(LINE), keep=[]).drop("lost_fields")


@query("select count(*) as customers, 0::bigint as waiting, 1::bigint as set_aside, 1::bigint as failed_count, 1::bigint as rejects from customer")
def stream_retries(spark, folder):
    """A stream with a file that cannot be read: the others load, it is tried with two more batches and set aside."""
    path = scratch_path(spark, "retries")
    rows = numbered(load(spark, folder, "customer").selectExpr("c_custkey as customer_id", "c_name as name"), "customer_id")
    write_lines(documents({"customers": rows}, "batch"), path)
    write_text(spark, f"{path}/broken.txt.gz", "this is no archive")
    store = TableStore(spark, scratch_path(spark, "retries-store"), buckets=8)
    start_ingest(spark, path, store, scratch_path(spark, "retries-checkpoint"), lines=True, glob="*.txt*").awaitTermination()
    for _ in range(2):
        load_files(store, [], lines=True)
    files = store.read(FILES)
    counts = files.agg(F.count_if(F.col("state") == WAITING).alias("waiting"), F.count_if(F.col("state") == SET_ASIDE).alias("set_aside"))
    failed = ingest_status(spark, store.read(ingest.METRICS)).select("failed_count").scalar()
    rejects = store.read(ingest.REJECTS).agg(F.count(F.lit(1))).scalar()
    customers = store.read("customers").agg(F.count(F.lit(1))).scalar()
    return counts.select(customers.alias("customers"), "waiting", "set_aside", failed.alias("failed_count"), rejects.alias("rejects"))


@query("""
select count(*) filter (where s = 'O') as processed_count, count(*) filter (where s = 'F') as failed_count,
 count(*) filter (where s = 'P') as skipped_count, count(*) as input_rows
from (select distinct o_orderstatus as s, o_orderkey // 10 as doc from orders) t
""")
def ingest_outcomes(spark, folder):
    """Documents of one order status each: open ones load, finished ones are cut off, pending ones have an unknown table."""

    def build():
        orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
        batch = F.concat_ws("-", "o_orderstatus", F.floor(F.col("o_orderkey") / 10).cast("string"))
        rows = orders.withColumn("batch", batch)
        known = documents({"orders": rows.where("o_orderstatus = 'O'").drop("o_orderstatus")}, "batch")
        cut = documents({"orders": rows.where("o_orderstatus = 'F'").drop("o_orderstatus")}, "batch").withColumn("text", F.expr("substring(text, 1, length(text) - 1)"))
        return known.unionByName(cut).unionByName(documents({"plans": rows.where("o_orderstatus = 'P'").drop("o_orderstatus")}, "batch"))

    path = exported(spark, folder, "outcomes", build)
    store = TableStore(spark, scratch_path(spark, "outcomes"), buckets=8)
    # from all that can be read: the first lines of the files may all be cut off
    known = shred(read_documents(spark, path, lines=True, glob="*")).where("table = 'orders'")
    ingest.initialize(store, discover(known))
    log = ProgressLog()
    spark.streams.addListener(log)
    options = ingest.IngestOptions(frozen=True)
    started = start_ingest(spark, path, store, scratch_path(spark, "outcomes-checkpoint"), lines=True, glob="part*", options=options)
    started.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(log)
    log.save(store)
    status = ingest_status(spark, store.read(ingest.METRICS))
    assert progress_summary(store.read(PROGRESS)).first().input_rows > 0
    documents_in = read_documents(spark, path, lines=True, glob="part*").agg(F.count(F.lit(1))).scalar()
    return status.select("processed_count", "failed_count", "skipped_count", documents_in.alias("input_rows"))


_RULES = Rules(
    references=[Reference("orders", "customer_id", "customers")],
    primary_keys={"orders": "order_id", "customers": "customer_id"},
    capacities=[CapacityRule("customers", "customer_id", "nation_id", "orders", "customer_id")],
    limits=[EntityLimit("orders", "customer_id", 15)],
    field_rules=[FieldRule("customers", ("balance",), "balance < 0")],
)


@query("""
with c as (select c_custkey, c_nationkey, c_acctbal from customer where c_mktsegment <> 'BUILDING'),
 n as (select o_custkey, count(*) as n from orders group by o_custkey)
select 'Referential Integrity: orders.customer_id → customers.customer_id' as check_name, count(*) as affected_count from orders
 where o_custkey not in (select c_custkey from c)
union all select 'Primary Key Uniqueness: orders.order_id', 0 union all select 'Primary Key Uniqueness: customers.customer_id', 0
union all select 'Class Capacity Constraints', count(*) from c left join n on c_custkey = o_custkey where coalesce(n, 0) > c_nationkey
union all select 'Student Enrollment Limits', count(*) from n where n > 15
union all select 'Age-Grade Consistency', count(*) from c where c_acctbal < 0
union all select 'Data Variation: customers.nation_id', null where false
""")
def checks_by_changes(spark, folder):
    """The suite's counts after three batches, each added to the counts so far: orders, customers, and orders that are written again."""
    store = TableStore(spark, scratch_path(spark, "check-changes"), buckets=8)
    tables = registry(spark, folder, "customers", "orders")
    customers = tables["customers"].where("segment <> 'BUILDING'").select("customer_id", "name", "nation_id", "balance")
    orders = tables["orders"].select("order_id", "customer_id", "status", "total_price")
    # half of the orders come first under another customer
    steps = [
        ("orders", orders.withColumn("customer_id", F.when(F.col("order_id") % 2 == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id"))), "order_id"),
        ("customers", customers, "customer_id"),
        ("orders", orders.where("order_id % 2 = 0"), "order_id"),
    ]
    for table, rows, key in steps:
        with store.batch() as batch:
            batch.upsert(table, rows, [key], [key])
        checks = update_checks(store, _RULES)
    return checks.where(~F.col("check_name").startswith("Data Variation")).select("check_name", "affected_count")


@query("""
select c.c_custkey as customer_id, count(o.o_orderkey) as orders from customer c
 left join orders o on o.o_custkey = c.c_custkey group by c.c_custkey
""")
def recount_by_changes(spark, folder):
    """Order counts kept up to date over batches of orders; parents that a batch does not touch are not read."""
    store = TableStore(spark, scratch_path(spark, "recount-changes"), buckets=8)
    tables = registry(spark, folder, "customers", "orders")
    orders = tables["orders"].select("order_id", "customer_id")
    parts = [tables["customers"].where("customer_id % 3 > 0"), tables["customers"].where("customer_id % 3 = 0")]
    for i, customers in enumerate(parts):
        with store.batch() as batch:
            batch.upsert("customers", customers.withColumn("orders", F.lit(0).cast("bigint")), ["customer_id"], ["customer_id"])
            batch.upsert("orders", orders.where(F.col("order_id") % 2 == i), ["order_id"], ["order_id"])
        recount_changes(store, "customers", "customer_id", "orders", "customer_id", "orders")
    return store.read("customers").select("customer_id", "orders")


@query(" union all ".join(f"""
select '{c}' as field, count({c}) as total_values, count(distinct {c}) as unique_values, true as close from lineitem""" for c in _LINEITEM_NUMBERS))
def approximate_variation(spark, folder):
    """Distinct counts from sketches, beside the exact ones: within 4 % (five standard errors)."""
    items = load(spark, folder, "lineitem")
    exact = variation(items, list(_LINEITEM_NUMBERS), "lineitem")
    near = variation(items, list(_LINEITEM_NUMBERS), "lineitem", approximate=True).select(F.col("field").alias("f"), F.col("unique_values").alias("estimate"))
    close = F.abs(F.col("estimate") - F.col("unique_values")) <= 0.04 * F.col("unique_values")
    return exact.join(near, F.col("field") == F.col("f")).select("field", "total_values", "unique_values", close.alias("close"))


@query(" union all ".join(f"""
select 'orders' as "table", '{c}' as field, count(*) as record_count, count(*) - count({c}) as null_count, true as close,
 {"max(length(" + c + "))" if c in ("o_orderstatus", "o_orderpriority") else "null"}::bigint as max_length
 from orders""" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")))
def sketched_field_profile(spark, folder):
    """A profile from sketches of five batches of orders, merged; distinct counts within 4 % of the exact ones."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    batches = None
    for i in range(5):
        some = column_sketches(orders.where(F.col("o_orderkey") % 5 == i), "orders")
        batches = some if batches is None else batches.unionByName(some)
    near = sketched_profile(merge_sketches(batches))
    exact = column_profile(orders, "orders").select(F.col("field").alias("f"), F.col("unique_values").alias("exact"))
    close = F.abs(F.col("unique_values") - F.col("exact")) <= 0.04 * F.col("exact")
    return near.join(exact, F.col("field") == F.col("f")).select("table", "field", "record_count", "null_count", close.alias("close"), "max_length")


@query(" union all ".join(f"""
select '{c}' as field, v::double as value, n from (select {c} as v, n, row_number() over (order by n desc, {c}) as rn
 from (select {c}, count(*) as n from lineitem where {c} is not null group by {c}) t) u where rn <= 5
""" for c in _LINEITEM_NUMBERS))
def heavy_hitters(spark, folder):
    """The five most frequent values of each column, by candidates and classes."""
    items = load(spark, folder, "lineitem")
    top = frequent_values(items, numeric_columns(items.select(*_LINEITEM_NUMBERS)), 5)
    return top.select("field", F.coalesce(F.col("long_value").cast("double"), "double_value").alias("value"), "n")


@query(f"with {_positions()} select *, greatest(0.0, 100.0 - duplicate_ids - 5 * orphaned_references - 3 * capacity_violations)::double as integrity_score from counted")
def stream_arrival_integrity(spark, folder):
    """The arrival analysis kept up to date over three micro-batches of event files."""
    path = f"{event_documents(spark, folder)}/*"
    files = list_files(spark, path).count()
    store = TableStore(spark, scratch_path(spark, "arrival-state"), buckets=8)
    start_arrival(
        spark, path, store, scratch_path(spark, "arrival-checkpoint"), SIGNUPS, "events", glob="*.txt", max_files=max(1, -(-files // 3)),
    ).awaitTermination()
    return score_issues(arrival_state_issues(store, SIGNUPS))


@query("""
with files as (select distinct event_id // 500 as second from events)
select (second // 5) * 5 as window_start, count(*) as files, count(*) / 5.0::double as files_per_second from files
group by 1 having (second // 5) * 5 + 5 <= (select max(second) from files) - 2
""")
def arrival_rate_windows(spark, folder):
    """Files per five seconds of arrival, of all windows that were closed two seconds of arrival before the last file."""
    sink = scratch_path(spark, "rates")
    start_rates(
        spark, f"{event_documents(spark, folder)}/*", sink, scratch_path(spark, "rates-checkpoint"), "5 seconds", "2 seconds", glob="*.txt",
    ).awaitTermination()
    schema = "window_start timestamp, window_end timestamp, files bigint, bytes bigint, files_per_second double"
    return spark.read.schema(schema).parquet(sink).select(F.unix_seconds("window_start").alias("window_start"), "files", "files_per_second")
