"""Arrival order, the table store and streaming ingest on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.arrival import (
    METRICS, ArrivalReference, ArrivalRules, arrival_issues, compare_metrics, score_issues,
)
from jsonloom.operators.metrics import ingest_status
from jsonloom.operators.quality.integrity import Reference
from jsonloom.operators.quality.suite import Rules
from jsonloom.operators.shred import shred
from jsonloom.plans import ingest
from jsonloom.plans.catalog import discover
from jsonloom.plans.validate import recount
from jsonloom.session import scratch_path
from jsonloom.sources.documents import read_documents
from jsonloom.sources.export import documents
from jsonloom.sources.store import TableStore
from jsonloom.streaming.ingest import QUALITY, check_each_batch, start_ingest
from jsonloom.workload.registry import query
from jsonloom.workload.tables import ROWS_PER_DOCUMENT, exported, load, numbered, registry, registry_documents

EVENT_TYPES = ("signup", "purchase", "click", "view", "error")

SIGNUPS = ArrivalRules(
    keys={"signup": "user_id"},
    references=(ArrivalReference("purchase_user", "purchase", "user_id", "signup", "user_id", "event_id"),),
    capacity=("signup", "user_id", "room", "purchase", "user_id"),
)


def event_documents(spark, folder):
    """Events in files named by arrival, 500 event ids each, one table per event type."""

    def build():
        events = numbered(load(spark, folder, "events"), "event_id").select(
            "batch", "event_id", "user_id", "event_type", F.floor(F.col("value") / 20).cast("bigint").alias("room")
        )
        stamp = F.date_format(F.timestamp_seconds(F.col("batch")), "yyyyMMdd_HHmmss")
        events = events.withColumn("batch", F.concat(F.lit("events_"), stamp, F.lit("_000000")))
        tables = {t: events.where(F.col("event_type") == t).drop("event_type") for t in EVENT_TYPES}
        return documents(tables, "batch", order=["event_id"])

    return exported(spark, folder, "events", build, files=True)


def _positions(side: str = "true") -> str:
    """Arrival position in those files: document, then table, then event id."""
    return f"""
 e as (select event_id, user_id, event_type, floor(value / 20)::bigint as room,
  (event_id // 500) * 1000000 + (case event_type when 'signup' then 0 else 1 end) * 1000 + event_id - (event_id // 500) * 500 as pos
  from events where {side}),
 first_seen as (select user_id, min(pos) as p, max(pos) as last from e where event_type = 'signup' group by user_id),
 after as (select f.user_id, count(x.pos) as n from first_seen f left join e x
  on x.user_id = f.user_id and x.event_type = 'purchase' and x.pos > f.last group by f.user_id),
 counted as (select
  (select count(*) - count(distinct user_id) from e where event_type = 'signup') as duplicate_ids,
  (select count(*) from e x left join first_seen f on f.user_id = x.user_id
   where x.event_type = 'purchase' and (f.p is null or f.p > x.pos)) as orphaned_references,
  (select count(*) from first_seen f join e s on s.user_id = f.user_id and s.event_type = 'signup' and s.pos = f.last
   join after a on a.user_id = f.user_id where a.n > s.room) as capacity_violations, 0 as unreadable_files)
"""


@query(f"with {_positions()} select *, greatest(0.0, 100.0 - duplicate_ids - 5 * orphaned_references - 3 * capacity_violations)::double as integrity_score from counted")
def arrival_integrity_score(spark, folder):
    docs = read_documents(spark, event_documents(spark, folder), glob="*", recursive=True)
    return score_issues(arrival_issues(shred(docs, keep_rejects=True), SIGNUPS))


def _comparison_sql() -> str:
    sides = []
    for side, where in (("first", "value < 20"), ("second", "value >= 20")):
        metrics = " union all ".join(
            f"select '{m}' as metric, {m}::double as v from s" for m in METRICS
        )
        sides.append(f"""{side}_ as (with {_positions(where)}, s as (select *, greatest(0.0, 100.0 - duplicate_ids
 - 5 * orphaned_references - 3 * capacity_violations) as integrity_score from counted) {metrics})""")
    return f"""with {", ".join(sides)} select a.metric, a.v as first, b.v as second, b.v - a.v as difference
from first_ a join second_ b on a.metric = b.metric"""


@query(_comparison_sql())
def dataset_comparison(spark, folder):
    """Small and large purchases and signups as two datasets, compared metric by metric."""

    def metrics(label, where):
        def build():
            events = numbered(load(spark, folder, "events").where(where), "event_id").select(
                "batch", "event_id", "user_id", "event_type", F.floor(F.col("value") / 20).cast("bigint").alias("room")
            )
            stamp = F.date_format(F.timestamp_seconds(F.col("batch")), "yyyyMMdd_HHmmss")
            events = events.withColumn("batch", F.concat(F.lit("events_"), stamp, F.lit("_000000")))
            tables = {t: events.where(F.col("event_type") == t).drop("event_type") for t in EVENT_TYPES}
            return documents(tables, "batch", order=["event_id"])

        docs = read_documents(spark, exported(spark, folder, label, build, files=True), glob="*", recursive=True)
        return score_issues(arrival_issues(shred(docs, keep_rejects=True), SIGNUPS))

    return compare_metrics(metrics("events-small", "value < 20"), metrics("events-large", "value >= 20"), METRICS)


# -- store ---------------------------------------------------------------------------------------


@query("select event_id, user_id, event_type, value from events")
def append_no_key(spark, folder):
    """One append per event type; the store returns them together."""
    store = TableStore(spark, scratch_path(spark, "append"))
    events = load(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    for batch_id, kind in enumerate(EVENT_TYPES, 1):
        with store.batch(batch_id) as batch:
            batch.append("events", events.where(F.col("event_type") == kind))
    return store.read("events")


@query("""
select o_custkey, max_by(o_orderkey, (o_orderstatus = 'P')::int * 1000000000000 + o_orderkey) as o_orderkey from orders group by o_custkey
""")
def store_upsert(spark, folder):
    """The latest order per customer, merged in two batches: settled orders first, pending ones win."""
    store = TableStore(spark, scratch_path(spark, "upsert"), buckets=8)
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    for batch_id, where in ((1, "o_orderstatus <> 'P'"), (2, "o_orderstatus = 'P'")):
        with store.batch(batch_id) as batch:
            batch.upsert("latest", orders.where(where), ["o_custkey"], ["o_orderkey"])
    return store.read("latest").select("o_custkey", "o_orderkey")


@query("select o_orderkey as order_id, o_orderstatus as status, null::varchar as nothing from orders where false")
def empty_table(spark, folder):
    """Tables of a discovered catalog exist, typed and empty, before the first batch."""
    records = shred(read_documents(spark, registry_documents(spark, folder), lines=True, glob="*"))
    store = TableStore(spark, scratch_path(spark, "empty"))
    ingest.initialize(store, discover(records.where("table = 'orders'")))
    return store.read("orders").select("order_id", "status", F.lit(None).cast("string").alias("nothing"))


@query("""
select c.c_custkey as customer_id, count(o.o_orderkey) as orders from customer c
 left join orders o on o.o_custkey = c.c_custkey group by c.c_custkey
""")
def store_recount(spark, folder):
    store = TableStore(spark, scratch_path(spark, "recount"), buckets=8)
    tables = registry(spark, folder, "customers", "orders")
    with store.batch(1) as batch:
        batch.upsert("customers", tables["customers"], ["customer_id"], ["customer_id"])
        batch.append("orders", tables["orders"])
    recount(store, "customers", "customer_id", "orders", "customer_id", "orders")
    return store.read("customers").select("customer_id", "orders")


# -- streaming -----------------------------------------------------------------------------------


def _drained(spark, folder, label, **settings):
    """A store after the registry documents have gone through a stream to the end."""
    store = TableStore(spark, scratch_path(spark, label), buckets=8)
    stream = start_ingest(
        spark, registry_documents(spark, folder), store, scratch_path(spark, f"{label}-checkpoint"),
        lines=True, glob="*", **settings,
    )
    stream.awaitTermination()
    return store


@query("""
select o_orderkey as order_id, o_custkey as customer_id, o_totalprice as total_price, c_name as name, n_name as nation
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
""")
def stream_ingest(spark, folder):
    """Stream the documents into discovered tables, then join what was stored."""
    store = _drained(spark, folder, "stream")
    nations = store.read("nations").select("nation_id", F.col("name").alias("nation"))
    customers = store.read("customers").select("customer_id", "name", "nation_id")
    joined = store.read("orders").join(customers, "customer_id").join(nations, "nation_id")
    return joined.select("order_id", "customer_id", "total_price", "name", "nation")


@query("select 9::bigint as passed, 0::bigint as errors, count(distinct o_orderkey // 500) > 0 as loaded from orders")
def stream_quality(spark, folder):
    """Check counters kept while the stream runs: five unique keys and four sound references."""
    rules = Rules(
        references=[
            Reference("orders", "customer_id", "customers"), Reference("customers", "nation_id", "nations"),
            Reference("suppliers", "nation_id", "nations"), Reference("nations", "region_id", "regions"),
        ],
        primary_keys={
            "orders": "order_id", "customers": "customer_id", "suppliers": "supplier_id",
            "nations": "nation_id", "regions": "region_id",
        },
    )
    store = _drained(spark, folder, "stream-quality", after_batch=check_each_batch(rules))
    last = store.read(QUALITY).orderBy(F.col("batch").desc()).limit(1)
    return last.select("passed", "errors", (F.col("total") > 0).alias("loaded"))


@query("""
select count(*) as processed_count, 0::bigint as failed_count, 0::bigint as skipped_count from
 (select distinct o_orderkey // 500 from orders) t
""")
def ingest_metrics(spark, folder):
    store = _drained(spark, folder, "stream-metrics")
    status = ingest_status(spark, store.read(ingest.METRICS))
    return status.select("processed_count", "failed_count", "skipped_count")
