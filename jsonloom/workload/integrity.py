"""Keys, references, capacity and counts on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jsonloom.operators import allocate, relate
from jsonloom.operators.ordering import gap_statistics, keep_last, sequential_ids
from jsonloom.operators.quality.capacity import capacity_violations as violations
from jsonloom.operators.quality.consistency import null_rates
from jsonloom.operators.quality.distribution import constant_columns as constants
from jsonloom.operators.quality.distribution import low_variation as low
from jsonloom.operators.quality.distribution import numeric_columns
from jsonloom.operators.quality.distribution import top_values as most_frequent
from jsonloom.operators.quality.integrity import Reference, integrity_checks
from jsonloom.operators.quality.rows import union_checks
from jsonloom.operators.quality.suite import count_checks
from jsonloom.workload.registry import query
from jsonloom.workload.tables import load, registry


def _other_customers(spark, folder):
    return load(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")


@query("""
select o_orderkey, o_custkey from orders o where o_custkey is not null and not exists
 (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_mktsegment <> 'BUILDING')
""")
def fk_orphans(spark, folder):
    rows = relate.orphan_rows(load(spark, folder, "orders"), "o_custkey", _other_customers(spark, folder), "c_custkey")
    return rows.select("o_orderkey", "o_custkey")


@query("""
select count(o.o_custkey) as total_foreign_keys, count(distinct o.o_custkey) as unique_references,
 cast(sum(case when c.k is null then 1 else 0 end) as bigint) as orphaned_count,
 count(distinct case when c.k is null then o.o_custkey end) as orphaned_values,
 (select count(distinct c_custkey) from customer where c_mktsegment <> 'BUILDING') as total_primary_keys
from orders o left join (select distinct c_custkey as k from customer where c_mktsegment <> 'BUILDING') c
 on o.o_custkey = c.k where o.o_custkey is not null
""")
def fk_integrity_summary(spark, folder):
    return relate.reference_summary(
        load(spark, folder, "orders"), "o_custkey", _other_customers(spark, folder), "c_custkey"
    )


@query("""
select 'Referential Integrity: orders.customer_id → customers.customer_id' as check_name, n = 0 as passed,
 case when n = 0 then 'INFO' else 'ERROR' end as severity, n as affected_count
from (select count(*) as n from orders where o_custkey not in
 (select c_custkey from customer where c_mktsegment <> 'BUILDING')) t
union all select 'Table Existence for orders → invoices', false, 'ERROR', 0
union all select 'Foreign Key Column buyer_id', false, 'ERROR', 0
union all select 'Primary Key Detection for segments', false, 'WARNING', 0
""")
def fk_preconditions(spark, folder):
    tables = registry(spark, folder, "customers", "orders")
    tables["customers"] = tables["customers"].where("segment <> 'BUILDING'")
    tables["segments"] = tables["customers"].select("segment")
    references = [
        Reference("orders", "customer_id", "customers"),
        Reference("orders", "invoice_id", "invoices"),
        Reference("orders", "buyer_id", "customers"),
        Reference("customers", "segment", "segments"),
    ]
    checks = union_checks(spark, integrity_checks(spark, tables, references, {"customers": "customer_id"}))
    return checks.select("check_name", "passed", "severity", "affected_count")


@query("""
select c.c_custkey, coalesce(n.cnt, 0) as enrolled, 8 + c.c_nationkey % 10 as capacity,
 coalesce(n.cnt, 0) - (8 + c.c_nationkey % 10) as excess from customer c left join
 (select o_custkey, count(*) as cnt from orders group by o_custkey) n on c.c_custkey = n.o_custkey
where coalesce(n.cnt, 0) > 8 + c.c_nationkey % 10
""")
def capacity_violations(spark, folder):
    parents = load(spark, folder, "customer").withColumn("room", F.expr("8 + c_nationkey % 10"))
    found = violations(parents, "c_custkey", "room", load(spark, folder, "orders"), "o_custkey")
    return found.withColumnRenamed("current", "enrolled")


@query("""
select l_orderkey, l_linenumber, n from (select l_orderkey, l_linenumber,
 count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) t where n > 1
""")
def pk_duplicates(spark, folder):
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return relate.duplicate_rows(rows, ["l_orderkey", "l_linenumber"])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over
 (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc) as rn
 from lineitem) t where rn = 1
""")
def upsert_keep_last(spark, folder):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    kept = keep_last(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""
select 'orders' as table_name, 'customer_id' as field, count(*) as total_records,
 count(*) - count(k) as null_count, 100.0::double * (count(*) - count(k)) / count(*) as null_percentage
from (select case when o_orderpriority <> '4-NOT SPECIFIED' then o_custkey end as k from orders) t
union all select 'orders', 'order_id', count(*), count(*) - count(o_orderkey),
 100.0::double * (count(*) - count(o_orderkey)) / count(*) from orders
""")
def null_rate(spark, folder):
    orders = registry(spark, folder, "orders")["orders"]
    specified = orders.withColumn("customer_id", F.when(F.col("priority") != "4-NOT SPECIFIED", F.col("customer_id")))
    return null_rates(specified, "orders", ["order_id", "customer_id"])


@query("""
select c.c_custkey, coalesce(n.cnt, 0) as current_enrollment from customer c left join
 (select o_custkey, count(*) as cnt from orders where o_orderstatus = 'F' group by o_custkey) n on c.c_custkey = n.o_custkey
""")
def child_count_recount(spark, folder):
    finished = load(spark, folder, "orders").where("o_orderstatus = 'F'")
    parents = load(spark, folder, "customer").select("c_custkey")
    return relate.with_child_count(parents, "c_custkey", finished, "o_custkey", "current_enrollment")


@query("select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 15")
def entity_limit(spark, folder):
    return relate.child_counts(load(spark, folder, "orders"), "o_custkey").where("n > 15")


_LINEITEM_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


@query(" union all ".join(f"""
select 'lineitem' as table_name, '{c}' as field, count(distinct {c}) as unique_values, count({c}) as total_values,
 count(distinct {c})::double / count({c}) as unique_ratio from lineitem
 having count(distinct {c}) > 1 and count(distinct {c})::double / count({c}) < 0.1 and count({c}) > 20
""" for c in _LINEITEM_NUMBERS))
def low_variation(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    return low(lineitem, numeric_columns(lineitem), "lineitem")


@query(" union all ".join(f"""
select '{c}' as field, v::double as value, n from (select {c} as v, n, row_number() over (order by n desc, {c}) as rn
 from (select {c}, count(*) as n from lineitem where {c} is not null group by {c}) t) u where rn <= 3
""" for c in _LINEITEM_NUMBERS))
def top_values(spark, folder):
    lineitem = load(spark, folder, "lineitem")
    top = most_frequent(lineitem, numeric_columns(lineitem))
    return top.select("field", F.coalesce(F.col("long_value").cast("double"), "double_value").alias("value"), "n")


@query("""
select 'orders' as table_name, 'currency_rate' as field, cast(min(v) as varchar) as constant_value, count(*) as total_values
from (select sign(o_totalprice)::int as v from orders) t having count(distinct v) = 1
""")
def constant_columns(spark, folder):
    orders = load(spark, folder, "orders").withColumn("currency_rate", F.signum("o_totalprice").cast("int"))
    return constants(orders, numeric_columns(orders), "orders")


@query("""
select c_custkey, c_nationkey, c_acctbal from customer
where (c_acctbal < 0 and c_nationkey > 12) or (c_acctbal > 9000 and c_nationkey < 12)
""")
def cross_field_rule(spark, folder):
    rule = "(c_acctbal < 0 and c_nationkey > 12) or (c_acctbal > 9000 and c_nationkey < 12)"
    return load(spark, folder, "customer").where(rule).select("c_custkey", "c_nationkey", "c_acctbal")


@query("""
select count(*) as classes, sum(cap)::bigint as total_capacity, sum(n)::bigint as total_enrollments,
 round(sum(n) * 1.0 / greatest(sum(cap), 1), 6)::double as capacity_utilization, count(*) as students,
 round(sum(n) * 1.0 / greatest(count(*), 1), 6)::double as avg_enrollments_per_student
from (select 20 + c_nationkey % 16 as cap, (select count(*) from orders where o_custkey = c_custkey) as n from customer) t
""")
def capacity_stats(spark, folder):
    parents = load(spark, folder, "customer")
    stats = allocate.capacity_stats(
        parents, "c_custkey", F.expr("20 + c_nationkey % 16"), load(spark, folder, "orders"), "o_custkey", parents
    )
    return stats.withColumn("capacity_utilization", F.round("capacity_utilization", 6)).withColumn(
        "avg_enrollments_per_student", F.round("avg_enrollments_per_student", 6)
    )


@query("""
select c.c_custkey from customer c left join (select o_custkey, count(*) as cnt from orders group by o_custkey) n
 on c.c_custkey = n.o_custkey where coalesce(n.cnt, 0) < (8 + c.c_nationkey % 10) * 0.8
""")
def available_parents(spark, folder):
    parents = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    free = allocate.available_parents(
        parents, "c_custkey", F.expr("8 + c_nationkey % 10"), load(spark, folder, "orders"), "o_custkey"
    )
    return free.select("c_custkey")


@query("""
select o_orderkey, o_custkey from (select o_orderkey, o_custkey, row_number() over
 (partition by o_custkey order by o_orderkey) as rn from orders) t where rn - 1 < (8 + o_custkey % 10) * 0.8
""")
def admit_single_limit(spark, folder):
    requests = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return allocate.admit_single_limit(requests, "o_custkey", F.expr("(8 + o_custkey % 10) * 0.8"), ["o_orderkey"])


@query("""
with requests as (
  select o_orderkey as q, o_custkey as s, o_orderdate::date as c, (5 + day(o_orderdate::date) % 4) * 0.8 as room
  from orders where o_custkey in (select c_custkey from customer)),
 folded as (select list_reduce(list([{'q': q, 's': s, 'c': c, 'room': room}] order by q), lambda acc, x:
  case when len(list_filter(acc, lambda a: a.c = x[1].c)) < x[1].room and len(list_filter(acc, lambda a: a.s = x[1].s)) < 5
  then list_append(acc, x[1]) else acc end, []) as admitted from requests)
select e.q as o_orderkey, e.s as o_custkey, cast(e.c as varchar) as day from (select unnest(admitted) as e from folded) t
""")
def admit_two_limits(spark, folder):
    """The SQL goes through the requests one by one."""
    orders = load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    days = orders.select("day").distinct().withColumn("room", F.expr("5 + day(day) % 4"))
    return allocate.admit_two_limits(
        orders, "o_orderkey", "o_custkey", "day", load(spark, folder, "customer"), "c_custkey", 5,
        days, "day", "room", utilization=0.8,
    ).withColumn("day", F.col("day").cast("string"))


@query("""
select l_orderkey, l_linenumber, l_partkey from lineitem l where exists (select 1 from orders o
 where o.o_orderkey = l.l_orderkey and exists (select 1 from customer c
 where c.c_custkey = o.o_custkey and c.c_mktsegment <> 'BUILDING'))
""")
def dependency_filter(spark, folder):
    tables = {
        "customer": _other_customers(spark, folder), "orders": load(spark, folder, "orders"),
        "lineitem": load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
    }
    links = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]
    return relate.dependency_filter(tables, links)["lineitem"]


@query("""
select o.o_orderkey, c.c_name, n.n_name, l.l_linenumber from lineitem l join orders o on l.l_orderkey = o.o_orderkey
 join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey where l.l_returnflag = 'R'
""")
def star_join(spark, folder):
    returned = load(spark, folder, "lineitem").where("l_returnflag = 'R'")
    dimensions = [
        (load(spark, folder, "orders"), "l_orderkey", "o_orderkey"),
        (load(spark, folder, "customer"), "o_custkey", "c_custkey"),
        (load(spark, folder, "nation"), "c_nationkey", "n_nationkey"),
    ]
    return relate.star_join(returned, dimensions).select("o_orderkey", "c_name", "n_name", "l_linenumber")


@query("""
select concat('S', cast(1000 + row_number() over (order by c_custkey) - 1 as varchar)) as student_id, c_custkey from customer
""")
def surrogate_ids(spark, folder):
    return sequential_ids(load(spark, folder, "customer").select("c_custkey"), ["c_custkey"], "student_id", "S", 1000)


@query("""
select round(avg(d), 3)::double as avg_s, round(min(d), 3)::double as min_s, round(max(d), 3)::double as max_s from
 (select (us - lag(us) over (order by us)) / 1000000.0 as d from (select epoch_us(ts) as us from events) e) t
""")
def interarrival(spark, folder):
    gaps = gap_statistics(load(spark, folder, "events"), "ts")
    return gaps.select(*[F.round(c, 3).alias(c) for c in gaps.columns])


@query("""
select e.event_id, e.user_id from events e left join
 (select user_id, min(event_id) as first_pos from events where event_type = 'signup' group by user_id) p
 on e.user_id = p.user_id where e.event_type = 'purchase' and (p.first_pos is null or p.first_pos > e.event_id)
""")
def arrival_orphans(spark, folder):
    events = load(spark, folder, "events").select("event_id", "user_id", "event_type")
    signups, purchases = events.where("event_type = 'signup'"), events.where("event_type = 'purchase'")
    early = relate.unseen_parents(purchases, "user_id", signups, "user_id", ["event_id"])
    return early.select("event_id", "user_id")


@query("""
select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by event_id) as rn
 from events where event_type = 'signup') t where rn > 1
""")
def duplicate_ids(spark, folder):
    signups = load(spark, folder, "events").where("event_type = 'signup'").select("user_id", "event_id")
    return relate.repeated_occurrences(signups, "user_id", ["event_id"])


@query("""
select r.user_id, count(e.event_id) as since_reset from
 (select user_id, max(event_id) as pos from events where event_type = 'signup' group by user_id) r
 left join events e on e.user_id = r.user_id and e.event_type = 'purchase' and e.event_id > r.pos group by r.user_id
""")
def reset_count(spark, folder):
    events = load(spark, folder, "events").select("event_id", "user_id", "event_type")
    signups, purchases = events.where("event_type = 'signup'"), events.where("event_type = 'purchase'")
    return relate.count_since_reset(signups, "user_id", purchases, "user_id", ["event_id"])


@query("""
select user_id, event_id, value from (select user_id, event_id, value,
 row_number() over (partition by user_id order by event_id desc) as rn from events where event_type = 'signup') t where rn = 1
""")
def last_declaration(spark, folder):
    signups = load(spark, folder, "events").where("event_type = 'signup'").select("user_id", "event_id", "value")
    return relate.last_declaration(signups, "user_id", ["event_id"])


@query("""
select total, errors, warnings, round(100.0 - (case when 2 * errors + 0.5 * warnings < 2 * total then 2 * errors + 0.5 * warnings
 else 2 * total end) / (2 * total) * 100, 4)::double as score from (select count(*) as total,
 sum(case when n > 15 then 1 else 0 end)::bigint as errors,
 sum(case when n between 13 and 15 then 1 else 0 end)::bigint as warnings from
 (select o_custkey, count(*) as n from orders group by o_custkey) a) b
""")
def quality_score(spark, folder):
    counts = relate.child_counts(load(spark, folder, "orders"), "o_custkey")
    severity = F.when(F.col("n") > 15, "ERROR").when(F.col("n") >= 13, "WARNING").otherwise("INFO")
    checks = counts.select(severity.alias("severity"), (F.col("n") < 13).alias("passed"))
    return count_checks(checks).select("total", "errors", "warnings", F.round("score", 4).alias("score"))
