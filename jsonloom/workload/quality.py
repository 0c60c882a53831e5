"""The check suite over a registry with known faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from jsonloom.operators.metrics import table_stats as stats_of
from jsonloom.operators.metrics import table_totals as totals_of
from jsonloom.operators.metrics import run_report as scored_runs
from jsonloom.operators.quality.affected import affected_rows as all_affected
from jsonloom.operators.quality.capacity import CapacityRule, EntityLimit
from jsonloom.operators.quality.consistency import FieldRule, table_checks
from jsonloom.operators.quality.integrity import Reference
from jsonloom.operators.quality.rows import union_checks
from jsonloom.operators.quality.suite import Rules, count_checks, run_checks
from jsonloom.plans.validate import validate
from jsonloom.sources.reports import report_rows
from jsonloom.workload.registry import query
from jsonloom.workload.tables import load, registry

RULES = Rules(
    references=[Reference("orders", "customer_id", "customers"), Reference("lineitems", "order_id", "orders")],
    primary_keys={"customers": "customer_id", "orders": "order_id", "lineitems": "order_id"},
    capacities=[
        CapacityRule("customers", "customer_id", "max_orders", "orders", "customer_id", "Customer Capacity", "customers")
    ],
    limits=[EntityLimit("orders", "customer_id", 8, "Order Limits", "customers")],
    field_rules=[
        FieldRule(
            "customers", ("balance", "nation_id"),
            "(balance < 0 and nation_id > 12) or (balance > 9000 and nation_id < 12)",
            "Balance Consistency", "customers with inconsistent balance", "Balances are consistent",
        )
    ],
)


def faulty_registry(spark, folder):
    """Customers of one segment are missing and orders without a stated priority have lost their customer."""
    tables = registry(spark, folder, "customers", "orders", "lineitems")
    tables["customers"] = tables["customers"].where("segment <> 'BUILDING'").withColumn(
        "max_orders", F.expr("8 + nation_id % 10")
    )
    tables["orders"] = tables["orders"].withColumn(
        "customer_id", F.when(F.col("priority") != "4-NOT SPECIFIED", F.col("customer_id"))
    )
    return tables


_TABLES_SQL = """
with customers as (select c_custkey as customer_id, c_nationkey as nation_id, c_acctbal as balance, 8 + c_nationkey % 10 as max_orders
  from customer where c_mktsegment <> 'BUILDING'),
 orders_ as (select o_orderkey as order_id, case when o_orderpriority <> '4-NOT SPECIFIED' then o_custkey end as customer_id,
  o_totalprice as total_price from orders),
 lineitems as (select l_orderkey as order_id, l_partkey as part_id, l_suppkey as supplier_id, l_linenumber as line_number,
  l_quantity as quantity, l_extendedprice as extended_price, l_discount as discount, l_tax as tax from lineitem),
 found as (
  select 'Referential Integrity: orders.customer_id → customers.customer_id' as check_name, 'ERROR' as bad, count(*) as n, true as always
   from orders_ where customer_id is not null and customer_id not in (select customer_id from customers)
  union all select 'Referential Integrity: lineitems.order_id → orders.order_id', 'ERROR', count(*), true
   from lineitems where order_id not in (select order_id from orders_)
  union all select 'Customer Capacity', 'ERROR', count(*), true from customers c
   where (select count(*) from orders_ o where o.customer_id = c.customer_id) > c.max_orders
  union all select 'Primary Key Uniqueness: customers.customer_id', 'ERROR', coalesce(sum(n), 0)::bigint, true
   from (select count(*) as n from customers group by customer_id having count(*) > 1) t
  union all select 'Primary Key Uniqueness: orders.order_id', 'ERROR', coalesce(sum(n), 0)::bigint, true
   from (select count(*) as n from orders_ group by order_id having count(*) > 1) t
  union all select 'Primary Key Uniqueness: lineitems.order_id', 'ERROR', coalesce(sum(n), 0)::bigint, true
   from (select count(*) as n from lineitems group by order_id having count(*) > 1) t
  union all select 'Order Limits', 'WARNING', count(*), true from
   (select customer_id from orders_ where customer_id is not null group by customer_id having count(*) > 8) t
  union all select 'Balance Consistency', 'WARNING', count(*), true from customers
   where (balance < 0 and nation_id > 12) or (balance > 9000 and nation_id < 12)
"""
_ID_COLUMNS = {
    "customers": ("customers", ("customer_id", "nation_id")),
    "orders": ("orders_", ("order_id", "customer_id")),
    "lineitems": ("lineitems", ("order_id", "part_id", "supplier_id")),
}
_NUMBERS = {
    "customers": ("customers", ("balance", "max_orders")),
    "orders": ("orders_", ("total_price",)),
    "lineitems": ("lineitems", ("line_number", "quantity", "extended_price", "discount", "tax")),
}
_NULLS_SQL = "".join(
    f"""
  union all select 'Null Values in Critical Field: {table}.{column}',
   case when 100.0 * (count(*) - count({column})) / count(*) < 20 then 'WARNING' else 'ERROR' end, count(*) - count({column}), false
   from {view} having 100.0 * (count(*) - count({column})) / count(*) > 5"""
    for table, (view, columns) in _ID_COLUMNS.items()
    for column in columns
)
_VARIATION_SQL = "".join(
    f"""
  union all select 'Data Variation: {table}.{column}' || case when count(distinct {column}) = 1 then '' else ' (low variation)' end,
   'WARNING', 0, false from {view} having count(distinct {column}) = 1
    or (count(distinct {column})::double / count({column}) < 0.1 and count({column}) > 20)"""
    for table, (view, columns) in _NUMBERS.items()
    for column in columns
)
_CHECKS_SQL = _TABLES_SQL + _NULLS_SQL + _VARIATION_SQL + """),
 checks as (select check_name, n = 0 and always as passed,
  case when n = 0 and always then 'INFO' else bad end as severity, n as affected_count from found)
"""


@query(_CHECKS_SQL + "select check_name, passed, severity, affected_count from checks")
def quality_checks(spark, folder):
    checks = run_checks(spark, faulty_registry(spark, folder), RULES)
    return checks.select("check_name", "passed", "severity", "affected_count")


@query(_CHECKS_SQL + """
select total_checks, passed_checks, total_checks - passed_checks as failed_checks, errors, warnings, errors as critical_issues,
 case when errors = 0 then 'PASS' else 'FAIL' end as overall_status, 3 as tables_validated, 2 as relationships_validated,
 (select count(*) from customers) + (select count(*) from orders_) + (select count(*) from lineitems) as total_records,
 round(100.0 - least(2 * errors + 0.5 * warnings, 2 * total_checks) / (2 * total_checks) * 100, 4)::double as quality_score,
 case when 100.0 - least(2 * errors + 0.5 * warnings, 2 * total_checks) / (2 * total_checks) * 100 > 90 then 'Excellent'
  when 100.0 - least(2 * errors + 0.5 * warnings, 2 * total_checks) / (2 * total_checks) * 100 > 70 then 'Good' else 'Poor' end as recommendation
from (select count(*) as total_checks, count(*) filter (where passed) as passed_checks,
 count(*) filter (where severity = 'ERROR') as errors, count(*) filter (where severity = 'WARNING') as warnings from checks) t
""")
def quality_summary(spark, folder):
    summary = validate(spark, faulty_registry(spark, folder), RULES).summary
    return summary.withColumn("quality_score", F.round("quality_score", 4))


@query(_CHECKS_SQL + """
select severity, count(*) as checks, sum(affected_count)::bigint as affected from checks group by severity
""")
def quality_report(spark, folder):
    rows = report_rows(run_checks(spark, faulty_registry(spark, folder), RULES))
    return rows.groupBy("severity").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("affected_records_count").alias("affected")
    )


@query("""
select 'Table Population: ' || t as check_name, 'WARNING' as severity from
 (select 'open_orders' as t, count(*) as n from orders where o_orderstatus = 'no such status'
  union all select 'orders', count(*) from orders union all select 'nation', count(*) from nation) u where n = 0
""")
def empty_tables(spark, folder):
    orders = load(spark, folder, "orders")
    tables = {
        "open_orders": orders.where("o_orderstatus = 'no such status'"), "orders": orders,
        "nation": load(spark, folder, "nation"),
    }
    checks = union_checks(spark, [table_checks(t, df) for t, df in tables.items()])
    return checks.select("check_name", "severity")


_STATS_TABLES = ("orders", "customer", "lineitem", "events", "documents")


@query("""
select 'orders' as table_name, count(*) as record_count, 6 as column_count from orders
union all select 'customer', count(*), 5 from customer union all select 'lineitem', count(*), 11 from lineitem
union all select 'events', count(*), 6 from events union all select 'documents', count(*), 5 from documents
""")
def table_stats(spark, folder):
    return stats_of({t: load(spark, folder, t) for t in _STATS_TABLES})


@query("""
select 5 as tables, (select count(*) from orders) + (select count(*) from customer) + (select count(*) from lineitem)
 + (select count(*) from events) + (select count(*) from documents) as total_records
""")
def table_totals(spark, folder):
    return totals_of(stats_of({t: load(spark, folder, t) for t in _STATS_TABLES}))


@query("""
select c_mktsegment, round(eff, 8)::double as efficiency,
 round(25 + 0.4 * quality + case when errors = 0 then 20 else 0 end + 0.15 * eff, 8)::double as overall_score
from (select *, least(100.0, 0.3 * generated + 0.3 * processed + 0.4 * quality) as eff from
 (select c_mktsegment, count(*) / 100.0 as generated, count(*) / 50.0 as processed,
  100.0 - least(2.0 * count(*) filter (where c_acctbal < 0), 2.0 * count(*)) / (2.0 * count(*)) * 100 as quality,
  count(*) filter (where c_acctbal < 0) as errors from customer group by c_mktsegment) t) u
""")
def run_report(spark, folder):
    customers = load(spark, folder, "customer")
    severity = F.when(F.col("c_acctbal") < 0, "ERROR").otherwise("INFO")
    checks = customers.select("c_mktsegment", severity.alias("severity"), (F.col("c_acctbal") >= 0).alias("passed"))
    runs = count_checks(checks, ["c_mktsegment"]).select(
        "c_mktsegment", (F.col("total") / 100).alias("generation_rate"), (F.col("total") / 50).alias("processing_rate"),
        F.col("score").alias("quality_score"), "errors",
    )
    return scored_runs(runs).select(
        "c_mktsegment", F.round("efficiency", 8).alias("efficiency"), F.round("overall_score", 8).alias("overall_score")
    )


@query(_TABLES_SQL[: _TABLES_SQL.index(",\n found as")] + """
select 'Referential Integrity: orders.customer_id → customers.customer_id' as check_name, customer_id::varchar as key, count(*) as n
 from orders_ where customer_id is not null and customer_id not in (select customer_id from customers) group by 2
union all select 'Customer Capacity', customer_id::varchar, 1 from customers c
 where (select count(*) from orders_ o where o.customer_id = c.customer_id) > c.max_orders
union all select 'Primary Key Uniqueness: lineitems.order_id', order_id::varchar, count(*) from lineitems group by order_id having count(*) > 1
union all select 'Order Limits', customer_id::varchar, 1 from orders_ where customer_id is not null group by customer_id having count(*) > 8
union all select 'Balance Consistency', customer_id::varchar, 1 from customers
 where (balance < 0 and nation_id > 12) or (balance > 9000 and nation_id < 12)
""")
def affected_rows(spark, folder):
    """Every record that a failed check names, counted per check and key."""
    return all_affected(spark, faulty_registry(spark, folder), RULES).groupBy("check_name", "key").agg(F.count("*").alias("n"))
