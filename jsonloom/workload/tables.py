"""The given tables, under their own names and as a registry with ``*_id`` keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonloom.session import scratch_path
from jsonloom.sources.export import documents, write_files, write_lines

# registry table -> (given table, {given column: registry column})
REGISTRY = {
    "regions": ("region", {"r_regionkey": "region_id", "r_name": "name"}),
    "nations": ("nation", {"n_nationkey": "nation_id", "n_name": "name", "n_regionkey": "region_id"}),
    "customers": (
        "customer",
        {"c_custkey": "customer_id", "c_name": "name", "c_nationkey": "nation_id", "c_acctbal": "balance", "c_mktsegment": "segment"},
    ),
    "suppliers": (
        "supplier", {"s_suppkey": "supplier_id", "s_name": "name", "s_nationkey": "nation_id", "s_acctbal": "balance"},
    ),
    "orders": (
        "orders",
        {
            "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
            "o_totalprice": "total_price", "o_orderdate": "order_date", "o_orderpriority": "priority",
        },
    ),
    "lineitems": (
        "lineitem",
        {
            "l_orderkey": "order_id", "l_partkey": "part_id", "l_suppkey": "supplier_id", "l_linenumber": "line_number",
            "l_quantity": "quantity", "l_extendedprice": "extended_price", "l_discount": "discount", "l_tax": "tax",
        },
    ),
}

ROWS_PER_DOCUMENT = 500


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def registry(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    out = {}
    for name in names or REGISTRY:
        given, columns = REGISTRY[name]
        out[name] = load(spark, folder, given).select(*[F.col(g).alias(r) for g, r in columns.items()])
    return out


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Batch rows by ranges of a unique key: a document gets at most ROWS_PER_DOCUMENT rows of a table."""
    return df.withColumn("batch", F.floor(F.col(key) / ROWS_PER_DOCUMENT).cast("bigint"))


_exports: dict[tuple[str, str, str], str] = {}


def exported(spark: SparkSession, folder: str, label: str, build, files: bool = False) -> str:
    """Folder of the documents ``build()`` makes, written once per application, folder and label."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _exports:
        path = scratch_path(spark, f"export-{label}")
        (write_files if files else write_lines)(build(), path)
        _exports[key] = path
    return _exports[key]


def registry_documents(spark: SparkSession, folder: str) -> str:
    """The registry (without line items) as enveloped documents, one per line."""

    def build():
        tables = registry(spark, folder, "regions", "nations", "customers", "suppliers", "orders")
        keys = {"regions": "region_id", "nations": "nation_id", "customers": "customer_id", "suppliers": "supplier_id", "orders": "order_id"}
        orders = tables["orders"].withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
        tables["orders"] = orders
        return documents({t: numbered(df, keys[t]) for t, df in tables.items()}, "batch")

    return exported(spark, folder, "registry", build)


def customer_files(spark: SparkSession, folder: str) -> str:
    """Customers as one bare document per file."""

    def build():
        rows = numbered(load(spark, folder, "customer"), "c_custkey")
        return documents({"customer": rows}, "batch", envelope=False, order=["c_custkey"])

    return exported(spark, folder, "customer", build, files=True)
