"""Run queries against their oracle SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        return f"rows {len(got[1])} against {len(want[1])}; only here {extra}; only there {missing}"
    return None


def main() -> None:
    from jsonloom.session import local_session
    from jsonloom.workload import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(cores="8"), connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
                status = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                status = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            status = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += status.startswith(("DIFFERS", "FAILED"))
        print(f"{name:28s} {time.time() - start:6.2f}s  {status}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
