"""Side-by-side check of registered queries: Spark rows against DuckDB rows.

``python -m tests.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, int, list]:
    """Row counts of both sides and the rows (with their Python types) found on one side only."""
    names = df.columns
    spark_rows = _rows(names, df.collect())
    answer = con.sql(sql)
    duck_rows = _rows(answer.columns, answer.fetchall())
    if sorted(names) != sorted(answer.columns):
        return spark_rows.total(), duck_rows.total(), [("columns", sorted(names), sorted(answer.columns))]
    extra = list((spark_rows - duck_rows).items())[:3]
    lacking = list((duck_rows - spark_rows).items())[:3]
    return spark_rows.total(), duck_rows.total(), [("spark", *x) for x in extra] + [("duckdb", *x) for x in lacking]


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tickflow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, bad = local_session(8), connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        if name not in oracle:
            print(f"rows  {name:28s} {query(spark, sf_dir).count():8d} {time.time() - start:6.2f}s", flush=True)
            continue
        spark_n, duck_n, diff = compare(query(spark, sf_dir), con, oracle[name])
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok':5s} {name:28s} {spark_n:8d} {duck_n:8d} {time.time() - start:6.2f}s", flush=True)
        for line in diff:
            print("      ", line)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
