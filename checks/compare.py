"""Run registered queries on Spark and their SQL on DuckDB and compare values.

Usage: ``python -m checks.compare <sf_dir> [query ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from daypanel.core import get_session

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def kinds(columns, types, engine: str) -> dict[str, str]:
    short = {"bigint": "int", "int": "int", "double": "float", "string": "text", "boolean": "bool", "date": "date"}
    duck = {"BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "float", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date"}
    table = short if engine == "spark" else duck
    return {c: table.get(str(t), str(t)) for c, t in zip(columns, types)}


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    rel = con.sql(sql)
    want_cols, want = rows_of(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    a, b = kinds(df.columns, [t for _, t in df.dtypes], "spark"), kinds(rel.columns, rel.types, "duck")
    if a != b:
        return f"types {[(c, a[c], b[c]) for c in a if a[c] != b[c]]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(x, y) for x, y in zip(got, want) if x != y]
    if bad:
        x, y = bad[0]
        return f"{len(bad)} of {len(got)} rows differ, first: {[(c, u, v) for c, u, v in zip(got_cols, x, y) if u != v]} at {x[:4]}"
    return None


def main() -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_session("compare", "local[8]")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        state = "ok" if problem is None else "DIFF"
        print(f"{state:5s}{name} {'' if name in ORACLE else '(rows only) '}{time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
