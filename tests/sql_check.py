"""Runs registered queries against their SQL check in DuckDB and compares the results.

    python tests/sql_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "tolist"):
        return plain(value.tolist()) if not isinstance(value.tolist(), list) else [plain(v) for v in value.tolist()]
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


def kind(rows, i):
    found = {("int" if isinstance(r[i], int) and not isinstance(r[i], bool) else type(r[i]).__name__) for r in rows if r[i] is not None}
    return "/".join(sorted(found))


def compare(spark_columns, spark_rows, sql_columns, sql_rows) -> str | None:
    a_cols, a = rows_of(spark_columns, spark_rows)
    b_cols, b = rows_of(sql_columns, sql_rows)
    if a_cols != b_cols:
        return f"columns differ: only spark {sorted(set(a_cols) - set(b_cols))[:8]}, only sql {sorted(set(b_cols) - set(a_cols))[:8]}"
    if len(a) != len(b):
        return f"row counts differ: {len(a)} / {len(b)}"
    for i, c in enumerate(a_cols):
        if kind(a, i) != kind(b, i):
            return f"types of {c} differ: {kind(a, i)} / {kind(b, i)}"
    for x, y in zip(a, b):
        if x != y:
            where = [(c, p, q) for c, p, q in zip(a_cols, x, y) if p != q]
            return f"{sum(p != q for p, q in zip(a, b))} of {len(a)} rows differ, first: {where[:4]}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from riskloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), connect(args.sf)
    runs, checks = contract.queries(), contract.oracle_sql()
    names = [n for n in runs if not args.names or any(n.startswith(p) for p in args.names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = runs[name](spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in checks:
                print(f"rows  {name}: {len(rows)} rows, {took:.1f}s")
                continue
            cursor = con.execute(checks[name])
            problem = compare(df.columns, rows, [d[0] for d in cursor.description], cursor.fetchall())
        except Exception as error:  # one failing query must not hide the others
            problem, took, rows = f"{type(error).__name__}: {str(error)[:600]}", time.time() - start, []
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok   '} {name}: {problem or str(len(rows)) + ' rows'}, {took:.1f}s", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
