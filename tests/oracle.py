"""Runs registered queries beside their SQL twins: python tests/oracle.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            if math.isnan(v):
                return "nan"
            return repr(v + 0.0)
        if isinstance(v, bool) or v is None:
            return repr(v)
        if isinstance(v, int):
            return repr(v)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, queries, oracle, folder):
    started = time.time()
    df = queries[name](spark, folder)
    rows = df.collect()
    took = time.time() - started
    if name not in oracle:
        return "rows-only", len(rows), took, ""
    res = con.execute(oracle[name])
    columns = [d[0] for d in res.description]
    wanted = res.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", len(rows), took, f"{sorted(df.columns)} / {sorted(columns)}"
    kinds = {c: str(t) for c, t in zip(columns, [d[1] for d in res.description])}
    mine, theirs = canonical(df.columns, rows), canonical(columns, wanted)
    if mine == theirs:
        odd = [f"{f.name}:{f.dataType.simpleString()}/{kinds[f.name]}" for f in df.schema
               if (f.dataType.simpleString(), kinds[f.name]) not in SAME]
        return ("ok" if rows else "EMPTY"), len(rows), took, " ".join(odd)
    have_a, have_b = set(mine), set(theirs)
    only_a = [r for r in mine if r not in have_b][:2]
    only_b = [r for r in theirs if r not in have_a][:2]
    return "DIFF", len(rows), took, f"spark {len(mine)} sql {len(theirs)}\n   cols {sorted(columns)}\n   spark {only_a}\n   sql   {only_b}"


SAME = {
    ("string", "VARCHAR"), ("double", "DOUBLE"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("date", "DATE"),
    ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP"), ("bigint", "INTEGER"), ("int", "BIGINT"), ("timestamp", "TIMESTAMP"),
}


if __name__ == "__main__":
    from riskweave.catalog import load
    from riskweave.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    queries, oracle = load()
    spark = build_session("oracle", "local[8]", 8)
    con = connect(folder)
    names = [n for n in queries if not args or any(a in n for a in args)]
    bad = 0
    for n in names:
        try:
            state, count, took, note = compare(spark, con, n, queries, oracle, folder)
        except Exception as e:  # noqa: BLE001
            state, count, took, note = "ERROR", 0, 0.0, str(e)[:1500]
        bad += state in ("ERROR", "DIFF", "COLUMNS", "EMPTY")
        print(f"{state:10s} {n:42s} rows={count:<7d} {took:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
