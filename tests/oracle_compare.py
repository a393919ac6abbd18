"""Run Spark queries and their DuckDB oracle side by side and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


# Spark simple type name -> DuckDB type name, for the schema check.
_TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "float": "FLOAT",
    "date": "DATE",
}


def compare(spark, con, key, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = _rows(s_cols, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = _rows(d_cols, rel.fetchall())
    t2 = time.time()
    problems = []
    s_types = {f.name: _TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    type_diff = {c: (s_types[c], d_types.get(c)) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if type_diff:
        problems.append(f"types {type_diff}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} oracle={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} oracle={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from starmart.session import local_session

    spark = local_session(8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in sqls:
            print(f"{key:22s} (no oracle)")
            continue
        problems, n, ts, td = compare(spark, con, key, qs[key], sqls[key], sf_dir)
        bad += bool(problems)
        print(f"{key:22s} {'OK ' if not problems else 'BAD'} rows={n:6d} spark={ts:6.2f}s duck={td:5.2f}s {'; '.join(problems)}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
