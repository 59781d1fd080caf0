"""Run catalogue queries on Spark and their DuckDB oracle; compare
row count, column names/types and an order-insensitive hash of values.

CLI: ``python tests/oracle_compare.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


_SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "boolean": "BOOLEAN",
}


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    type_ok = all(
        _SPARK_TO_DUCK.get(s_types.get(c), s_types.get(c)) == d_types.get(c) for c in d_cols
    )
    res = {
        "query": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": type_ok,
        "hash_match": sorted(s_cols) == sorted(d_cols)
        and digest(s_cols, s_rows) == digest(d_cols, d_rows),
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
    }
    if not type_ok:
        res["types"] = {c: (s_types.get(c), d_types.get(c)) for c in d_cols}
    if not res["columns_match"]:
        res["cols"] = (s_cols, d_cols)
    return res


def main(argv: list[str]) -> int:
    from millrun.session import build_session
    import __spark_entry__ as se

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n in se.queries() if n in se.oracle_sql()]
    spark = build_session()
    qs, sqls = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls[n], con)
        except Exception as e:  # report and continue
            r = {"query": n, "error": repr(e)[:2000]}
        ok = r.get("hash_match") and r.get("types_match") and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + json.dumps(r), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
