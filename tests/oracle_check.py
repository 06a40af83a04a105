"""Run each registered query on Spark and its SQL oracle on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query: row counts, column-name match, exact value match,
and whether values agree within 1e-9 (relative) when they are not exact.
"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from cargoline.plans.oracle import oracle_sql  # noqa: E402
from cargoline.plans.registry import queries  # noqa: E402

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except Exception:
            pass
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return [columns[i] for i in order], out


def _close(a, b):
    if a == b:
        return True
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return False


def compare(spark, sf_dir, con, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_recs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_recs = rel.fetchall()
    t2 = time.time()
    s_cols, s_rows = _rows(list(s_types), s_recs)
    d_cols_sorted, d_rows = _rows(d_cols, d_recs)
    type_diff = []
    for c in s_types:
        st, dtp = s_types[c], d_types.get(c)
        exp = SPARK_TO_DUCK.get(st, st.upper())
        if dtp is not None and exp != dtp:
            type_diff.append(f"{c}:{st}/{dtp}")
    exact = s_rows == d_rows
    close = exact or (len(s_rows) == len(d_rows) and all(
        len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b)) for a, b in zip(s_rows, d_rows)))
    status = "OK" if exact and s_cols == d_cols_sorted else ("CLOSE" if close and s_cols == d_cols_sorted else "DIFF")
    if status == "OK" and type_diff:
        status = "TYPES"
    print(f"{status:5} {name}: rows {len(s_rows)}/{len(d_rows)} cols {'=' if s_cols == d_cols_sorted else 'DIFF'} "
          f"spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s" + (f" types {type_diff}" if type_diff else ""), flush=True)
    if s_cols != d_cols_sorted:
        print("   spark:", s_cols, "\n   duck: ", d_cols_sorted)
    elif not close:
        shown = 0
        for a, b in zip(s_rows, d_rows):
            if a != b:
                print("   spark:", a, "\n   duck: ", b)
                shown += 1
                if shown >= 2:
                    break
    return status


def main(argv):
    sf_dir = argv[0] if argv and os.path.isdir(argv[0]) else "/root/testdata/sf0.01"
    names = [a for a in argv if not os.path.isdir(a)]
    from cargoline.session import local_session

    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    results = {}
    for name in names or list(qs):
        if name not in sqls:
            print(f"SKIP  {name}: no oracle")
            continue
        try:
            results[name] = compare(spark, sf_dir, con, name, qs[name], sqls[name])
        except Exception as e:  # report and go on
            results[name] = "ERROR"
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:800]}", flush=True)
    bad = {k: v for k, v in results.items() if v not in ("OK",)}
    print(f"{len(results) - len(bad)}/{len(results)} exact; not exact: {bad}")
    return 0 if not bad else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
