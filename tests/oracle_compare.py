"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from newsfeat.sources.tables import TABLES  # noqa: E402

STRICT = os.environ.get("ORACLE_STRICT") == "1"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    issues = []
    if sorted(scols) != sorted(dcols):
        issues.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
    elif len(srows) != len(drows):
        issues.append(f"rows spark={len(srows)} duck={len(drows)}")
    else:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            issues.append(f"values differ, e.g. {diff}")
    return issues, len(srows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    from newsfeat.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s, no oracle)")
            continue
        try:
            issues, n, secs = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            issues, n, secs = [f"error {type(e).__name__}: {str(e)[:600]}"], -1, 0
        bad += bool(issues)
        print(f"{'OK   ' if not issues else 'FAIL '} {name}: {n} rows ({secs:.1f}s) {'; '.join(issues)}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
