"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``compare``) and as a script:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duckdb={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        return False, f"values differ, e.g. spark rows {diff}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as ent
    from duetto.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = ent.queries(), ent.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t = time.time()
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:36s} rows-only {n} rows  {time.time() - t:.1f}s", flush=True)
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as exc:  # report and go on
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{name:36s} {'OK ' if ok else 'BAD'} {msg}  {time.time() - t:.1f}s", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
