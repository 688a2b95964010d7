"""Run registered Spark queries and their DuckDB SQL side by side.

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows, column names, order-insensitive value match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def fingerprint(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import tempfile
    from tablework.session import build_session
    import __spark_entry__ as E
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("local[8]", 8, extra={"spark.sql.warehouse.dir": scratch + "/warehouse"},
                          checkpoint_if_unset=scratch + "/ckpt")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} rows={len(srows):7d} (no oracle) {ts:6.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        sc, sh, sl = fingerprint(scols, srows)
        dc, dh, dl = fingerprint(dcols, drows)
        ok = len(srows) == len(drows) and sc == dc and sh == dh
        bad += not ok
        msg = "OK" if ok else "MISMATCH"
        print(f"{name:24s} rows={len(srows):7d}/{len(drows):7d} cols={'=' if sc == dc else (sc, dc)} "
              f"{msg} {ts:6.1f}s")
        if not ok and sc == dc:
            a, b = set(sl), set(dl)
            print("   spark-only:", sorted(a - b)[:3])
            print("   duck-only: ", sorted(b - a)[:3])
    print("BAD", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
