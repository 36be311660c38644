"""Run every registered query in Spark and its oracle in DuckDB; compare like the driver.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from segmint.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if key not in sqls:
            print(f"{key:22s} spark_rows={len(srows)} (no oracle) {t1 - t0:.1f}s")
            continue
        res = con.sql(sqls[key])
        ocols = res.columns
        orows = res.fetchall()
        same_cols = sorted(scols) == sorted(ocols)
        ok = same_cols and len(srows) == len(orows) and digest(scols, srows) == digest(ocols, orows)
        bad += not ok
        print(f"{key:22s} {'OK ' if ok else 'BAD'} rows spark={len(srows)} oracle={len(orows)} "
              f"cols={'same' if same_cols else (sorted(set(scols) ^ set(ocols)))} {t1 - t0:.1f}s")
        if not ok and same_cols and srows and orows:
            so = sorted(range(len(scols)), key=lambda i: scols[i])
            oo = sorted(range(len(ocols)), key=lambda i: ocols[i])
            sset = {tuple(norm(r[i]) for i in so) for r in srows}
            oset = {tuple(norm(r[i]) for i in oo) for r in orows}
            names = [scols[i] for i in so]
            for label, diff in (("spark-only", sset - oset), ("oracle-only", oset - sset)):
                for row in sorted(diff, key=repr)[:3]:
                    print("   ", label, dict(zip(names, row)))
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
