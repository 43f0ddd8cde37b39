"""Run queries() against oracle_sql() on DuckDB, like the driver's correctness gate.

    python tests/oracle_check.py [sf_dir] [name ...]

For every name: row count, column names and an order-insensitive hash of the
values must agree. Prints one line per query and exits non-zero on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

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
        return repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r[c] for c in cols) for r in df.collect()]
    return cols, rows


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tessera.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            cols, rows = spark_rows(qs[name](spark, sf_dir))
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        print(f"{'OK  ' if ok else 'FAIL'} {name}: rows {len(rows)}/{len(drows)} cols {sorted(cols) == sorted(dcols)} {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(dcols):
                print("   spark cols", cols, "duck cols", dcols)
            diff1 = sorted(set(l1) - set(l2))[:3]
            diff2 = sorted(set(l2) - set(l1))[:3]
            print("   spark only:", diff1)
            print("   duck only: ", diff2)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
