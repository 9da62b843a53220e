"""Differential check: every ``queries()`` entry against its ``oracle_sql()``.

Runs both sides on one scale factor and compares row counts, column names
and an order-insensitive multiset of rows (floats rounded to 9 significant
digits, everything else as text). Prints one line per query and a summary.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v) if not isinstance(v, (int, str)) else v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    from cargofeed.session import build_session
    import __spark_entry__ as E

    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    failures = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            failures += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"NOSQL {name}: {len(s_rows)} rows ({t1 - t0:.1f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            failures += 1
            continue
        t2 = time.time()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        sk, dk = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
        ok = ok_cols and sk == dk
        status = "OK  " if ok else "FAIL"
        print(f"{status} {name}: spark {len(s_rows)} rows {t1 - t0:.1f}s, duckdb {len(d_rows)} rows "
              f"{t2 - t1:.1f}s" + ("" if ok_cols else f" cols {sorted(s_cols)} vs {sorted(d_cols)}"))
        if not ok:
            failures += 1
            if ok_cols:
                only_s = list((sk - dk).items())[:3]
                only_d = list((dk - sk).items())[:3]
                print("   spark-only:", only_s)
                print("   duck-only: ", only_d)
    print(f"{failures} failures")
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
