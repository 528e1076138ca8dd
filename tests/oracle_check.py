"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's correctness gate: row count, column names, and an
order-insensitive comparison of values (exact, and with a 1e-9 relative
tolerance on floats, reported separately).
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v, digits=None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None:
            return round(v, digits)
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if v is not None and type(v).__name__ == "Decimal":
        return float(v)
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols, digits=None):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {spark_cols} vs {duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(norm(r[i], digits) for i in si) for r in spark_rows), key=key)
    b = sorted((tuple(norm(r[i], digits) for i in di) for r in duck_rows), key=key)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return None


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from towerlens.session import local_session
    import __spark_entry__ as E

    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            fails += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            fails += 1
            continue
        exact = compare(rows, cols, drows, dcols)
        loose = compare(rows, cols, drows, dcols, digits=6) if exact else None
        if exact is None:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
        elif loose is None:
            print(f"NEAR {name}: {len(rows)} rows; exact: {exact}")
        else:
            print(f"FAIL {name}: {exact}")
            fails += 1
    print(f"{fails} failures")


if __name__ == "__main__":
    main()
