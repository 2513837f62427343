"""Spark vs DuckDB parity for every catalog query (the driver's check, locally).

Usage: python tests/parity.py [sf_dir] [name ...]
Compares row count, column names, column types and an order-insensitive value
hash (doubles at 9 significant digits, or exact with PARITY_EXACT=1); prints
one line per query.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb  # noqa: F401

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
         "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP", "FloatType()": "FLOAT",
         "BooleanType()": "BOOLEAN"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if os.environ.get("PARITY_EXACT") else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from ledgerline.session import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"rows-only {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(sql[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            dtypes = dict(zip(dcols, [str(t) for t in con.sql(sql[name]).types]))
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        stypes = {f.name: TYPES.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        ok = (len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd
              and stypes == dtypes)
        tag = "ok  " if ok else "FAIL"
        print(f"{tag} {name}: spark {len(srows)} rows, duckdb {len(drows)} rows ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(dcols):
                print("   cols", sorted(scols), sorted(dcols))
            if stypes != dtypes:
                print("   types", {k: (v, dtypes.get(k)) for k, v in stypes.items() if v != dtypes.get(k)})
            diff_s = [x for x in ls if x not in set(ld)][:3]
            diff_d = [x for x in ld if x not in set(ls)][:3]
            print("   spark-only", diff_s)
            print("   duck-only ", diff_d)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
