"""Side-by-side check of ``queries()`` against ``oracle_sql()`` on DuckDB.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH with row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare floats exactly (no re-rounding)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, dict)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:300])
            print(name, "SPARK-ERROR", str(e)[:300], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS-ONLY", len(srows))
            print(f"{name:34s} ROWS-ONLY rows={len(srows)} spark={ts:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(sqls[name])
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK-ERROR", str(e)[:300])
            print(name, "DUCK-ERROR", str(e)[:300], flush=True)
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = ok_cols and a == b
        status = "OK" if ok else "MISMATCH"
        results[name] = (status, len(srows), len(drows))
        print(f"{name:34s} {status} spark_rows={len(srows)} duck_rows={len(drows)} spark={ts:.1f}s", flush=True)
        if not ok and verbose:
            if not ok_cols:
                print("   cols spark:", sorted(scols), "duck:", sorted(dcols))
            else:
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                print("   spark-only:", diff_a)
                print("   duck-only :", diff_b)
    return results


if __name__ == "__main__":
    from revlens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS-ONLY")]
    print("SUMMARY", len(res), "queries;", len(bad), "not ok:", bad)
