"""Run a Spark query and its DuckDB oracle side by side and compare.

Columns are compared by name; rows order-insensitively; doubles with a
relative tolerance of 1e-9 (and reported when not bit-identical).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, int):
        return (1, float(v))
    return (3, str(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=repr)


def _close(a, b):
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-9)
    if a[0] == 2 and b[0] == 2:
        return a[1] == b[1]
    return False


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dd = con.execute(sql).df()
    t2 = time.time()
    sc, sr = _rows(sp)
    dc, dr = _rows(dd)
    msg = f"{name}: spark {len(sr)} rows {t1-t0:.1f}s, duck {len(dr)} rows {t2-t1:.1f}s"
    if sc != dc:
        return False, msg + f" COLUMNS differ {sc} vs {dc}"
    if len(sr) != len(dr):
        return False, msg + " ROWCOUNT differs"
    # sort both by the non-float parts first, then compare pairwise
    bad = [(a, b) for a, b in zip(sr, dr) if not all(_close(x, y) for x, y in zip(a, b))]
    if bad:
        return False, msg + f" {len(bad)} rows differ, e.g. {bad[0]}"
    exact = all(a == b for a, b in zip(sr, dr))
    return True, msg + ("" if exact else " (floats within tolerance)")


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from linestream.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session()
    con = duck(sf)
    qs, os_ = E.queries(), E.oracle_sql()
    ok_all = True
    for n in names:
        if n not in os_:
            t0 = time.time()
            c = qs[n](spark, sf).count()
            print(f"{n}: NO ORACLE, {c} rows {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            ok, msg = compare(spark, n, qs[n], os_[n], sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        ok_all &= ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print("ALL PASS" if ok_all else "SOME FAILED")
