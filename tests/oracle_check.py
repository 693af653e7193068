"""Run registered queries in Spark and their SQL oracles in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name.  Status ``OK`` = values equal exactly; ``OK(6dp)`` =
equal after rounding floats to 6 decimals; ``CLOSE`` = within 1e-9
relative; anything else is a mismatch.  Queries without an oracle are run
and their row count reported (``NO-ORACLE``).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def _exact(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        return _exact(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_exact(x) for x in v)
    if hasattr(v, "as_tuple"):  # Decimal
        return float(v)
    return v


def _rows_exact(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_exact(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def _close(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, (float, int)) and not isinstance(y, bool):
                if not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


def compare(spark, name, qfn, sql, sf_dir, con):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows), "sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        out["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return out
    a, b = _rows(scols, srows), _rows(dcols, drows)
    exact = _rows_exact(scols, srows) == _rows_exact(dcols, drows)
    if a == b:
        out["status"] = "OK" if exact else "OK(6dp)"
    elif _close(a, b):
        out["status"] = "CLOSE"
    else:
        out["status"] = "MISMATCH"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["diff"] = diff
        out["cols"] = sorted(scols)
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from lendscope.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", 8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in orc:
            t0 = time.time()
            try:
                n = qs[name](spark, sf_dir).count()
                print({"name": name, "status": "NO-ORACLE", "rows": n, "sec": round(time.time() - t0, 2)}, flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print({"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}, flush=True)
            continue
        try:
            r = compare(spark, name, qs[name], orc[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("OK", "OK(6dp)", "CLOSE"):
            bad += 1
        print(r, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
