"""Run registered Spark queries and their DuckDB oracles side by side.

usage: python tools/oracle_check.py [--sf DIR] [name ...]
Reports per query: rows (spark/oracle), column names, types, exact value match.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.registry import all_queries  # noqa: E402
from tessera.session import get_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def norm_val(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm_val(x) for x in v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v)) if False else ("i", v)
    return ("s", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm_val(r[i]) for i in order) for r in records)


def close(a, b, tol=1e-6):
    if a == b:
        return True
    if a[0] == "f" and b[0] == "f":
        return abs(a[1] - b[1]) <= tol * max(1.0, abs(a[1]), abs(b[1]))
    if a[0] == "i" and b[0] == "f" or a[0] == "f" and b[0] == "i":
        return float(a[1]) == float(b[1])
    if a[0] == "l" and b[0] == "l" and len(a[1]) == len(b[1]):
        return all(close(x, y, tol) for x, y in zip(a[1], b[1]))
    return False


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    qs = all_queries()
    names = args.names or list(qs)
    summary = []
    for name in names:
        q = qs[name]
        t0 = time.time()
        try:
            sdf = q.fn(spark, args.sf)
            scols = sdf.columns
            stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
            srecs = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"[{name}] SPARK ERROR {type(e).__name__}: {str(e)[:1500]}")
            summary.append((name, "spark-error"))
            continue
        st = time.time() - t0
        if not q.oracle:
            print(f"[{name}] rows-only: {len(srecs)} rows {st:.1f}s cols={scols}")
            summary.append((name, "rows-only"))
            continue
        try:
            t1 = time.time()
            res = con.execute(q.oracle)
            ocols = [d[0] for d in res.description]
            otypes = [str(d[1]) for d in res.description]
            orecs = res.fetchall()
            ot = time.time() - t1
        except Exception as e:  # noqa: BLE001
            print(f"[{name}] ORACLE ERROR {type(e).__name__}: {str(e)[:1500]}")
            summary.append((name, "oracle-error"))
            continue
        status = []
        if sorted(scols) != sorted(ocols):
            status.append(f"COLS spark={sorted(scols)} oracle={sorted(ocols)}")
        if len(srecs) != len(orecs):
            status.append(f"ROWS spark={len(srecs)} oracle={len(orecs)}")
        if not status:
            a, b = rows_of(scols, srecs), rows_of(ocols, orecs)
            if a == b:
                verdict = "EXACT"
            elif all(close(x, y) for ra, rb in zip(a, b) for x, y in zip(ra, rb)):
                verdict = "CLOSE"
                bad = [(ra, rb) for ra, rb in zip(a, b) if ra != rb][:2]
                status.append(f"close-diff {bad}")
            else:
                verdict = "MISMATCH"
                bad = [(ra, rb) for ra, rb in zip(a, b) if not all(
                    close(x, y) for x, y in zip(ra, rb))][:3]
                status.append(f"diff {bad}")
        else:
            verdict = "MISMATCH"
        tmap = dict(zip(scols, stypes))
        omap = dict(zip(ocols, otypes))
        tinfo = {c: (tmap.get(c), omap.get(c)) for c in sorted(set(scols) | set(ocols))}
        print(f"[{name}] {verdict} rows={len(srecs)} spark={st:.1f}s duck={ot:.1f}s "
              f"types={tinfo} {' '.join(status)[:2000]}")
        summary.append((name, verdict))
    print("SUMMARY", " ".join(f"{n}:{v}" for n, v in summary))


if __name__ == "__main__":
    main()
