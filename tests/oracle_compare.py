"""Compare a registered Spark query with its DuckDB oracle SQL.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive hash of the values (doubles rounded to 6 places).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, sf_dir, verbose=True):
    import __spark_entry__ as E
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = (len(srows) == len(drows)) and sorted(scols) == sorted(dcols) and sh == dh
    out = {"name": name, "ok": ok, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    if not ok and verbose:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
        sset, dset = set(sl), set(dl)
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_oracle"] = sorted(dset - sset)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from corpusflow.session import get_spark
    import __spark_entry__ as E
    spark = get_spark()
    con = duck(sf_dir)
    names = names or list(E.queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:2000]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}")


if __name__ == "__main__":
    main(sys.argv)
