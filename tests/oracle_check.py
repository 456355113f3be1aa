"""Run registered queries on Spark and their oracles on DuckDB and compare
row count, column names, column kinds and the multiset of rows.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _kind(t: str) -> str:
    t = t.lower()
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "decimal", "real")):
        return "float"
    if "bool" in t:
        return "bool"
    if "char" in t or "string" in t:
        return "str"
    return t


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(round(v, 9)))
    return (1, repr(v))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    scols = sdf.columns
    stypes = [t for _, t in sdf.dtypes]
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "spark_sec": round(t1 - t0, 2)}
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns {sorted(scols)} vs {sorted(dcols)}")
    else:
        sk = {c: _kind(t) for c, t in zip(scols, stypes)}
        dk = {c: _kind(t) for c, t in zip(dcols, dtypes)}
        bad = {c: (sk[c], dk[c]) for c in scols if sk[c] != dk[c]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sset = sorted(tuple(_norm(r[i]) for i in si) for r in srows)
        dset = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
        if len(srows) != len(drows):
            problems.append("row count")
        if sset != dset:
            from collections import Counter
            cs, cd = Counter(sset), Counter(dset)
            diff = list((cs - cd).elements())[:3]
            diff2 = list((cd - cs).elements())[:3]
            res["n_diff"] = sum((cs - cd).values())
            problems.append(f"values differ ({res['n_diff']} rows); spark-only {diff} "
                            f"duck-only {diff2}")
    res["ok"] = not problems
    res["problems"] = problems
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tablewright.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    q, o = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    n_ok = 0
    for name in (names or list(q)):
        if name not in o:
            t0 = time.time()
            try:
                n = q[name](spark, sf_dir).count()
                print(f"ROWS  {name}: {n} rows {time.time() - t0:.1f}s", flush=True)
            except Exception as e:  # noqa: BLE001
                print(f"FAIL  {name}: {type(e).__name__}: {str(e)[:300]}", flush=True)
            continue
        try:
            r = compare(spark, con, name, q[name], o[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        n_ok += r["ok"]
        tag = "OK   " if r["ok"] else "DIFF "
        print(f"{tag} {name}: {r['spark_rows']}/{r['duck_rows']} rows {r['spark_sec']}s "
              f"{'; '.join(r['problems'])[:600]}", flush=True)
    print(f"{n_ok}/{len([n for n in (names or list(q)) if n in o])} oracle matches")


if __name__ == "__main__":
    main(sys.argv)
