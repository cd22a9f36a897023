"""Run a registered query on Spark and its oracle SQL on DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if os.environ.get("ORACLE_EXACT"):
            return v + 0.0
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, rows


def compare(spark, name, fn, sql, sf_dir, con=None):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sc, sr = rows_of(scols, srows)
    dc, dr = rows_of(dcols, drows)
    out = {"name": name, "spark_rows": len(sr), "sql_rows": len(dr),
           "cols_match": sc == dc, "values_match": sr == dr,
           "spark_sec": round(t1 - t0, 2), "sql_sec": round(t2 - t1, 2)}
    if not out["cols_match"]:
        out["cols"] = (sc, dc)
    elif not out["values_match"]:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        out["diff"] = (diff_s, diff_d)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from sparkclassify.plans.catalog import all_oracle_sql, all_queries
    from sparkclassify.session import get_spark
    spark = get_spark("oracle-check", master="local[8]", shuffle_partitions=8,
                      extra_conf={"spark.ui.enabled": "false",
                                  "spark.driver.memory": "8g",
                                  "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = all_queries(), all_oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            print({"name": name, "oracle": "none"})
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": name, "error": repr(e)[:2000]}
        ok = r.get("cols_match") and r.get("values_match") and r["spark_rows"] == r["sql_rows"]
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
