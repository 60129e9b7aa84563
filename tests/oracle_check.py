"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records")]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
                  "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diffs(sdf, con, sql) -> list:
    """Columns whose Spark type does not map to the DuckDB result type."""
    rel = con.sql(sql)
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        want = _SPARK_TO_DUCK.get(st, st.upper())
        got = duck_types.get(f.name)
        if got is not None and got != want and not (st.startswith("array") and got.endswith("[]")):
            out.append((f.name, st, got))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    dpdf = con.execute(sql).df()
    t2 = time.time()
    tdiff = type_diffs(sdf, con, sql)
    res = {"name": name, "spark_rows": len(spdf), "oracle_rows": len(dpdf),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(spdf.columns) != sorted(dpdf.columns):
        res["status"] = f"COLUMNS {sorted(spdf.columns)} vs {sorted(dpdf.columns)}"
        return res
    a, b = rows_of(spdf), rows_of(dpdf)
    if a == b and tdiff:
        res["status"] = f"TYPES {tdiff}"
    elif a == b:
        res["status"] = "OK"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "MISMATCH"
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
        res["n_diff"] = len(sa ^ sb)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from quantbeam.plans.catalog import oracle_sql, queries
    from quantbeam.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, ors = queries(), oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        if name not in ors:
            sdf = qs[name](spark, sf_dir)
            print({"name": name, "status": "NO_ORACLE", "rows": sdf.count()}, flush=True)
            continue
        try:
            r = compare(spark, con, name, qs[name], ors[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] != "OK"
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv)
