"""Run registered queries in Spark and their SQL oracle in DuckDB and compare.

Usage: python tests/oracle_check.py [--sf DIR] [name ...]

The comparison mirrors the driver's: columns sorted by name, row count, column
names, and an order-insensitive multiset of value tuples.  Floats must be equal
exactly (queries round where engines could differ); a second, tolerant comparison
is printed to help diagnose.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v, tol):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if tol:
            return round(v, 6) + 0.0
        return repr(v) if STRICT else v + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    return v


def _rows(cols, rows, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i], tol) for i in order) for r in rows), key=repr)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    drows = cur.fetchall()
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res["status"] = f"SCHEMA {sorted(scols)} vs {sorted(dcols)}"
        return res
    if len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
        return res
    tdiff = {k: (stypes[k], dtypes[k]) for k in stypes if stypes[k] != dtypes.get(k)}
    if tdiff:
        res["status"] = f"TYPES {tdiff}"
        return res
    if _rows(scols, srows, False) == _rows(dcols, drows, False):
        res["status"] = "ok"
    elif _rows(scols, srows, True) == _rows(dcols, drows, True):
        res["status"] = "CLOSE (differs beyond 6 decimals only)"
    else:
        a, b = _rows(scols, srows, True), _rows(dcols, drows, True)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"VALUES {sorted(scols)} e.g. {diff}"
    return res


def main(argv):
    sf = "/root/testdata/sf0.01"
    plain = False
    if argv and argv[0] == "--plain":  # a default session, as an outside driver would build
        plain, argv = True, argv[1:]
    if argv and argv[0] == "--sf":
        sf, argv = argv[1], argv[2:]
    import __spark_entry__ as E
    if plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
            .config("spark.ui.showConsoleProgress", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tabforge.session import build_session
        spark = build_session(f"local[{os.environ.get('ORACLE_CPUS', '8')}]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    names = argv or list(qs)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf, n, qs[n], sqls.get(n), con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("ok", "rows-only")
        bad += not ok
        print(("  " if ok else "!!"), r, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
