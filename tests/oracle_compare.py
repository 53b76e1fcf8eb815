"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
row count, column names and an order-insensitive comparison of values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    sc, sr = normalise(scols, srows)
    dc, dr = normalise(dcols, drows)
    if sc != dc:
        res["status"] = f"COLUMNS differ: spark={sc} oracle={dc}"
    elif len(sr) != len(dr):
        res["status"] = "ROWCOUNT differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"VALUES differ, e.g. {diff}"
    else:
        res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    from cartwheel.session import build_session

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    q, o = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, q[n], o.get(n), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
