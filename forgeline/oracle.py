"""Side-by-side comparison of a registered query with its DuckDB oracle (test helper).

Mirrors the driver's gate: same column names, same row count, same multiset of rows
after sorting columns by name.  Floats are compared after rounding to 6 decimals.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = _canon(s_cols, s_rows)
    dc, dr = _canon(d_cols, d_rows)
    res = {"spark_rows": len(sr), "oracle_rows": len(dr), "schema_match": sc == dc,
           "rows_match": len(sr) == len(dr), "values_match": sr == dr}
    if not res["values_match"] and sc == dc:
        ss, ds = set(sr), set(dr)
        res["only_spark"] = list(ss - ds)[:3]
        res["only_oracle"] = list(ds - ss)[:3]
    if sc != dc:
        res["spark_cols"], res["oracle_cols"] = sc, dc
    return res
