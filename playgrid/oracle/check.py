"""Side-by-side check of a Spark result against DuckDB SQL on the same parquet."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from playgrid.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows(df_cols, records):
    cols = sorted(df_cols)
    idx = [df_cols.index(c) for c in cols]
    out = [tuple(_norm(r[i]) for i in idx) for r in records]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))
    return cols, out


def compare(sdf, sql: str, con) -> dict:
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = rows(list(s_cols), s_rows)
    dc, dr = rows(d_cols, d_rows)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr), "cols_match": sc == dc}
    if sc != dc:
        out["spark_cols"], out["oracle_cols"] = sc, dc
        out["match"] = False
        return out
    mism = [(a, b) for a, b in zip(sr, dr) if a != b]
    out["match"] = len(sr) == len(dr) and not mism
    if mism:
        out["first_mismatch"] = mism[:3]
        out["n_mismatch"] = len(mism)
    return out
