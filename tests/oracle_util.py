"""Compare a Spark result with DuckDB SQL on the same parquet tables (names, rows, values)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def _same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            return math.isclose(float(a), float(b), rel_tol=tol, abs_tol=tol)
        except (TypeError, ValueError):
            return False
    return a == b


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    sc, sr = _rows(s)
    oc, orows = _rows(o)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orows):
        return False, f"row count differs: spark={len(sr)} oracle={len(orows)}"
    for i, (a, b) in enumerate(zip(sr, orows)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return False, f"row {i} differs: spark={a} oracle={b}"
    return True, f"{len(sr)} rows"
