"""Compare a Spark result with DuckDB SQL on the same parquet tables: row count,
column names and an order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import os

import duckdb
import pandas as pd

from tidemark.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return "∅"
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat() if not isinstance(v, str) else v
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)) or (hasattr(v, "dtype") and "int" in str(getattr(v, "dtype", ""))):
        return str(int(v))
    if isinstance(v, float):
        return repr(float(v))
    return str(v)


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(rows), cols, h


def compare(spark_df, con, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.sql(sql).df()
    sn, sc, sh = frame_digest(s)
    dn, dc, dh = frame_digest(d)
    return {"rows": (sn, dn), "cols_match": sc == dc, "cols": (sc, dc), "hash_match": sh == dh}
