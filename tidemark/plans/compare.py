"""Local Spark-vs-DuckDB comparison: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
import os

import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
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
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if hasattr(v, "as_tuple") and hasattr(v, "is_nan"):  # Decimal
        return _norm(float(v))
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(v) for v in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str, max_diffs: int = 5) -> dict:
    s = spark_df.toPandas()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    d = pd.DataFrame.from_records(cur.fetchall(), columns=names)
    out = {"spark_rows": len(s), "oracle_rows": len(d),
           "spark_cols": sorted(s.columns), "oracle_cols": sorted(d.columns)}
    out["cols_match"] = [c.lower() for c in out["spark_cols"]] == [c.lower() for c in out["oracle_cols"]]
    if not out["cols_match"] or len(s) != len(d):
        out["match"] = False
        return out
    d.columns = [c for c in d.columns]
    rename = {c: c for c in d.columns}
    lower = {c.lower(): c for c in s.columns}
    d = d.rename(columns={c: lower[c.lower()] for c in d.columns})
    del rename
    a, b = frame_rows(s), frame_rows(d)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    out["value_diffs"] = len(diffs)
    out["examples"] = diffs[:max_diffs]
    out["match"] = not diffs
    return out
