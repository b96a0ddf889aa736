"""Row comparison with DuckDB over the same parquet tables."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def _cell(v: object) -> str:
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, str):
        return v
    if isinstance(v, float):
        return f"{v:.6g}"
    if "bool" in type(v).__name__:
        return str(bool(v))
    if hasattr(v, "__len__"):
        return str([_cell(x) for x in v])
    return f"{float(v):.6g}" if "float" in type(v).__name__ else str(v)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    names = sorted(df.columns)
    return sorted(tuple(_cell(v) for v in r) for r in df[names].astype(object).itertuples(index=False))
