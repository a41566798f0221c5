"""Compare a registered query with its DuckDB twin (rows, column names, values)."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


def compare(df, con, sql: str) -> tuple[bool, str]:
    cols = df.columns
    rows = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    res = con.sql(sql)
    ocols = res.columns
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {cols} vs {ocols}"
    idx = [ocols.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    if rows != orows:
        only_s = list(set(rows) - set(orows))[:2]
        only_o = list(set(orows) - set(rows))[:2]
        return False, f"rows {len(rows)} vs {len(orows)}; spark-only {only_s}; duckdb-only {only_o}"
    return True, f"{len(rows)} rows"
