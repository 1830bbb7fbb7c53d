"""Spark result against DuckDB result: same columns, same rows in any order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _text(v) -> str:
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0) if v != int(v) else str(int(v))
    return str(v)


def rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_text(r[i]) for i in order) for r in data)


def diff(spark_df, con, sql: str) -> str | None:
    got_cols, got = rows(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    want_cols, want = rows([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        got_set, want_set = set(got), set(want)
        extra, missing = sorted(got_set - want_set)[:3], sorted(want_set - got_set)[:3]
        return f"{len(got)} rows vs {len(want)}; extra {extra}; missing {missing}; {got_cols}"
    return None
