"""Run a registered query in Spark and its SQL twin in DuckDB and compare."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    if dtype in ("tinyint", "smallint", "int", "integer"):
        return "int"
    if dtype in ("varchar", "string"):
        return "string"
    return dtype


def _rows(pdf: pd.DataFrame) -> list[str]:
    columns = sorted(pdf.columns)
    out = []
    for row in pdf[columns].itertuples(index=False):
        cells = []
        for v in row:
            if v is None or v is pd.NaT or v != v:
                cells.append("∅")
            elif isinstance(v, float):
                cells.append(repr(v + 0.0))
            else:
                cells.append(str(v))
        out.append("|".join(cells))
    return sorted(out)


def compare(df, con, sql: str) -> str | None:
    """None if names, types, row count and values agree, else what differs."""
    relation = con.sql(sql)
    oracle_types = {c: _kind(str(t)) for c, t in zip(relation.columns, relation.types)}
    spark_types = {c: _kind(t) for c, t in df.dtypes}
    if oracle_types != spark_types:
        return f"schema: spark {spark_types} oracle {oracle_types}"
    mine = [tuple(r) for r in df.collect()]
    mine = _rows(pd.DataFrame(mine, columns=df.columns, dtype=object))
    theirs = _rows(pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object))
    if len(mine) != len(theirs):
        return f"rows: spark {len(mine)} oracle {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, e.g. {bad[0]}" if bad else None
