"""Compare a Spark result with its SQL oracle: columns, types, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if isinstance(value, float) and value.is_integer():  # a whole-number column with NULLs
        return repr(int(value))
    return repr(value)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    columns = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in sorted(pdf.columns)]
    return sorted(tuple(cell(v) for v in row) for row in zip(*columns, strict=True))


def family(dtype) -> str:
    text = str(dtype)
    for name in ("datetime", "int", "float", "bool"):
        if text.startswith(name):
            return text if name in ("int", "float") else name
    return "text"


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else what differs."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = [(c, family(got[c].dtype), family(want[c].dtype)) for c in got.columns]
    types = [k for k in kinds if k[1] != k[2] and got[k[0]].notna().all() and len(got)]
    if types:
        return f"types {types}"
    left, right = rows_of(got), rows_of(want)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return f"{len(bad)} rows differ, such as {bad[0]}" if bad else None
