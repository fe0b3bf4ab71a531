"""Health of the pipeline's tables as a table of checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_checks(df: DataFrame, name: str, required: Sequence[str], key: str = "station_id") -> DataFrame:
    """Required columns, rows and stations of one table, as one row; a single aggregate."""
    missing = [c for c in required if c not in df.columns]
    stations = F.count_distinct(key) if key in df.columns else F.lit(0).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), stations.alias("n_stations")).select(
        F.lit(name).alias("table"),
        F.lit(not missing).alias("columns_ok"),
        "n_rows",
        "n_stations",
        (F.lit(not missing) & (F.col("n_rows") > 0)).alias("healthy"),
    )


def health_checks(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    checks = [table_checks(df, name, required) for name, df, required in tables]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out
