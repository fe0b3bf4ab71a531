"""Whole-column typing and data contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dockcast.functions.timestamps import parse_ts, parse_wall_clock
from dockcast.functions.values import to_numeric

# fixed values: column names that are tried in this order
TS_CANDIDATES = ("ts", "ts_local", "timestamp", "datetime", "time")
TARGET_CANDIDATES = ("y", "bikes", "bikes_available", "available_bikes", "num_bikes_available", "target", "value")


class ContractError(ValueError):
    """The data breaks a rule that the job needs."""


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns {missing}; available: {df.columns}")


def find_column(df: DataFrame, candidates: Sequence[str]) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ContractError(f"none of {list(candidates)} in {df.columns}")


def with_default(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def is_all_digits(c: Column) -> Column:
    """Whether a whole column holds digits only; true for a column without values."""
    return F.coalesce(F.bool_and(c.cast("string").rlike("^[0-9]+$")), F.lit(True))


def normalize_id(df: DataFrame, name: str) -> DataFrame:
    """One type decision for the whole id column: long if every id is digits, else string. NULL ids stay NULL."""
    kind = dict(df.dtypes)[name]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return df.withColumn(name, F.col(name).cast("bigint"))
    digits = df.agg(is_all_digits(F.col(name)).alias("ok")).first()["ok"]
    return df.withColumn(name, F.col(name).try_cast("bigint") if digits else F.col(name).cast("string"))


def parse_time(df: DataFrame, ts: str, seen: Observation | None = None, mode: str = "utc", zone: str = "UTC") -> DataFrame:
    """Parse a time column and drop the rows that do not parse; `seen` counts them in the same pass.

    Zoned values, and text with an offset, are instants: they become the wall clock that `mode` and `zone` name (see to_naive).
    """
    kind = dict(df.dtypes)[ts]
    parsed = df if kind == "timestamp_ntz" else df.withColumn(ts, parse_wall_clock(F.col(ts), kind, mode, zone))
    if seen is not None:
        parsed = parsed.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(ts).isNull()).alias("n_bad"))
    return parsed.where(F.col(ts).isNotNull())


def contract_counts(key: str, ts: str, y: str) -> list[Column]:
    """Counts of every broken rule; any non-zero one is an error."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(key).isNull()).alias("null_id"),
        F.count_if(F.col(ts).isNull()).alias("null_ts"),
        F.count_if(to_numeric(F.col(y)) < 0).alias("negative_y"),
    ]


def contract_report(df: DataFrame, key: str, ts: str, y: str) -> DataFrame:
    return df.agg(*contract_counts(key, ts, y))


def contract_gate(found: Mapping[str, object]) -> None:
    """Raise with the counts of broken rules, if there are any."""
    broken = {k: v for k, v in found.items() if k != "n_rows" and v}
    if broken:
        raise ContractError(f"data contract broken: {broken}")


def check_contract(df: DataFrame, key: str, ts: str, y: str) -> None:
    """Raise with the counts if an id or time is missing or a target is negative."""
    contract_gate(contract_report(df, key, ts, y).first().asDict())


def unparsed_count(df: DataFrame, ts: str) -> DataFrame:
    """Rows and how many of their times do not parse."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(parse_ts(F.col(ts)).isNull()).alias("n_bad"))


def check_times(df: DataFrame, ts: str) -> None:
    """The strict variant of parse_time: any bad value is an error."""
    bad = unparsed_count(df, ts).first()["n_bad"]
    if bad:
        raise ContractError(f"{bad} values of {ts} are not timestamps")
