"""The training table: typed, unique, checked, with calendar and leak-free history columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.calendar import calendar_columns
from dockcast.operators.history import add_training_history, coerce_target
from dockcast.operators.contracts import check_contract, contract_counts, contract_gate, normalize_id, parse_time, require_columns
from dockcast.operators.split import MIN_ROWS, size_gate, split_sizes, temporal_split
from dockcast.sources import io

HISTORY_COLUMNS = ["y_lag1", "y_lag2", "y_ma3"]


def model_ready(
    raw: DataFrame,
    key: str = "station_id",
    ts: str = "ts_local",
    y: str = "num_bikes_available",
    tie: Sequence[str] = (),
    enforce: bool = True,
    target_rows: int | None = None,
    mode: str = "utc",
    zone: str = "UTC",
) -> DataFrame:
    """Parse, normalise, dedup, add calendar and history, drop rows without full history.

    One shuffle by (key, segment) and one sort carry dedup and all history columns. `enforce`
    runs the data contract first, as one extra aggregate over three columns. `tie` decides which of several rows with one
    key and time stays; without it such rows would be picked by their target, so it is required.
    """
    if not tie:
        raise ValueError("name the columns that break ties between rows with one key and time")
    require_columns(raw, key, ts, y)
    typed = coerce_target(parse_time(normalize_id(raw, key), ts, mode=mode, zone=zone), y)
    if enforce:
        check_contract(typed, key, ts, y)
    history = add_training_history(typed, key, ts, y, list(tie), target_rows)
    return history.dropna(subset=HISTORY_COLUMNS).withColumns(calendar_columns(F.col(ts)))


def publish_ready(ready: DataFrame, base: str, asof: datetime, step_minutes: int, key: str = "station_id", ts: str = "ts_local", y: str = "num_bikes_available") -> str:
    """Publish a training table; its contract is counted by the write, and a broken one is not announced."""
    counts = dict(zip(("n_rows", "null_id", "null_ts", "negative_y"), contract_counts(key, ts, y), strict=True))
    return io.publish(ready, base, asof, step_minutes, counts, contract_gate)


def publish_split(ready: DataFrame, base: str, asof: datetime, step_minutes: int, ts: str = "ts_local", min_rows: int = MIN_ROWS) -> str:
    """Publish the training table with its split; parts that are too small are found by the write, and not announced."""
    return io.publish(temporal_split(ready, ts), base, asof, step_minutes, split_sizes(), size_gate(min_rows))
