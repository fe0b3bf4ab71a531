"""Row-level history per station: dedup, lags, moving averages, latest row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dockcast.functions.values import to_numeric
from dockcast.operators.segments import BORROWED, SEGMENT, plan_segments, rows_before


def dedup_pk(df: DataFrame, key: str, ts: str, tie: Sequence[str]) -> DataFrame:
    """Keep the first row of each (key, time) in tie order; copies merge before the shuffle."""
    rest = [c for c in df.columns if c not in (key, ts)]
    first = F.min_by(F.struct(*rest), F.struct(*tie))
    return df.groupBy(key, ts).agg(first.alias("_row")).select(key, ts, "_row.*").select(*df.columns)


def with_history(
    df: DataFrame,
    key: str,
    ts: str,
    reads: Sequence[str],
    lookback: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    tie: Sequence[str] = (),
    target_rows: int | None = None,
    copies: bool = False,
) -> DataFrame:
    """Add columns that look at most `lookback` rows back in each key's time order.

    With `tie` the rows are first made unique per (key, time), or with `copies` kept and put in tie
    order; without `tie` they must be unique. All rows are shuffled once, by key or by (key, segment) for keys too large for one task, and one sort serves
    both the dedup and the windows. `reads` names the columns that `add` looks back on.
    """
    segments = plan_segments(df, key, ts, target_rows)
    unique = bool(tie) and not copies
    if unique and segments.heavy_ties:
        df, tie, unique = dedup_pk(df, key, ts, tie), (), False
    rows = segments.tag(df)
    if segments.active:
        borrowed = rows_before(rows, segments, reads, lookback, tie, copies).withColumn(BORROWED, F.lit(True))
        rows = rows.withColumn(BORROWED, F.lit(False)).unionByName(borrowed, allowMissingColumns=True)
    rows = rows.repartition(*segments.partition_columns)
    if unique:
        first = Window.partitionBy(*segments.partition_columns, ts).orderBy(*tie)
        rows = rows.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    out = add(rows, segments.window([F.col(c) for c in ([ts, *tie] if copies else [ts])]))
    return out.where(~F.col(BORROWED)).drop(BORROWED, SEGMENT) if segments.active else out


def lag_columns(y: str, window: WindowSpec, max_lag: int) -> dict[str, Column]:
    return {f"y_lag{k}": F.lag(y, k).over(window) for k in range(1, max_lag + 1)}


def strict_mean(y: str, window: WindowSpec, width: int) -> Column:
    """Mean of the previous `width` rows, NULL unless all of them hold a value."""
    before = window.rowsBetween(-width, -1)
    return F.when(F.count(y).over(before) == width, F.avg(y).over(before))


def running_mean(y: str, window: WindowSpec, width: int) -> Column:
    """Mean of the current and the previous width - 1 rows, from as many values as there are."""
    return F.avg(y).over(window.rowsBetween(1 - width, 0))


def add_lags(
    df: DataFrame, key: str, ts: str, y: str, max_lag: int, tie: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """y_lag1 … y_lagN on one window, one sort."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns(lag_columns(y, w, max_lag))

    return with_history(df, key, ts, [y], max_lag, add, tie, target_rows)


def add_training_history(
    df: DataFrame, key: str, ts: str, y: str, tie: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """y_lag1, y_lag2 and the leak-free y_ma3 of the training table."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns({**lag_columns(y, w, 2), "y_ma3": strict_mean(y, w, 3)})

    return with_history(df, key, ts, [y], 3, add, tie, target_rows)


def add_slot_history(
    df: DataFrame,
    key: str,
    ts: str,
    y: str,
    max_lag: int = 12,
    widths: Sequence[int] = (3, 6, 12),
    tie: Sequence[str] = (),
    target_rows: int | None = None,
    copies: bool = False,
) -> DataFrame:
    """Lags, running means and the first difference, as the slot model sees them on each observation."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        means = {f"y_ma{n}": running_mean(y, w, n) for n in widths}
        return d.withColumns({**lag_columns(y, w, max_lag), **means, "y_diff1": F.col(y) - F.lag(y, 1).over(w)})

    return with_history(df, key, ts, [y], max(max_lag, *widths), add, tie, target_rows, copies)


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key; one partial row per key and task reaches the shuffle."""
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(last.alias("_row")).select(key, "_row.*").select(*df.columns)


def coerce_target(df: DataFrame, y: str) -> DataFrame:
    return df.withColumn(y, to_numeric(F.col(y)))
