"""Temporal splits: exact order statistics over distinct times, without a global sort in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.timestamps import lit_ts, micros, micros_of
from dockcast.operators.contracts import ContractError

MAX_COLLECT = 10_000
PARTS = ("train", "val", "test")
MIN_ROWS = 100
NARROWING = (24, 60, 60, 1_000)


class DistinctTimes:
    """The sorted distinct times of a table, for exact picks by position.

    One pass counts the distinct times per day. Up to MAX_COLLECT times are then simply collected; with more,
    a pick collects the one day it falls into, narrowed again to hours, minutes, seconds and milliseconds
    while that is too much. Later passes filter on time first. The table should be a stored one.
    """

    def __init__(self, df: DataFrame, ts: str):
        self._times = df.where(F.col(ts).isNotNull()).select(F.col(ts).alias("t"))
        day = F.to_date("t").cast("timestamp_ntz").alias("start")
        per_day = self._times.distinct().groupBy(day).count().collect()
        self._days = sorted((row["start"], row["count"]) for row in per_day)
        self.count = sum(n for _, n in self._days)
        self._held = self._collect(self._times) if self.count <= MAX_COLLECT else None

    @staticmethod
    def _collect(times: DataFrame) -> list[datetime]:
        return sorted(row["t"] for row in times.distinct().collect())

    def at(self, positions: Sequence[int]) -> list[datetime]:
        """The times at 0-based positions of the sorted sequence."""
        return [self._pick(p) for p in positions]

    def _pick(self, position: int) -> datetime:
        if not 0 <= position < self.count:
            raise IndexError(f"position {position} of {self.count} distinct times")
        if self._held is not None:
            return self._held[position]
        counts, steps = self._days, list(NARROWING)
        span = timedelta(days=1)
        while True:
            for start, size in counts:
                if position < size:
                    break
                position -= size
            inside = self._times.where((F.col("t") >= lit_ts(start)) & (F.col("t") < lit_ts(start + span)))
            if size <= MAX_COLLECT or not steps:
                return self._collect(inside)[position]
            parts = steps.pop(0)
            span = span / parts
            counts = self._even_parts(inside, start, span)

    @staticmethod
    def _even_parts(inside: DataFrame, start: datetime, span: timedelta) -> list[tuple[datetime, int]]:
        width = span // timedelta(microseconds=1)
        part = F.floor((micros(F.col("t")) - F.lit(micros_of(start))) / F.lit(width)).alias("part")
        rows = inside.distinct().groupBy(part).count().collect()
        return sorted((start + row["part"] * span, row["count"]) for row in rows)


def split_cuts(df: DataFrame, ts: str, p_train: float = 0.70, p_val: float = 0.15) -> tuple[datetime, datetime]:
    """The last training and the last validation time. Positions are truncated binary fractions of the distinct times."""
    if not (0 < p_train < 1 and 0 < p_val < 1 and p_train + p_val < 1):
        raise ValueError("p_train and p_val must be in (0, 1) and leave room for a test part")
    times = DistinctTimes(df, ts)
    if times.count < 3:
        raise ContractError("fewer than three distinct times")
    first, second = times.at([int(times.count * p_train), int(times.count * (p_train + p_val))])
    return first, second


def split_label(ts: Column, cuts: tuple[datetime, datetime]) -> Column:
    return F.when(ts <= lit_ts(cuts[0]), "train").when(ts <= lit_ts(cuts[1]), "val").otherwise("test")


def temporal_split(df: DataFrame, ts: str, p_train: float = 0.70, p_val: float = 0.15) -> DataFrame:
    """Label each row train, val or test by global time."""
    return df.withColumn("split", split_label(F.col(ts), split_cuts(df, ts, p_train, p_val)))


def split_sizes() -> dict[str, Column]:
    """Rows per part, as aggregates over a labelled table."""
    return {name: F.count_if(F.col("split") == name) for name in PARTS}


def size_gate(min_rows: int = MIN_ROWS):
    """Raises if a part has too few rows."""

    def gate(found: Mapping[str, object]) -> None:
        small = {name: found[name] for name in PARTS if found[name] < min_rows}
        if small:
            raise ContractError(f"splits below {min_rows} rows: {small}")

    return gate


def check_split_sizes(labelled: DataFrame, min_rows: int = MIN_ROWS) -> None:
    """The same gate for a table that is there already."""
    size_gate(min_rows)(labelled.agg(*[c.alias(n) for n, c in split_sizes().items()]).first().asDict())


def split_report(labelled: DataFrame, ts: str) -> DataFrame:
    return labelled.groupBy("split").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")
    )


def fold_cuts(
    df: DataFrame, ts: str, n_splits: int = 3, p_train_start: float = 0.50, p_train_end: float = 0.75, p_val: float = 0.15
) -> list[tuple[int, datetime, datetime]]:
    """(fold, last training time, last validation time) of an expanding window; folds without validation times are left out."""
    span = (p_train_end - p_train_start) / (n_splits - 1) if n_splits > 1 else 0.0
    shares = [p_train_start + i * span for i in range(n_splits)]
    if n_splits > 1:
        shares[-1] = p_train_end
    times = DistinctTimes(df, ts)
    last, folds = times.count - 1, []
    for number, share in enumerate(shares if times.count else [], start=1):
        ends = [min(last, int(times.count * share)), min(last, int(times.count * (share + p_val)))]
        train_end, val_end = times.at(ends)
        if val_end > train_end:
            folds.append((number, train_end, val_end))
    return folds


def label_folds(df: DataFrame, ts: str, folds: Sequence[tuple[int, datetime, datetime]]) -> DataFrame:
    """One output row per fold a row takes part in, marked train or val; a row-local explode over the few folds."""
    at = F.col(ts)
    parts = [
        F.when(
            at <= lit_ts(val_end),
            F.struct(
                F.lit(number).alias("fold"),
                F.when(at <= lit_ts(train_end), "train").otherwise("val").alias("part"),
                lit_ts(train_end).alias("train_end"),
                lit_ts(val_end).alias("val_end"),
            ),
        )
        for number, train_end, val_end in folds
    ]
    return df.select("*", F.inline(F.filter(F.array(*parts), lambda p: p.isNotNull())))

