"""Slot targets and slot features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.calendar import calendar_columns
from dockcast.functions.timestamps import MICROS_PER_DAY, MICROS_PER_MINUTE, add_minutes, micros, minutes, parse_wall_clock
from dockcast.functions.values import to_numeric
from dockcast.operators.asof import asof_join
from dockcast.operators.contracts import TARGET_CANDIDATES, TS_CANDIDATES, check_times, find_column, normalize_id, with_default
from dockcast.operators.history import add_slot_history
from dockcast.operators.segments import TARGET_ROWS
from dockcast.operators.slots import (
    DEFAULT_LEAD_MINUTES,
    DEFAULT_SLOTS,
    DEFAULT_TOLERANCE_MINUTES,
    DEFAULT_ZONE,
    GENERATED_FROM,
    minute_of_day,
    next_slot,
    slot_grid,
    smallest_gap_minutes,
)

# fixed values: column names of the slot tables
TARGET_COLUMNS = ["station_id", "t_slot", "slot_label", "y", "generated_from", "lead_minutes", "ts_matched"]


def observations(
    raw: DataFrame,
    key: str = "station_id",
    ts: str | None = None,
    y: str | None = None,
    tie: Sequence[str] = (),
    zone: str = DEFAULT_ZONE,
    strict: bool = True,
) -> DataFrame:
    """station_id, ts, y and the tie-break columns of a feed; ids of one type, times as the wall clock of `zone`.

    A time or target column that is not named is found by the names that feeds use for it.
    Text that is no time is an error, or dropped with `strict` off. Rows without an id or a time cannot be placed and go.
    """
    ts, y = ts or find_column(raw, TS_CANDIDATES), y or find_column(raw, TARGET_CANDIDATES)
    kind = dict(raw.dtypes)[ts]
    typed = normalize_id(raw, key)
    if kind == "string" and strict:
        check_times(typed.where(F.col(ts).isNotNull()), ts)
    at = F.col(ts) if kind == "timestamp_ntz" else parse_wall_clock(F.col(ts), kind, "local", zone)
    return typed.select(F.col(key).alias("station_id"), at.alias("ts"), to_numeric(F.col(y)).alias("y"), *tie).where(
        F.col("station_id").isNotNull() & F.col("ts").isNotNull()
    )


def slot_targets(
    obs: DataFrame,
    slots: Sequence[str] = DEFAULT_SLOTS,
    how: str = "asof",
    tolerance_minutes: float = DEFAULT_TOLERANCE_MINUTES,
    lead_minutes: int = DEFAULT_LEAD_MINUTES,
    tie: Sequence[str] = (),
) -> DataFrame:
    """One row per station, day and slot with the observed value at the slot.

    The as-of match is an aggregation: each observation knows its next slot by arithmetic, so only the
    last one per station and slot is shuffled, already combined within each task. With `exact`,
    ts_matched is the slot itself even where nothing was observed, and copies of an observation repeat the slot.
    """
    grid = slot_grid(obs, "station_id", "ts", slots)
    if how == "exact":
        found = grid.join(obs.select("station_id", F.col("ts").alias("t_slot"), "y"), ["station_id", "t_slot"], "left")
        found = found.withColumn("ts_matched", F.col("t_slot"))
    elif how == "asof":
        found = _asof_on_grid(grid, obs, slots, tolerance_minutes, tie)
    else:
        raise ValueError(f"how must be 'asof' or 'exact', not {how!r}")
    return found.withColumns(
        {"generated_from": F.lit(GENERATED_FROM), "lead_minutes": F.lit(lead_minutes)}
    ).select(*TARGET_COLUMNS)


def _asof_on_grid(grid: DataFrame, obs: DataFrame, slots: Sequence[str], tolerance_minutes: float, tie: Sequence[str]) -> DataFrame:
    limit = minutes(tolerance_minutes)
    served = obs.withColumn("t_slot", next_slot(F.col("ts"), slots))
    own_slot_only = tolerance_minutes < smallest_gap_minutes(slots)
    if own_slot_only:
        served = served.where(F.col("t_slot") - F.col("ts") <= limit)
    last = F.max_by(F.struct(F.col("ts").alias("ts_matched"), "y"), F.struct("ts", *tie)).alias("_last")
    served = served.groupBy("station_id", "t_slot").agg(last)
    if own_slot_only:
        joined = grid.join(served, ["station_id", "t_slot"], "left")
        return joined.select("station_id", "t_slot", "slot_label", "_last.*")
    reduced = served.withColumnRenamed("t_slot", "served_slot")
    matched = asof_join(grid, reduced, "station_id", "t_slot", "served_slot", bounded=True)
    fresh = F.when(F.col("t_slot") - F.col("_last.ts_matched") <= limit, F.col("_last"))
    return matched.select("station_id", "t_slot", "slot_label", fresh.alias("_last")).select(
        "station_id", "t_slot", "slot_label", "_last.*"
    )


def feature_names(max_lag: int, widths: Sequence[int]) -> list[str]:
    return ["y_hist_at_cut", *[f"y_lag{k}" for k in range(1, max_lag + 1)], *[f"y_ma{w}" for w in widths], "y_diff1"]


def slot_features(
    targets: DataFrame,
    obs: DataFrame,
    slots: Sequence[str] = DEFAULT_SLOTS,
    lead_minutes: int = DEFAULT_LEAD_MINUTES,
    max_lag: int = 12,
    widths: Sequence[int] = (3, 6, 12),
    tie: Sequence[str] = (),
    max_age_minutes: float | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Features of each slot from the history up to slot minus its lead.

    Targets that all lie on the daily grid and have the given lead allow a large, dense feed to be reduced to the newest
    rows per slot before any shuffle. All other targets, and a small or sparse feed, go through plain windows. Both
    give the same answer wherever the first one is allowed. Targets without a lead or an origin get the default ones.
    """
    targets = with_default(with_default(targets, "lead_minutes", F.lit(lead_minutes)), "generated_from", F.lit(GENERATED_FROM))
    if _is_dense(obs, slots, max(max_lag + 1, *widths), target_rows) and _on_grid(targets, slots, lead_minutes):
        return slot_features_reduced(targets, obs, slots, lead_minutes, max_lag, widths, tie, max_age_minutes)
    return slot_features_any(targets, obs, max_lag, widths, tie, max_age_minutes)


def _on_grid(targets: DataFrame, slots: Sequence[str], lead_minutes: int) -> bool:
    """Whether every target lies on the daily grid and has the given lead."""
    marks = [MICROS_PER_MINUTE * minute_of_day(s) for s in slots]
    fits = F.pmod(micros(F.col("t_slot")), F.lit(MICROS_PER_DAY)).isin(marks) & (F.col("lead_minutes") == lead_minutes)
    return targets.where(~F.coalesce(fits, F.lit(False))).isEmpty()


def _is_dense(obs: DataFrame, slots: Sequence[str], depth: int, target_rows: int | None = None) -> bool:
    """Whether a table too large for one task holds more rows per station and slot than a slot can use."""
    rows = obs.count()
    if rows <= (TARGET_ROWS if target_rows is None else target_rows):
        return False
    stations, low, high = obs.agg(F.approx_count_distinct("station_id"), F.min("ts"), F.max("ts")).first()
    return rows > depth * stations * ((high - low).days + 1) * len(slots)


def slot_features_reduced(
    targets: DataFrame,
    obs: DataFrame,
    slots: Sequence[str] = DEFAULT_SLOTS,
    lead_minutes: int = DEFAULT_LEAD_MINUTES,
    max_lag: int = 12,
    widths: Sequence[int] = (3, 6, 12),
    tie: Sequence[str] = (),
    max_age_minutes: float | None = None,
) -> DataFrame:
    """Slot features from the newest rows per station and slot, which is all that can matter.

    Those rows are picked before the shuffle instead of computing windows over the whole feed; the
    as-of step then runs on that small table.
    """
    depth = max(max_lag + 1, *widths)
    at_cut = obs.withColumn("cut_slot", next_slot(F.col("ts"), slots, lead_minutes))
    newest = Window.partitionBy("station_id", "cut_slot").orderBy(F.desc("ts"), *[F.desc(c) for c in tie])
    kept = (
        at_cut.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= depth)
        .groupBy("station_id", "cut_slot")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rank")).alias("position"), "ts", "y"))).alias("_own"))
    )
    by_cut = Window.partitionBy("station_id").orderBy("cut_slot").rowsBetween(1 - depth, 0)
    history = kept.withColumn("_recent", F.flatten(F.collect_list("_own").over(by_cut))).select(
        "station_id", "cut_slot", F.slice("_recent", F.greatest(F.size("_recent") - depth + 1, F.lit(1)), depth).alias("_recent")
    )
    matched = asof_join(targets, history, "station_id", "t_slot", "cut_slot", bounded=True)
    if max_age_minutes is not None:
        fresh = add_minutes(F.col("t_slot"), -lead_minutes) - F.element_at("_recent", -1)["ts"] <= minutes(max_age_minutes)
        matched = matched.withColumn("_recent", F.when(fresh, F.col("_recent")))
    values = F.col("_recent.y")
    columns = {"y_hist_at_cut": _back(values, 0)}
    columns |= {f"y_lag{k}": _back(values, k) for k in range(1, max_lag + 1)}
    columns |= {f"y_ma{w}": _mean_of_last(values, w) for w in widths}
    columns["y_diff1"] = _back(values, 0) - _back(values, 1)
    return _finish(matched.withColumns(columns), max_lag, widths)


def slot_features_any(
    targets: DataFrame,
    obs: DataFrame,
    max_lag: int = 12,
    widths: Sequence[int] = (3, 6, 12),
    tie: Sequence[str] = (),
    max_age_minutes: float | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Slot features for any slot times and a lead per row: windows over the feed, then an as-of join at the cut."""
    history = add_slot_history(obs, "station_id", "ts", "y", max_lag, widths, tie, target_rows, copies=True)
    names = feature_names(max_lag, widths)
    history = history.withColumnRenamed("y", "y_hist_at_cut").select("station_id", "ts", *names, *tie)
    probes = targets.withColumn("t_cut", add_minutes(F.col("t_slot"), -F.col("lead_minutes")))
    matched = asof_join(probes, history, "station_id", "t_cut", "ts", tie, max_age_minutes, target_rows=target_rows, measure=obs)
    return _finish(matched, max_lag, widths)


def _back(values: Column, k: int) -> Column:
    """The value k rows before the newest, NULL before the first row."""
    return F.when(F.size(values) > k, F.get(values, F.size(values) - (k + 1)))


def _mean_of_last(values: Column, width: int) -> Column:
    last = F.slice(values, F.greatest(F.size(values) - width + 1, F.lit(1)), width)
    known = F.filter(last, lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(known) > 0, total / F.size(known))


def _finish(df: DataFrame, max_lag: int, widths: Sequence[int]) -> DataFrame:
    calendar = calendar_columns(F.col("t_slot"), with_month=False)
    front = ["station_id", "t_slot", "slot_label", "y", "lead_minutes", "generated_from"]
    return df.withColumns(calendar).select(*front, *feature_names(max_lag, widths), *calendar)
