"""Backward as-of join: each left row gets the last right row at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.timestamps import minutes
from dockcast.operators.segments import CUTS, SEGMENT, Segments, plan_segments

_AT, _PROBE, _LEFT, _MATCH, _TIES = "_at", "_probe", "_left", "_match", "_ties"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_on: str,
    right_on: str,
    tie: Sequence[str] = (),
    tolerance_minutes: float | None = None,
    bounded: bool = False,
    target_rows: int | None = None,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Left rows with the right side's columns of the last right row whose time is at or before theirs.

    Equal times match. Among right rows with one key and time the last in tie order wins, even if its
    values are NULL. A match older than the tolerance (inclusive) becomes NULL. Both sides are unioned
    and shuffled once; there is no range join and no pair blow-up. `bounded` promises that a key has
    few enough rows for one task on both sides; otherwise large keys are measured and cut, on
    `measure` if given: a cheaper table with the right side's keys and times.
    """
    payload = [c for c in right.columns if c != key]
    probes = left.select(
        key,
        F.col(left_on).alias(_AT),
        F.lit(1).alias(_PROBE),
        F.struct(*[c for c in left.columns if c != key]).alias(_LEFT),
    )
    observed = right.where(F.col(right_on).isNotNull()).select(
        key,
        F.col(right_on).alias(_AT),
        F.lit(0).alias(_PROBE),
        F.struct(*(tie or [right_on])).alias(_TIES),
        F.struct(*payload).alias(_MATCH),
    )
    segments = Segments(key, _AT)
    if not bounded:
        times = observed.select(key, _AT) if measure is None else measure.select(key, F.col(right_on).alias(_AT))
        segments = plan_segments(times.unionByName(probes.select(key, _AT)), key, _AT, target_rows)
        if segments.heavy_ties:
            observed = _last_of_copies(observed, key)

    rows = observed.unionByName(probes, allowMissingColumns=True)
    if segments.active:
        rows = segments.tag(rows)
        rows = rows.unionByName(_carried(segments.tag(observed), segments), allowMissingColumns=True)
    order = [F.col(_AT), F.col(_PROBE), F.col(_TIES)]
    history = segments.window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = rows.withColumn(_MATCH, F.last(_MATCH, ignorenulls=True).over(history)).where(F.col(_PROBE) == 1)
    if tolerance_minutes is not None:
        fresh = F.col(_AT) - F.col(f"{_MATCH}.{right_on}") <= minutes(tolerance_minutes)
        matched = matched.withColumn(_MATCH, F.when(fresh, F.col(_MATCH)))
    return matched.select(key, f"{_LEFT}.*", *[F.col(f"{_MATCH}.{c}").alias(c) for c in payload])


def _last_of_copies(observed: DataFrame, key: str) -> DataFrame:
    """One observation per key and time, merged before the shuffle."""
    last = F.max_by(F.struct(_TIES, _MATCH), F.col(_TIES)).alias("_row")
    return observed.groupBy(key, _AT, _PROBE).agg(last).select(key, _AT, _PROBE, "_row.*")


def _carried(tagged: DataFrame, segments: Segments) -> DataFrame:
    """For every segment of a cut key, the last observation of the segments before it."""
    key = segments.key
    last = F.max_by(F.struct(_AT, _PROBE, _TIES, _MATCH), F.struct(_AT, _TIES)).alias("_row")
    own = tagged.join(F.broadcast(segments.cuts.select(key)), key, "left_semi").groupBy(key, SEGMENT).agg(last)
    every = segments.cuts.select(key, F.explode(F.sequence(F.lit(0), F.size(CUTS))).alias(SEGMENT))
    earlier = Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(own, [key, SEGMENT], "left").withColumn("_row", F.last("_row", ignorenulls=True).over(earlier))
    return carried.where(F.col("_row").isNotNull()).select(key, SEGMENT, "_row.*")
