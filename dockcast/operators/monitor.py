"""Data-quality and drift figures over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.timestamps import MICROS_PER_MINUTE, lit_ts, micros
from dockcast.operators.history import with_history
from dockcast.operators.segments import numeric_cuts, range_part
from dockcast.session import materialize

ONE_TASK_ROWS = 1_000_000
PART_ROWS = 500_000
MAX_PARTS = 4_096
MIN_SAMPLE = 100
SERIES_TERMS = 100

# fixed values: the expected feed of the time-profile check
EXPECTED_STEP_MINUTES = 1.0
EXPECTED_FIRST_HOUR = 8
EXPECTED_LAST_HOUR = 21
EXPECTED_DAYS = 18


def zero_share(df: DataFrame, key: str, y: str) -> DataFrame:
    """Share of rows per station whose value is zero; an unknown value counts as not zero."""
    return df.groupBy(key).agg(F.avg(F.when(F.col(y) == 0, 1.0).otherwise(0.0)).alias("p_zero"))


def sequence_cuts(values: DataFrame, column: str, rows: int) -> list[float]:
    """Cut points that let a global sequence be worked on in parts; none while it fits one task."""
    if rows <= ONE_TASK_ROWS:
        return []
    return numeric_cuts(values, column, min(MAX_PARTS, rows // PART_ROWS + 1))


def running_total(values: DataFrame, order: str, sums: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """Inclusive running sums over a global order: sums inside each part plus the totals of earlier parts."""
    parted = values.withColumn("_part", range_part([F.lit(c) for c in cuts], F.col(order)))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = parted.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in sums})
    if not cuts:
        return out.drop("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parted.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums])
    joined = out.join(F.broadcast(offsets), "_part")
    return joined.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_o_{c}") for c in sums}).drop(
        "_part", *[f"_o_{c}" for c in sums]
    )


def interarrival_counts(df: DataFrame, ts: str) -> DataFrame:
    """How often each rounded gap in minutes occurs in the sequence of all rows by time.

    A long sequence is cut into ranges of equal size by a quantile sketch and put in order range by
    range, with the last time of the previous range as the first predecessor. Copies of a time, which no cut
    separates, are merged before the shuffle if they fill a range; each gives a gap of 0.
    """
    known = df.where(F.col(ts).isNotNull()).select(F.col(ts).alias("t"))
    rows, cuts, piles = known.count(), [], False
    if rows > ONE_TASK_ROWS:
        parts = min(MAX_PARTS, rows // PART_ROWS + 1)
        found = known.agg(F.percentile_approx("t", [i / parts for i in range(1, parts)], max(10_000, 4 * parts))).first()[0]
        cuts = sorted(set(found))
        piles = len(cuts) < len(found)
    times = known.groupBy("t").agg(F.count(F.lit(1)).alias("copies")) if piles else known.withColumn("copies", F.lit(1).cast("bigint"))
    parted = times.withColumn("_part", range_part([lit_ts(c) for c in cuts], F.col("t")))
    gaps = parted.withColumn("_previous", F.lag("t").over(Window.partitionBy("_part").orderBy("t")))
    if cuts:
        edges = parted.groupBy("_part").agg(F.max("t").alias("_max"))
        edges = edges.select("_part", F.lag("_max").over(Window.orderBy("_part")).alias("_edge"))
        gaps = gaps.join(F.broadcast(edges), "_part").withColumn("_previous", F.coalesce("_previous", "_edge"))
    gap = F.bround((micros(F.col("t")) - micros(F.col("_previous"))) / F.lit(float(MICROS_PER_MINUTE)), 0)
    counts = gaps.groupBy(gap.alias("minutes")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("copies") - 1).alias("repeats"))
    pairs = F.array(F.struct("minutes", "n"), F.struct(F.lit(0.0).alias("minutes"), F.col("repeats").alias("n")))
    exploded = counts.select(F.inline(pairs)).where(F.col("minutes").isNotNull() & (F.col("n") > 0))
    return exploded.groupBy("minutes").agg(F.sum("n").alias("n"))


def interarrival_mode(df: DataFrame, ts: str) -> DataFrame:
    """The most frequent gap over all stations; the smallest on a tie."""
    best = F.max_by("minutes", F.struct("n", -F.col("minutes")))
    return interarrival_counts(df, ts).agg(best.alias("freq_minutes_mode"))


def interarrival_mode_per_station(df: DataFrame, key: str, ts: str, tie: Sequence[str], target_rows: int | None = None) -> DataFrame:
    """The most frequent gap inside single stations, which is what a feed's frequency means."""

    def add(d, w):
        return d.withColumn("_gap", micros(F.col(ts)) - micros(F.lag(ts).over(w)))

    gaps = with_history(df.select(key, ts, *tie), key, ts, [ts], 1, add, tie, target_rows)
    minutes = F.bround(F.col("_gap") / F.lit(float(MICROS_PER_MINUTE)), 0).alias("minutes")
    counts = gaps.where(F.col("_gap").isNotNull()).groupBy(minutes).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by("minutes", F.struct("n", -F.col("minutes"))).alias("freq_minutes_mode"))


def hours_coverage(df: DataFrame, ts: str) -> DataFrame:
    """Number of days, and the median over days of the first and of the last observed hour."""
    return _per_day(df, ts).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.median(F.hour("low")).alias("hours_min"),
        F.median(F.hour("high")).alias("hours_max"),
    )


def _per_day(df: DataFrame, ts: str) -> DataFrame:
    known = df.where(F.col(ts).isNotNull())
    return known.groupBy(F.to_date(ts).alias("day")).agg(F.min(ts).alias("low"), F.max(ts).alias("high"))


def time_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows, days, usual gap and usual hours, with a flag per expectation that the feed misses; one row."""
    figures = ["n_rows", "n_days", "hours_min", "hours_max", "freq_minutes_mode"]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")), hours_coverage(df, ts), interarrival_mode(df, ts)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    profile = rows.agg(*[F.max(c).alias(c) for c in figures])
    mode = F.col("freq_minutes_mode")
    return profile.withColumns(
        {
            "warn_step": F.coalesce(F.abs(mode - EXPECTED_STEP_MINUTES) > 0.1, F.lit(False)),
            "warn_first_hour": F.coalesce(F.col("hours_min") > EXPECTED_FIRST_HOUR, F.lit(False)),
            "warn_last_hour": F.coalesce(F.col("hours_max") < EXPECTED_LAST_HOUR, F.lit(False)),
            "warn_days": (F.col("n_days") > 0) & (F.col("n_days") < EXPECTED_DAYS),
        }
    )


def drift_windows(ts: Column, first_cut: datetime, last_cut: datetime) -> tuple[Column, Column]:
    """Early rows up to the first validation end, late rows from there to the last one."""
    return ts <= lit_ts(first_cut), (ts > lit_ts(first_cut)) & (ts <= lit_ts(last_cut))


def ks_drift(df: DataFrame, ts: str, feature: str, first_cut: datetime, last_cut: datetime) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of a feature, early against late, with the asymptotic p-value.

    Rows are first counted per distinct value; the distribution functions are running sums over those.
    Empty unless both samples have more than 100 values.
    """
    early, late = drift_windows(F.col(ts), first_cut, last_cut)
    known = df.where(F.col(feature).isNotNull() & (early | late))
    values = materialize(
        known.groupBy(F.col(feature).cast("double").alias("v")).agg(F.count_if(early).alias("a"), F.count_if(late).alias("b")),
        "values",
    )
    running = running_total(values, "v", ["a", "b"], sequence_cuts(values, "v", values.count()))
    n1, n2 = (n or 0 for n in values.agg(F.sum("a"), F.sum("b")).first())
    distance = F.abs(F.col("cum_a") / F.lit(float(n1 or 1)) - F.col("cum_b") / F.lit(float(n2 or 1)))
    stat = running.agg(F.max(distance).alias("ks_stat"))
    sizes = [F.lit(n).cast("bigint").alias(name) for n, name in ((n1, "n_early"), (n2, "n_late"))]
    report = stat.select(F.lit(feature).alias("feature"), *sizes, "ks_stat")
    report = report.withColumn("pvalue", ks_pvalue(F.col("ks_stat"), F.col("n_early"), F.col("n_late")))
    return report.where((F.col("n_early") > MIN_SAMPLE) & (F.col("n_late") > MIN_SAMPLE))


def ks_pvalue(stat: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value: 2 * sum of (-1)^(k-1) * exp(-2 k^2 lambda^2), held in [0, 1]."""
    lam2 = stat * stat * F.try_divide(n1.cast("double") * n2.cast("double"), n1 + n2)
    terms = F.sequence(F.lit(1), F.lit(SERIES_TERMS))
    total = F.aggregate(
        terms,
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * lam2),
    )
    return F.when((lam2 < 0.04) | lam2.isNull(), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


def monitoring(df: DataFrame, key: str, ts: str, y: str, feature: str, first_cut: datetime, last_cut: datetime) -> DataFrame:
    """Zero share per station and drift of one feature as one long table."""
    zeros = zero_share(df, key, y).select(
        F.lit("zero_share").alias("check"), F.col(key).cast("string").alias("subject"), F.col("p_zero").alias("value"), F.lit(None).cast("double").alias("pvalue")
    )
    drift = ks_drift(df, ts, feature, first_cut, last_cut).select(
        F.lit("ks_drift").alias("check"), F.col("feature").alias("subject"), F.col("ks_stat").alias("value"), "pvalue"
    )
    return zeros.unionByName(drift)
