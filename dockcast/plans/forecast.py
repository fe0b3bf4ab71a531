"""Forecasts for all stations at once: one column step per horizon, never a loop over stations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.calendar import calendar_of, cyclic
from dockcast.functions.timestamps import lit_ts
from dockcast.functions.values import clip
from dockcast.operators.encoding import numeric_columns
from dockcast.operators.history import latest_per_key
from dockcast.operators.quantiles import grouped_quantiles
from dockcast.operators.contracts import ContractError

# fixed values: horizons in steps, and the step, of the original job
DEFAULT_HORIZONS = (1, 3, 6, 12)
DEFAULT_STEP_MINUTES = 60
LAGS = ("y_lag1", "y_lag2", "y_ma3")

Scorer = Callable[[DataFrame, Mapping[str, Column], str], DataFrame]


def require_features(wanted: Iterable[str], known: Mapping[str, Column]) -> None:
    missing = sorted(set(wanted) - set(known))
    if missing:
        raise ContractError(f"the rows lack features of the model: {missing}")


@dataclass(frozen=True)
class LinearScore:
    """A model that is a weighted sum; scores inside the projection. A feature that the row does not have is an error, a NULL counts as 0."""

    weights: Mapping[str, float]
    intercept: float = 0.0

    def __call__(self, df: DataFrame, features: Mapping[str, Column], output: str) -> DataFrame:
        require_features(self.weights, features)
        total = F.lit(self.intercept)
        for name, weight in self.weights.items():
            total = total + F.lit(weight) * F.coalesce(features[name], F.lit(0.0))
        return df.withColumn(output, total)


def resolve_asof(df: DataFrame, ts: str, asof: str | datetime = "now", zone: str = "UTC") -> datetime:
    """'now' is the newest time in the table; a time with an offset becomes the wall clock of `zone`."""
    if isinstance(asof, datetime):
        return asof.astimezone(ZoneInfo(zone)).replace(tzinfo=None) if asof.tzinfo else asof
    if asof.lower() == "now":
        newest = df.agg(F.max(ts)).first()[0]
        if newest is None:
            raise ContractError("the table has no times")
        return newest
    return resolve_asof(df, ts, datetime.fromisoformat(asof), zone)


def latest_at(df: DataFrame, ts: str, asof: datetime, key: str = "station_id", tie: Sequence[str] = ()) -> DataFrame:
    """Last row per station at or before the as-of time."""
    return latest_per_key(df.where(F.col(ts) <= lit_ts(asof)), key, [ts, *tie])


def recursive_forecast(
    latest: DataFrame,
    score: Scorer,
    asof: datetime,
    horizons: Sequence[int] = DEFAULT_HORIZONS,
    step_minutes: int = DEFAULT_STEP_MINUTES,
    key: str = "station_id",
    y: str = "num_bikes_available",
    capacity: str | None = None,
    shift_in_current: bool = False,
    interval: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None,
) -> DataFrame:
    """station_id, timestamp_pred, h, yhat, yhat_lo, yhat_hi for every horizon.

    Each horizon is scored from the lags left by the one before it; lags move once per listed horizon.
    The first step uses the latest row's own lags, unless `shift_in_current` moves the newest observation
    in first. Every other numeric column of the latest row (encode it first if it holds text) is a feature that stays as it is;
    the calendar is that of the forecast time. Stations without full lags are left out. Values are held in [0, capacity] only if a capacity
    column is given. All horizons are columns of the same row until one explode at the end.
    """
    if step_minutes <= 0 or not horizons:
        raise ValueError("step_minutes must be positive and horizons not empty")
    state = latest.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in LAGS)))
    lag1, lag2, mean3 = (F.col(c).cast("double") for c in LAGS)
    if shift_in_current:
        lag1, lag2, mean3 = F.col(y), lag1, (F.col(y) + lag1 + lag2) / 3
    state = state.withColumns({"_lag1": lag1, "_lag2": lag2, "_mean3": mean3})
    steps = sorted(set(horizons))
    ends = {h: asof + timedelta(minutes=step_minutes * h) for h in steps}
    for h in steps:
        features = {c: F.col(c).cast("double") for c in numeric_columns(latest)}
        features |= {"y_lag1": F.col("_lag1"), "y_lag2": F.col("_lag2"), "y_ma3": F.col("_mean3")}
        features |= {name: F.lit(float(v)) for name, v in calendar_of(ends[h]).items()}
        state = score(state, features, f"_raw{h}")
        state = state.withColumn(f"_yhat{h}", _held(F.col(f"_raw{h}"), capacity))
        new = F.col(f"_yhat{h}")
        state = state.withColumns({"_lag1": new, "_lag2": F.col("_lag1"), "_mean3": (new + F.col("_lag1") + F.col("_lag2")) / 3})
    # the bounds feed nothing, so all horizons' bounds are worked out in one step at the end
    if interval:
        state = interval(state, [f"_raw{h}" for h in steps])
    nothing = F.lit(None).cast("double")
    bounds = {h: (F.col(f"_lo_raw{h}"), F.col(f"_hi_raw{h}")) if interval else (nothing, nothing) for h in steps}
    cells = [
        F.struct(
            lit_ts(ends[h]).alias("timestamp_pred"),
            F.lit(h).alias("h"),
            F.col(f"_yhat{h}").alias("yhat"),
            _held(bounds[h][0], capacity).alias("yhat_lo"),
            _held(bounds[h][1], capacity).alias("yhat_hi"),
        )
        for h in steps
    ]
    return state.select(key, F.inline(F.array(*cells)))


def _held(value: Column, capacity: str | None) -> Column:
    """Within [0, capacity] where a capacity is known."""
    if capacity is None:
        return value
    limit = F.col(capacity).cast("double")
    return F.when(limit.isNotNull(), clip(value, 0.0, limit)).otherwise(value)


def oneshot_forecast(
    latest: DataFrame,
    score: Scorer,
    asof: datetime,
    features: Sequence[str],
    horizons: Sequence[int] = DEFAULT_HORIZONS,
    step_minutes: int = DEFAULT_STEP_MINUTES,
    key: str = "station_id",
) -> DataFrame:
    """The same features for every horizon, scored once per station and repeated; never negative."""
    known = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in latest.columns else F.lit(0.0) for c in features}
    scored = score(latest, known, "yhat").withColumn("yhat", clip(F.col("yhat"), 0.0))
    cells = [
        F.struct(lit_ts(asof + timedelta(minutes=step_minutes * h)).alias("timestamp_pred"), F.lit(h).alias("h")) for h in horizons
    ]
    return scored.select(key, F.inline(F.array(*cells)), "yhat")


def future_frame(df: DataFrame, ts: str, horizons: Sequence[int] = DEFAULT_HORIZONS) -> DataFrame:
    """Every row once per horizon in hours, with the calendar moved to the forecast time. A row-local explode."""
    rows = df.withColumn("h", F.explode(F.array(*[F.lit(h) for h in horizons])))
    rows = rows.withColumn("timestamp_pred", F.col(ts) + F.make_dt_interval(F.lit(0), F.col("h")))
    hour = F.pmod(F.col("hour") + F.col("h"), F.lit(24))
    dow = F.weekday("timestamp_pred")
    return rows.withColumns(
        {"hour": hour, "dow": dow, "month": F.month("timestamp_pred"), "is_weekend": dow.isin(5, 6).cast("int"), **cyclic(hour)}
    )


def horizon_summary(forecast: DataFrame) -> DataFrame:
    """Mean, minimum and maximum per horizon, to two decimals."""
    return forecast.groupBy("h").agg(
        *[F.bround(f("yhat"), 2).alias(name) for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    )


def horizon_describe(forecast: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, quartiles and range per horizon."""
    rest = forecast.groupBy("h").agg(
        F.count("yhat").alias("count"),
        F.avg("yhat").alias("mean"),
        F.stddev_samp("yhat").alias("std"),
        F.min("yhat").alias("min"),
        F.max("yhat").alias("max"),
    )
    quartiles = grouped_quantiles(forecast, "h", "yhat", (0.25, 0.5, 0.75), ("p25", "p50", "p75"))
    return rest.join(quartiles, "h").select("h", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def horizon_invariance(forecast: DataFrame) -> DataFrame:
    """Whether every horizon has the same mean forecast, which points to features that do not move."""
    means = forecast.groupBy("h").agg(F.avg("yhat").alias("mean"))
    return means.agg(F.count(F.lit(1)).alias("n_horizons"), F.count_distinct("mean").alias("n_means")).withColumn(
        "looks_equal", (F.col("n_horizons") > 1) & (F.col("n_means") <= 1)
    )
