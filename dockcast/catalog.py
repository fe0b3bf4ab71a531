"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions import display, geo, timestamps, values
from dockcast.functions.calendar import CALENDAR_COLUMNS, calendar_columns
from dockcast.operators import contracts, encoding, history, leaderboard, monitor, nearby, slots, spatial, split
from dockcast.operators.asof import asof_join
from dockcast.operators.metrics import metrics_by, persistence, rounded
from dockcast.plans import backtest, forecast, health, ledger, serving, training
from dockcast.plans import slots as slot_plans
from dockcast.plans.features import model_ready, publish_ready, publish_split
from dockcast.session import materialize, scratch_path, shared_dir
from dockcast.sources import io
from dockcast.sources.adapters import stations, status, status_hourly, table

Y, TS, KEY, TIE = "num_bikes_available", "ts_local", "station_id", ["event_id"]
LAG_FEATURES = ["y_lag1", "y_lag2", "y_ma3"]
FEATURES = [*CALENDAR_COLUMNS, *LAG_FEATURES]
LINEAR = forecast.LinearScore({"y_lag1": 0.6, "y_lag2": 0.3, "y_ma3": 0.1})
LONG_TOLERANCE = 720
SHORT_TOLERANCE = 60
RADIUS_M = 800.0
CENTER = (-34.6037, -58.3816)
PATHS = {name: f"models/{name}/best_model" for name in ("click", "error", "purchase", "signup", "view")}
FOREST = {"numTrees": training.DEFAULT_TREES, "maxDepth": training.MAX_TREE_DEPTH}
BACKTEST_FOREST = {"numTrees": training.DEFAULT_TREES, "maxDepth": 8}
SEARCH_SECONDS = 30

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- shared tables


def ready(spark: SparkSession, folder: str) -> DataFrame:
    return model_ready(status_hourly(spark, folder), tie=TIE)


def stored_ready(spark: SparkSession, folder: str) -> DataFrame:
    """The training table as a file, as jobs that read it more than once should have it."""
    return materialize(ready(spark, folder), "ready")


def split_ready(spark: SparkSession, folder: str) -> DataFrame:
    return split.temporal_split(stored_ready(spark, folder), TS)


def folds_of(df: DataFrame):
    return split.fold_cuts(df, TS)


def obs(spark: SparkSession, folder: str) -> DataFrame:
    return slot_plans.observations(status(spark, folder), KEY, TS, Y, TIE)


def targets(spark: SparkSession, folder: str, tolerance: float = LONG_TOLERANCE) -> DataFrame:
    return slot_plans.slot_targets(obs(spark, folder), tolerance_minutes=tolerance, tie=TIE)


def features_of_slots(spark: SparkSession, folder: str) -> DataFrame:
    return slot_plans.slot_features(targets(spark, folder), obs(spark, folder), tie=TIE)


def latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Written once: the as-of time and the forecast both read it."""
    return materialize(history.latest_per_key(ready(spark, folder), KEY, [TS]), "latest")


def linear_forecast(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_rows(spark, folder)
    return forecast.recursive_forecast(latest, LINEAR, forecast.resolve_asof(latest, TS))


def next_hour(spark: SparkSession, folder: str) -> DataFrame:
    return linear_forecast(spark, folder).where("h = 1")


def served(spark: SparkSession, folder: str) -> DataFrame:
    return serving.serving_map(next_hour(spark, folder), stations(spark, folder))


def metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    scored = split_ready(spark, folder).withColumnRenamed("event_type", "framework")
    return metrics_by(scored, ["framework", "split"], Y, persistence()).drop("n_rows")


def board(spark: SparkSession, folder: str) -> DataFrame:
    return leaderboard.wide_board(metrics_long(spark, folder))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _text_times(spark: SparkSession, folder: str) -> DataFrame:
    """The feed with times as text, where error rows carry a word instead."""
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.date_format(TS, "yyyy-MM-dd HH:mm:ss"))
    return status(spark, folder).withColumn(TS, text)


def _zoned(c: str) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("-03:00")).try_cast("timestamp")


def _as_instants(rows: DataFrame) -> DataFrame:
    """The feed's wall clock read as three hours behind UTC."""
    return rows.withColumn(TS, F.concat(F.date_format(TS, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("-03:00")).try_cast("timestamp"))


# ---- scans and sinks


@query
def scan_status(spark: SparkSession, folder: str) -> DataFrame:
    return status(spark, folder).select(KEY, TS, Y)


@query
def load_stations(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "stations")
    io.write_table(stations(spark, folder).withColumn(KEY, F.col(KEY).cast("string")), f"{base}/raw")
    return rounded(io.load_stations(spark, [f"{base}/curated", f"{base}/raw"]), "lat", "lon")


def _write_slots(spark: SparkSession, folder: str) -> str:
    base = scratch_path(spark, "predictions")
    predicted = materialize(targets(spark, folder).select(KEY, "t_slot", "slot_label", F.col("y").alias("yhat")), "slots")
    for label in slots.DEFAULT_SLOTS:
        part = predicted.where(F.col("slot_label") == label).drop("slot_label")
        io.write_table(part, f"{base}/slots/{label.replace(':', '')}")
    return base


@query
def scan_glob_provenance(spark: SparkSession, folder: str) -> DataFrame:
    found = io.scan_glob(spark, f"{_write_slots(spark, folder)}/slots/*")
    label = values.slot_from_path(F.col("source_file")).alias("slot_label")
    return found.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"), F.count("yhat").alias("n_known"))


@query
def load_predictions(spark: SparkSession, folder: str) -> DataFrame:
    base = _write_slots(spark, folder)
    return io.load_predictions(spark, f"{base}/slots/*", f"{base}/horizon").select(KEY, "t_slot", "slot_label", "yhat")


@query
def slot_from_path(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("predictions/slots/"), values.slot_folder(F.col("slot_label")), F.lit("/predictions.parquet"))
    return targets(spark, folder).select(KEY, "t_slot", values.slot_from_path(path).alias("slot_label"))


@query
def roundtrip_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "roundtrip")
    io.write_table(status(spark, folder), path, ["event_type"], [KEY, TS])
    return spark.read.parquet(path).select(KEY, TS, Y, "event_id", "event_type", "props")


@query
def roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = ready(spark, folder).select(KEY, TS, Y, "hour", "y_lag1", "y_lag2")
    io.write_csv(rows, path)
    return io.read_csv(spark, path, rows.schema)


@query
def metrics_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    rows = materialize(metrics_long(spark, folder), "metrics")
    for run in ("first", "second"):
        io.append_metrics(rows, path, run)
    return rounded(spark.read.parquet(path).drop("run_ts"), "rmse", "mae", "r2")


@query
def publish_latest(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "published")
    latest = latest_rows(spark, folder)
    asof = forecast.resolve_asof(latest, TS)
    for step in (30, 60):
        io.publish(forecast.recursive_forecast(latest, LINEAR, asof, step_minutes=step), base, asof, step)
    return rounded(io.read_latest(spark, base).select(KEY, "timestamp_pred", "h", "yhat"), "yhat")


@query
def newest_file(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches are written one after the other; the newest file tells which one is read."""
    base = scratch_path(spark, "batches")
    for name in ("click", "view"):
        io.write_table(status(spark, folder).where(F.col("event_type") == name), f"{base}/batch={name}")
    batch = io.newest_file(spark, base).rsplit("batch=", 1)[1].split("/")[0]
    read = spark.read.parquet(base).where(F.col("batch") == batch)
    return read.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"), F.max(TS).alias("last_ts"))


@query
def gated_split(spark: SparkSession, folder: str) -> DataFrame:
    """Training table and split, each published by a write that counts its own gate."""
    base, asof = scratch_path(spark, "gated"), datetime(2024, 1, 1)
    publish_ready(ready(spark, folder), f"{base}/ready", asof, 60)
    publish_split(io.read_latest(spark, f"{base}/ready"), f"{base}/split", asof, 60)
    return split.split_report(io.read_latest(spark, f"{base}/split"), TS)


@query
def champion_manifest(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    winner = leaderboard.choose_best(leaderboard.fill_model_paths(board(spark, folder), PATHS))
    io.write_manifest(leaderboard.champion_manifest(winner, "val_rmse", "availability_champion", "Production", "models/champion"), path)
    return spark.read.json(path)


# ---- typing and contracts


@query
def parse_ts_drop(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.parse_time(_text_times(spark, folder), TS).select("event_id", TS)


@query
def ts_contract(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.unparsed_count(_text_times(spark, folder), TS)


@query
def to_naive(spark: SparkSession, folder: str) -> DataFrame:
    zoned = _zoned(TS)
    return status(spark, folder).select(
        "event_id",
        timestamps.to_naive(zoned, "utc").alias("ts_utc"),
        timestamps.to_naive(zoned, "local", slots.DEFAULT_ZONE).alias("ts_wall"),
    )


@query
def ensure_tz(spark: SparkSession, folder: str) -> DataFrame:
    zone = slots.DEFAULT_ZONE
    return status(spark, folder).select(
        "event_id",
        timestamps.ensure_zone_instant(F.col(TS), zone, is_naive=True).alias("instant_utc"),
        timestamps.ensure_zone_wall_clock(_zoned(TS), zone, is_naive=False).alias("wall_clock"),
    )


@query
def normalize_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder).select("event_id", F.col(KEY).cast("string").alias("digits"), F.col("event_type").alias("words"))
    return contracts.normalize_id(contracts.normalize_id(rows, "digits"), "words")


@query
def to_numeric(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col(Y).cast("string"), F.lit(" "))
    return status(spark, folder).select(
        "event_id", values.to_numeric(padded).alias("from_text"), values.to_numeric(F.col("event_type")).alias("from_word")
    )


@query
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder).select(F.nullif(F.col(KEY), F.lit(0)).alias(KEY), TS, (F.col(Y) - 50).alias(Y))
    return contracts.contract_report(rows, KEY, TS, Y)


@query
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder)
    return rows.select(KEY, TS, Y).unionByName(rows.select(KEY, "event_type", TS), allowMissingColumns=True)


@query
def string_norm(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("props")
    return status(spark, folder).select(
        "event_id",
        F.lower(F.trim(text)).alias("norm"),
        text.startswith("{").alias("opens"),
        text.endswith("}").alias("closes"),
        text.contains("k").alias("has_k"),
        F.split(text, ":")[0].alias("head"),
    )


@query
def sanitize(spark: SparkSession, folder: str) -> DataFrame:
    return status(spark, folder).select("event_id", values.sanitize(F.col("props")).alias("safe"))


@query
def clip(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.col(Y) - 20
    columns = rounded(
        status(spark, folder).select(
            "event_id", values.clip(shifted, 0.0).alias("low"), values.clip(shifted, 0.0, 50.0).alias("both")
        ),
        "low",
        "both",
    )
    return columns


@query
def add_minutes(spark: SparkSession, folder: str) -> DataFrame:
    return status(spark, folder).select(
        "event_id",
        timestamps.add_minutes(F.col(TS), 60).alias("plus_hour"),
        timestamps.add_minutes(F.col(TS), -F.col(KEY)).alias("minus_id"),
    )


@query
def days_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return status(spark, folder).groupBy(KEY).agg(F.count_distinct(F.to_date(TS)).alias("n_days"))


@query
def calendar(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder).select("event_id", *[c.alias(n) for n, c in calendar_columns(F.col(TS)).items()])
    return rounded(rows, "hour_sin", "hour_cos")


# ---- history


@query
def dedup_pk(spark: SparkSession, folder: str) -> DataFrame:
    return history.dedup_pk(status_hourly(spark, folder), KEY, TS, TIE).select(KEY, TS, Y, "event_id")


@query
def lags(spark: SparkSession, folder: str) -> DataFrame:
    return history.add_lags(status_hourly(spark, folder), KEY, TS, Y, 2, TIE).select(KEY, TS, Y, "y_lag1", "y_lag2")


@query
def lags_n(spark: SparkSession, folder: str) -> DataFrame:
    out = history.add_lags(status_hourly(spark, folder), KEY, TS, Y, 12, TIE)
    return out.select(KEY, TS, *[f"y_lag{k}" for k in range(1, 13)])


@query
def rolling_means(spark: SparkSession, folder: str) -> DataFrame:
    out = history.add_slot_history(status_hourly(spark, folder), KEY, TS, Y, 1, tie=TIE)
    return rounded(out.select(KEY, TS, "y_ma3", "y_ma6", "y_ma12", "y_diff1"), "y_ma3", "y_ma6", "y_ma12", "y_diff1")


@query
def model_ready_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ready(spark, folder).drop("props", "event_type"), "hour_sin", "hour_cos", "y_ma3")


_QUERIES["model_ready"] = _QUERIES.pop("model_ready_table")


@query
def latest_per_station(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder)
    asof = forecast.resolve_asof(rows, TS)
    return forecast.latest_at(rows, TS, asof, tie=TIE).select(KEY, TS, Y, "event_id")


@query
def resolve_asof(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder)
    asof = forecast.resolve_asof(rows, TS)
    return rows.where(F.col(TS) <= timestamps.lit_ts(asof)).agg(F.max(TS).alias("asof"), F.count(F.lit(1)).alias("n_rows"))


# ---- encoding


@query
def json_like_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.json_like_ratio(status(spark, folder), ["event_type", "props"])


@query
def json_expand(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder)
    cells = encoding.json_values("props", encoding.json_keys(rows, "props"))
    return rows.select("event_id", *[c.alias(n) for n, c in cells.items()])


@query
def onehot(spark: SparkSession, folder: str) -> DataFrame:
    rows = status(spark, folder)
    found = encoding.categories(rows, ["event_type", "props"])
    cells = {n: c for column, names in found.items() if column != "props" for n, c in encoding.onehot_columns(column, names).items()}
    return rows.select("event_id", *[c.alias(n) for n, c in cells.items()])


@query
def model_ready_zoned(spark: SparkSession, folder: str) -> DataFrame:
    """Instants become the UTC wall clock in any session zone."""
    out = model_ready(_as_instants(status_hourly(spark, folder)), tie=TIE)
    return rounded(out.select(KEY, TS, Y, "hour", "dow", "y_lag1", "y_lag2", "y_ma3"), "y_ma3")


@query
def numeric_features(spark: SparkSession, folder: str) -> DataFrame:
    out = encoding.numeric_features(ready(spark, folder), [KEY, TS, Y])
    return rounded(out, "hour_sin", "hour_cos", "y_ma3")


@query
def make_xy(spark: SparkSession, folder: str) -> DataFrame:
    rows = ready(spark, folder).drop("event_id")
    learnt = encoding.learn_encoding(status_hourly(spark, folder), [KEY, TS, Y, "event_id"])
    learnt = encoding.Encoding(learnt.json, learnt.onehot, [*learnt.numeric, *FEATURES])
    return rounded(encoding.encode(rows, learnt, [KEY, TS, Y]), "hour_sin", "hour_cos", "y_ma3")


@query
def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.align_schema(ready(spark, folder), ["y_lag2", "absent", "hour", "y_lag1"], [KEY, TS])


@query
def screen_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features_of_slots(spark, folder)
    names = [c for c in encoding.numeric_columns(rows) if c not in training.SLOT_NON_FEATURES]
    return rounded(encoding.screen_features(rows, names), "known_share", "variance", digits=4)


@query
def leak_guard(spark: SparkSession, folder: str) -> DataFrame:
    rows = ready(spark, folder).withColumns(
        {"twin": F.col(Y), "constant": F.lit(7.0), "scaled": F.col(Y) * 3 + 1, "Num_Bikes_Available_x": F.col("y_lag1")}
    )
    return encoding.leak_guard(rows, Y, [*FEATURES, "twin", "constant", "scaled", "Num_Bikes_Available_x"])


@query
def feature_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.feature_cardinality(ready(spark, folder), ["hour", "dow", "month", "is_weekend", "y_lag1", "y_lag2"])


# ---- splits and metrics


@query
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_ready(spark, folder).select(KEY, TS, "split")


@query
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_report(split_ready(spark, folder), TS)


@query
def reg_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics_by(split_ready(spark, folder), ["split"], Y, F.col("y_ma3")), "rmse", "mae", "r2")


@query
def reg_metrics_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts that are missing for one hour of the day count nowhere but in the rows."""
    yhat = F.when(F.col("hour") != 5, F.col("y_ma3"))
    return rounded(metrics_by(split_ready(spark, folder), ["split"], Y, yhat), "rmse", "mae", "r2")


@query
def baseline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics_by(split_ready(spark, folder), ["split"], Y, persistence()), "rmse", "mae", "r2")


@query
def backtest_folds(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    return backtest.fold_report(split.label_folds(rows, TS, folds_of(rows)))


@query
def backtest_persistence(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    return rounded(backtest.persistence_backtest(rows, TS, Y, folds_of(rows)), "rmse", "mae", "r2")


@query
def backtest_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    scored = split.label_folds(rows, TS, folds_of(rows)).where("part = 'val'")
    return backtest.sample_per_fold(scored, [KEY, TS]).select(
        "fold", KEY, TS, F.col(Y).alias("y_true"), persistence().alias("y_pred")
    )


@query
def error_by_hour_h(spark: SparkSession, folder: str) -> DataFrame:
    rows = ready(spark, folder)
    future = LINEAR(forecast.future_frame(rows, TS), {c: F.col(c) for c in LAG_FEATURES}, "yhat")
    actual = rows.select(KEY, F.col(TS).alias("timestamp_pred"), F.col(Y).alias("y_true"))
    scored = future.select(KEY, "timestamp_pred", "h", "hour", "yhat").join(actual, [KEY, "timestamp_pred"])
    report = backtest.error_report(scored, ["hour", "h"], F.col("y_true"), F.col("yhat"))
    return rounded(report, "rmse", "mae", "r2", "mape", digits=4)


@query
def holdout_month(spark: SparkSession, folder: str) -> DataFrame:
    months = metrics_by(ready(spark, folder).withColumn("month_of", F.date_format(TS, "yyyy-MM")), ["month_of"], Y, persistence())
    return rounded(months.orderBy(F.desc("month_of")).limit(1), "rmse", "mae", "r2")


@query
def spatial_split(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.spatial_split(stations(spark, folder).select(KEY, "lat", "lon")).select(KEY, "block", "part")


@query
def spatial_holdout(spark: SparkSession, folder: str) -> DataFrame:
    out = spatial.spatial_holdout(ready(spark, folder), stations(spark, folder), Y, ["dow", "hour"])
    return rounded(out, "rmse", "mae", "r2")


# ---- slots and as-of joins


@query
def slot_grid(spark: SparkSession, folder: str) -> DataFrame:
    return slots.slot_grid(obs(spark, folder), KEY, "ts")


@query
def slot_exact(spark: SparkSession, folder: str) -> DataFrame:
    hourly = slot_plans.observations(status_hourly(spark, folder), KEY, TS, Y, TIE)
    return slot_plans.slot_targets(hourly, how="exact").select(KEY, "t_slot", "slot_label", "y", "ts_matched")


@query
def asof_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    rows = obs(spark, folder)
    matched = asof_join(slots.slot_grid(rows, KEY, "ts"), rows, KEY, "t_slot", "ts", TIE, LONG_TOLERANCE)
    return matched.select(KEY, "t_slot", "slot_label", "y", "ts")


@query
def asof_lead(spark: SparkSession, folder: str) -> DataFrame:
    rows = obs(spark, folder)
    probes = slots.slot_grid(rows, KEY, "ts").withColumn("t_cut", timestamps.add_minutes(F.col("t_slot"), -slots.DEFAULT_LEAD_MINUTES))
    return asof_join(probes, rows, KEY, "t_cut", "ts", TIE).select(KEY, "t_slot", "slot_label", "y", "ts")


@query
def slot_targets(spark: SparkSession, folder: str) -> DataFrame:
    return targets(spark, folder)


@query
def slot_targets_short(spark: SparkSession, folder: str) -> DataFrame:
    return targets(spark, folder, SHORT_TOLERANCE)


@query
def slot_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features_of_slots(spark, folder), "y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour_sin", "hour_cos")


@query
def slot_features_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """The plan of a large, dense feed on this one: same answer."""
    out = slot_plans.slot_features_reduced(targets(spark, folder), obs(spark, folder), tie=TIE)
    return rounded(out, "y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour_sin", "hour_cos")


@query
def slot_features_lead(spark: SparkSession, folder: str) -> DataFrame:
    """Targets with a lead of their own; the plan must follow the targets, not the default."""
    wide = materialize(targets(spark, folder).withColumn("lead_minutes", F.lit(240)), "targets")
    out = slot_plans.slot_features(wide, obs(spark, folder), tie=TIE, target_rows=0)
    return rounded(out, "y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour_sin", "hour_cos")


@query
def slot_targets_zoned(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as instants; slots are wall clock of their zone."""
    zoned = slot_plans.observations(_as_instants(status(spark, folder)), KEY, TS, Y, TIE, slots.DEFAULT_ZONE)
    return slot_plans.slot_targets(zoned, tolerance_minutes=LONG_TOLERANCE, tie=TIE)


@query
def slot_features_found(spark: SparkSession, folder: str) -> DataFrame:
    """A feed whose columns are found by name, and targets that state neither lead nor origin."""
    feed = status(spark, folder).select(KEY, TS, Y, "event_id")
    seen = slot_plans.observations(feed, tie=TIE)
    bare = slot_plans.slot_targets(seen, tolerance_minutes=LONG_TOLERANCE, tie=TIE).drop("lead_minutes", "generated_from")
    return rounded(slot_plans.slot_features(bare, seen, tie=TIE), "y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour_sin", "hour_cos")


@query
def slot_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two slots are written, one of them again with another forecast; both are read back by their partitions."""
    path, labels = scratch_path(spark, "slot_predictions"), ("09:00", "13:00")
    features = materialize(features_of_slots(spark, folder), "slot_features").where(F.col("slot_label").isin(*labels))
    forecasts = {c: features.select(KEY, "t_slot", "slot_label", F.coalesce(c, F.lit(0.0)).alias("yhat")) for c in ("y_lag1", "y_ma3")}
    io.write_slots(forecasts["y_lag1"], path)
    io.write_slots(forecasts["y_ma3"].where(F.col("slot_label") == labels[1]), path)
    return rounded(_union([io.read_slots(spark, path, s) for s in labels]), "yhat")


@query
def filter_slot(spark: SparkSession, folder: str) -> DataFrame:
    return targets(spark, folder).where((F.col("slot_label") == "09:00") & F.col("y").isNotNull()).select(KEY, "t_slot", "y")


@query
def slot_order(spark: SparkSession, folder: str) -> DataFrame:
    grid = slots.slot_grid(obs(spark, folder), KEY, "ts", (*slots.DEFAULT_SLOTS, "07:30"))
    counted = grid.groupBy("slot_label").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("position", slots.slot_order(F.col("slot_label")))


# ---- forecasts


@query
def forecast_recursive(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(linear_forecast(spark, folder).drop("yhat_lo", "yhat_hi"), "yhat")


@query
def forecast_clipped(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_rows(spark, folder)
    known = serving.enrich(latest, stations(spark, folder).select(KEY, "capacity"))
    out = forecast.recursive_forecast(known, LINEAR, forecast.resolve_asof(latest, TS), capacity="capacity")
    return rounded(out.drop("yhat_lo", "yhat_hi"), "yhat")


@query
def forecast_static(spark: SparkSession, folder: str) -> DataFrame:
    """A model on a column of the latest row, one out of its JSON, one of the station and the calendar of the forecast time."""
    latest = latest_rows(spark, folder)
    cells = encoding.json_values("props", ["k"])
    known = serving.enrich(latest.withColumns(cells), stations(spark, folder).select(KEY, "capacity"))
    score = forecast.LinearScore({"event_id": 0.001, "props_k": 0.5, "capacity": 0.25, "hour_sin": 2.0, "dow": 0.75}, intercept=1.0)
    out = forecast.recursive_forecast(known, score, forecast.resolve_asof(latest, TS))
    return rounded(out.drop("yhat_lo", "yhat_hi"), "yhat")


@query
def forecast_oneshot(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_rows(spark, folder)
    return rounded(forecast.oneshot_forecast(latest, LINEAR, forecast.resolve_asof(latest, TS), LAG_FEATURES), "yhat")


@query
def future_frame(spark: SparkSession, folder: str) -> DataFrame:
    out = LINEAR(forecast.future_frame(ready(spark, folder), TS), {c: F.col(c) for c in LAG_FEATURES}, "yhat")
    return rounded(out.select(KEY, TS, "h", "timestamp_pred", *CALENDAR_COLUMNS, "yhat"), "hour_sin", "hour_cos", "yhat")


@query
def horizon_summary(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.horizon_summary(linear_forecast(spark, folder))


@query
def horizon_describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(forecast.horizon_describe(linear_forecast(spark, folder)), "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def horizon_invariance(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.horizon_invariance(linear_forecast(spark, folder))


# ---- serving and distances


@query
def enrich_stations(spark: SparkSession, folder: str) -> DataFrame:
    out = serving.enrich(linear_forecast(spark, folder), stations(spark, folder))
    return rounded(out.drop("yhat_lo", "yhat_hi"), "yhat", "lat", "lon")


@query
def tiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(serving.tiles(linear_forecast(spark, folder), stations(spark, folder)), "yhat", "lat", "lon")


@query
def tiles_published(spark: SparkSession, folder: str) -> DataFrame:
    base, latest = scratch_path(spark, "tiles"), latest_rows(spark, folder)
    asof = forecast.resolve_asof(latest, TS)
    serving.publish_tiles(forecast.recursive_forecast(latest, LINEAR, asof), stations(spark, folder), base, asof, forecast.DEFAULT_STEP_MINUTES)
    return rounded(io.read_latest(spark, base), "yhat", "lat", "lon")


@query
def capacity_metrics(spark: SparkSession, folder: str) -> DataFrame:
    joined = serving.enrich(linear_forecast(spark, folder), stations(spark, folder))
    cells = display.capacity_metrics(F.col("yhat"), F.col("capacity"))
    return rounded(joined.select(KEY, "h", *[c.alias(n) for n, c in cells.items()]), *cells)


@query
def traffic_light(spark: SparkSession, folder: str) -> DataFrame:
    label = display.light_label(F.col("pct"), F.col(Y))
    rows = serving.enrich(status(spark, folder), stations(spark, folder)).withColumn("pct", F.col(Y) / F.col("capacity") * 100)
    return rows.select("event_id", label.alias("light")).select(
        "event_id", "light", display.light_hex(F.col("light")).alias("hex"), F.array_join(display.light_rgb(F.col("light")), ",").alias("rgb")
    )


@query
def serving_map(spark: SparkSession, folder: str) -> DataFrame:
    out = served(spark, folder).withColumn("rgb", F.array_join("color_rgb", ","))
    return out.select(KEY, "name", "capacity", "yhat", "docks_pred", "pct_bikes", "pct_docks", "light", "color_hex", "rgb")


@query
def haversine(spark: SparkSession, folder: str) -> DataFrame:
    distance = geo.haversine_m(F.lit(CENTER[0]), F.lit(CENTER[1]), F.col("lat"), F.col("lon"))
    return rounded(stations(spark, folder).select(KEY, distance.alias("distance_m")), "distance_m", digits=3)


@query
def nearest_station(spark: SparkSession, folder: str) -> DataFrame:
    points = table(spark, folder, "supplier").select(
        "s_suppkey",
        (F.lit(-34.6) + (F.col("s_suppkey") * 37 % 1000) * F.lit(0.0002)).alias("lat"),
        (F.lit(-58.4) + (F.col("s_suppkey") * 91 % 1000) * F.lit(0.0002)).alias("lon"),
    )
    return rounded(nearby.nearest_station(points, stations(spark, folder), "s_suppkey"), "distance_m", digits=3)


@query
def nearest_station_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Points without a position stay, without a station."""
    points = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 5 != 0, F.lit(-34.6) + (F.col("s_suppkey") * 37 % 1000) * F.lit(0.0002)).alias("lat"),
        (F.lit(-58.4) + (F.col("s_suppkey") * 91 % 1000) * F.lit(0.0002)).alias("lon"),
    )
    found = nearby.nearest_station(points, stations(spark, folder), "s_suppkey")
    return rounded(found.withColumn(KEY, F.coalesce(KEY, F.lit(-1))), "distance_m", digits=3)


@query
def within_radius(spark: SparkSession, folder: str) -> DataFrame:
    out = serving.nearby_available(materialize(served(spark, folder), "served"), RADIUS_M)
    out = rounded(out.select("focus_lat", "focus_lon", KEY, "light", "distance_m"), "focus_lat", "focus_lon")
    return rounded(out, "distance_m", digits=3)


@query
def top5_nearby(spark: SparkSession, folder: str) -> DataFrame:
    return serving.top_recommendations(materialize(served(spark, folder), "served"), RADIUS_M)


# ---- monitoring


@query
def zero_share(spark: SparkSession, folder: str) -> DataFrame:
    whole = status(spark, folder).withColumn(Y, F.floor(Y))
    return rounded(monitor.zero_share(whole, KEY, Y), "p_zero")


@query
def interarrival_mode(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.interarrival_mode(status(spark, folder), TS)


@query
def interarrival_mode_per_station(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.interarrival_mode_per_station(status_hourly(spark, folder), KEY, TS, TIE)


@query
def hours_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.hours_coverage(status(spark, folder), TS)


@query
def time_profile(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.time_profile(status(spark, folder), TS)


@query
def ks_drift(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    folds = folds_of(rows)
    return rounded(monitor.ks_drift(rows, TS, "y_lag1", folds[0][2], folds[-1][2]), "ks_stat", "pvalue")


@query
def monitoring(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    folds = folds_of(rows)
    return rounded(monitor.monitoring(rows, KEY, TS, Y, "y_lag1", folds[0][2], folds[-1][2]), "value", "pvalue")


@query
def health_checks(spark: SparkSession, folder: str) -> DataFrame:
    return health.health_checks(
        [
            ("status", status(spark, folder), [KEY, TS, Y]),
            ("model_ready", ready(spark, folder), [KEY, TS, Y, *FEATURES]),
            ("predictions", linear_forecast(spark, folder), [KEY, "timestamp_pred", "h", "yhat"]),
            ("stations", stations(spark, folder), [KEY, "lat", "lon", "address"]),
        ]
    )


# ---- leaderboard


@query
def split_canon(spark: SparkSession, folder: str) -> DataFrame:
    names = F.when(F.col("split") == "val", "Validation").when(F.col("split") == "test", "TEST").otherwise(F.col("split"))
    rows = split_ready(spark, folder).select(names.alias("raw"))
    return rows.groupBy("raw", leaderboard.canonical_split(F.col("raw")).alias("canonical")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def leaderboard_wide(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(board(spark, folder), *leaderboard.WIDE_METRICS)


@query
def leaderboard_upsert(spark: SparkSession, folder: str) -> DataFrame:
    whole = split_ready(spark, folder).withColumn("framework", F.lit("persistence"))
    added = leaderboard.wide_board(metrics_by(whole, ["framework", "split"], Y, persistence()))
    existing = board(spark, folder)
    return rounded(leaderboard.upsert(existing, added.unionByName(existing)), *leaderboard.WIDE_METRICS)


@query
def model_paths(spark: SparkSession, folder: str) -> DataFrame:
    return leaderboard.fill_model_paths(board(spark, folder), PATHS).select("framework", "model_path")


@query
def rank_models(spark: SparkSession, folder: str) -> DataFrame:
    return leaderboard.rank_models(board(spark, folder)).select("framework", "place")


@query
def choose_best(spark: SparkSession, folder: str) -> DataFrame:
    return _union(
        [
            leaderboard.choose_best(board(spark, folder), m, t).select(F.lit(m).alias("metric"), "framework")
            for m, t in (("rmse", []), ("r2", ["val_mae"]), ("test_mae", ["val_rmse"]))
        ]
    )


@query
def champion(spark: SparkSession, folder: str) -> DataFrame:
    winner = leaderboard.choose_best(leaderboard.fill_model_paths(board(spark, folder), PATHS), "rmse", ["val_mae", "val_r2"])
    return rounded(winner, *leaderboard.WIDE_METRICS)


@query
def registry_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ready(spark, folder)
    scored = split.label_folds(rows, TS, folds_of(rows)).where("part = 'val'").withColumnRenamed("event_type", "framework")
    per_fold = metrics_by(scored, ["fold", "val_end", "framework"], Y, persistence())
    best = per_fold.groupBy("val_end").agg(F.min_by(F.struct("framework", "rmse"), F.struct("rmse", "framework")).alias("w"))
    registrations = best.select(F.lit("availability_champion").alias("name"), "w.*", F.col("val_end").alias("registered_at"))
    return rounded(leaderboard.registry_table(registrations), "rmse")


@query
def compare_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = leaderboard.compare_summary(metrics_long(spark, folder).where("split = 'val'"))
    return rounded(out, "best_rmse", "best_mae", "best_r2")


# ---- models


def _training_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """The labelled training table with every feature that its training part teaches, and their names; written once."""
    rows = split_ready(spark, folder)
    learnt = encoding.learn_encoding(rows.where("split = 'train'"), [KEY, TS, Y, "event_id", "split"])
    return materialize(encoding.encode(rows, learnt, [KEY, TS, Y, "split"]), "encoded"), learnt.features


@lru_cache(maxsize=4)
def _stored_forest(application: str, folder: str) -> tuple[DataFrame, str, str, str]:
    """The encoded training table, where its forest is saved, and the run that made it; fitted once per session and folder."""
    spark = SparkSession.active()
    rows, features = _training_rows(spark, folder)
    model, metrics = training.train_forest(rows, features, Y, FOREST["numTrees"], FOREST["maxDepth"])
    path, runs = scratch_path(spark, "model"), scratch_path(spark, "runs")
    training.save_model(model, path)
    run = io.record_run(metrics, runs, {**FOREST, "seed": training.DEFAULT_SEED, "features": len(features)}, {"model": path})
    return rows, path, runs, run


def stored_forest(spark: SparkSession, folder: str) -> tuple[DataFrame, str, str, str]:
    return _stored_forest(spark.sparkContext.applicationId, folder)


@query
def train_rf(spark: SparkSession, folder: str) -> DataFrame:
    """The forest's metrics as its run recorded them, and the baseline's."""
    rows, _, runs, run = stored_forest(spark, folder)
    scored = spark.read.parquet(f"{runs}/metrics").where(F.col("run_id") == run).drop("run_id", "run_ts")
    baseline = metrics_by(rows.where("split = 'val'").withColumn("split", F.lit("baseline_lag1")), ["split"], Y, persistence())
    return scored.unionByName(baseline)


@query
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return training.feature_importance(spark, training.load_model(stored_forest(spark, folder)[1]))


@query
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The saved model, found through its run, scores the table again."""
    rows, _, runs, run = stored_forest(spark, folder)
    return training.evaluate(training.load_model(io.run_artefact(spark, runs, run, "model")), rows, Y, ["split"])


def _forecast_forest(spark: SparkSession, folder: str, interval: bool) -> DataFrame:
    rows, path, _, _ = stored_forest(spark, folder)
    names = training.stored_features(spark, path, rows.where("split = 'train'"), (Y, "split"))
    latest = materialize(history.latest_per_key(rows.drop("split"), KEY, [TS]), "latest")
    model = training.load_model(path)
    return forecast.recursive_forecast(
        training.dealt_for_scoring(latest, model, len(forecast.DEFAULT_HORIZONS)),
        training.model_scorer(model, leaf=interval, names=names),
        forecast.resolve_asof(latest, TS),
        interval=training.stored_interval(spark, path) if interval else None,
    )


@query
def forecast_rf(spark: SparkSession, folder: str) -> DataFrame:
    return _forecast_forest(spark, folder, interval=False).drop("yhat_lo", "yhat_hi")


@query
def forecast_ci(spark: SparkSession, folder: str) -> DataFrame:
    return _forecast_forest(spark, folder, interval=True)


@lru_cache(maxsize=4)
def _trial_table(application: str, folder: str) -> tuple[DataFrame, list[str], ledger.Ledger]:
    """The training table of the searches and their ledger; what one query has fitted, the next ones of the session read."""
    spark = SparkSession.active()
    rows, features = _training_rows(spark, folder)
    return rows, features, ledger.Ledger(spark, f"{shared_dir(spark)}/dockcast/trials", ledger.data_version(rows))


def _trials(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str], ledger.Ledger]:
    return _trial_table(spark.sparkContext.applicationId, folder)


def _compared(spark: SparkSession, folder: str) -> list[training.Trial]:
    rows, features, known = _trials(spark, folder)
    return training.compare_models(rows, TS, folds_of(rows), features, Y, ledger=known)


@query
def compare_models(spark: SparkSession, folder: str) -> DataFrame:
    return training.trials_table(spark, _compared(spark, folder))


@query
def tune_model(spark: SparkSession, folder: str) -> DataFrame:
    """The best of all families, and what tuning makes of it."""
    rows, features, known = _trials(spark, folder)
    base = _compared(spark, folder)[0]
    return training.trials_table(spark, [base, training.tune_model(rows, TS, folds_of(rows), features, Y, base, ledger=known)])


@query
def budget_search(spark: SparkSession, folder: str) -> DataFrame:
    rows, features, known = _trials(spark, folder)
    train, val = (rows.where(F.col("split") == part) for part in ("train", "val"))
    _, trials = training.budget_search(train, val, features, Y, seconds=SEARCH_SECONDS, ledger=known)
    return training.trials_table(spark, trials)


@query
def trial_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Simple forecasts scored per fold into a ledger, twice; the second run finds every score there."""
    rows = stored_ready(spark, folder)
    folds, version = folds_of(rows), ledger.data_version(rows)
    path, again = scratch_path(spark, "trials"), 0
    for _ in range(2):
        known = ledger.Ledger(spark, path, version)
        for column in LAG_FEATURES:
            for _, train_end, val_end in folds:
                after = training.fold_parts(rows, TS, train_end, val_end)[1]
                score = lambda a=after, c=column: metrics_by(a, [], Y, persistence(c)).first().asDict()
                known.measure(column, {}, f"{train_end.isoformat()}/{val_end.isoformat()}", [column], 0, score)
        again = known.fitted
    summary = known.summary().withColumnRenamed("family", "framework").drop("params", "cost_s")
    ranked = leaderboard.rank_models(summary, ["rmse", "mae", "r2"]).withColumn("fitted_again", F.lit(again))
    return rounded(ranked, "rmse", "mae", "r2")


@query
def run_record(spark: SparkSession, folder: str) -> DataFrame:
    """The record of one run: metrics, a parameter and the artefact, joined by the run."""
    base, out = scratch_path(spark, "runs"), scratch_path(spark, "scored")
    rows = split_ready(spark, folder)
    io.write_table(rows.select(KEY, TS, "split", persistence().alias("yhat")), out)
    run = io.record_run(metrics_by(rows, ["split"], Y, persistence()), base, {"lag": 1}, {"scored": out})
    stored = spark.read.parquet(io.run_artefact(spark, base, run, "scored")).groupBy("split").agg(F.count(F.lit(1)).alias("n_stored"))
    params = spark.read.parquet(f"{base}/params").where(F.col("name") == "lag").select("run_id", F.col("value").alias("lag"))
    logged = spark.read.parquet(f"{base}/metrics").join(params, "run_id").join(stored, "split")
    return rounded(logged.select("split", "n_rows", "rmse", "mae", "r2", "lag", "n_stored"), "rmse", "mae", "r2")


CHAMPION = "availability_champion"


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    """The two best families fitted on the training rows, stored and registered: the second best first, so that it is archived."""
    rows, features, _ = _trials(spark, folder)
    entries = []
    for day, trial in enumerate(reversed(_compared(spark, folder)[:2]), start=1):
        path = scratch_path(spark, "model")
        training.save_model(training.refit(rows.where("split = 'train'"), features, Y, trial), path)
        entries.append((CHAMPION, trial.family, path, datetime(2024, 1, day)))
    registered = spark.createDataFrame(entries, "name string, framework string, model_path string, registered_at timestamp_ntz")
    return leaderboard.registry_table(registered)


@query
def refit_champion(spark: SparkSession, folder: str) -> DataFrame:
    """What is in production, as it was stored and refitted in both modes; only `trainval` has not seen the test part."""
    rows, registry = _trials(spark, folder)[0], _registry(spark, folder)
    stored = leaderboard.in_production(registry, CHAMPION)
    models = {"stored": (stored["framework"], training.load_model(stored["model_path"]))}
    for mode in training.REFIT_MODES:
        models[mode] = training.refit_registered(spark, registry, CHAMPION, rows, Y, mode)
    scored = [
        training.evaluate(model, rows.where("split <> 'train'"), Y, ["split"], lower=0.0).select(
            F.lit(mode).alias("mode"), "split", F.lit(family).alias("framework"), "n_rows", "rmse", "mae", "r2"
        )
        for mode, (family, model) in models.items()
    ]
    return _union(scored)


@query
def backtest_rf(spark: SparkSession, folder: str) -> DataFrame:
    rows, features = _training_rows(spark, folder)
    scored = backtest.model_backtest(rows, TS, Y, features, folds_of(rows), "forest", BACKTEST_FOREST)
    return backtest.backtest_summary(scored, Y)


def _slot_models(features: DataFrame) -> list[training.SlotModel]:
    """Trained, stored, and loaded again with the features that the stored models name; the trials stay with them."""
    spark, base = features.sparkSession, scratch_path(features.sparkSession, "slot_models")
    trained = training.train_slots(features, slots.DEFAULT_SLOTS)
    return [replace(training.load_slot_model(spark, m.save(base), m.label, features), trials=m.trials) for m in trained]


@query
def train_slots(spark: SparkSession, folder: str) -> DataFrame:
    models = _slot_models(materialize(features_of_slots(spark, folder), "slot_features"))
    return _union([training.trials_table(spark, m.trials).withColumn("slot_label", F.lit(m.label)) for m in models])


@query
def predict_slots(spark: SparkSession, folder: str) -> DataFrame:
    features = materialize(features_of_slots(spark, folder), "slot_features")
    path = scratch_path(spark, "slot_predictions")
    io.write_slots(training.predict_slots(features, _slot_models(features)), path)
    return io.read_slots(spark, path)
