"""Hot keys, piles of copies and long sequences give the same rows as the plain plans."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockcast.catalog import KEY, TIE, TS, Y, linear_forecast, obs, rounded, served
from dockcast.operators import history, monitor, nearby, segments, slots, split
from dockcast.operators.asof import asof_join
from dockcast.operators.quantiles import bracketed_quantiles
from dockcast.plans import serving
from dockcast.plans import slots as slot_plans
from dockcast.plans.features import model_ready
from dockcast.session import materialize
from dockcast.sources.adapters import status, status_hourly

FOLDER = "/root/testdata/sf0.001"
MEANS = ("y_ma3", "y_ma6", "y_ma12", "y_diff1")


def hot(df):
    """One station holds more than a third of the feed."""
    return df.withColumn(KEY, F.when(F.col("event_type").isin("click", "view"), F.lit(3)).otherwise(F.col(KEY)))


def assert_same(a, b):
    a, b = materialize(a, "a"), materialize(b.select(*a.columns), "b")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def feed(spark):
    return hot(status_hourly(spark, FOLDER))


@pytest.fixture(scope="module")
def fine(spark):
    return slot_plans.observations(hot(status(spark, FOLDER)), KEY, TS, Y, TIE)


@pytest.fixture(scope="module")
def piles(feed):
    """A third of the rows carry one time."""
    return feed.withColumn(TS, F.when(F.col("event_type") == "view", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).otherwise(F.col(TS)))


@pytest.mark.parametrize("rows", [5, 60])
def test_history_of_cut_keys(feed, rows):
    assert segments.plan_segments(feed, KEY, TS, rows).active
    assert_same(model_ready(feed, tie=TIE), model_ready(feed, tie=TIE, target_rows=rows))
    assert_same(history.add_lags(feed, KEY, TS, Y, 12, TIE), history.add_lags(feed, KEY, TS, Y, 12, TIE, rows))


@pytest.mark.parametrize("rows", [5, 60])
def test_asof_of_cut_keys(fine, rows):
    grid = slots.slot_grid(fine, KEY, "ts")
    for tolerance in (720, None):
        plain = asof_join(grid, fine, KEY, "t_slot", "ts", TIE, tolerance)
        assert_same(plain, asof_join(grid, fine, KEY, "t_slot", "ts", TIE, tolerance, target_rows=rows))


def test_piles_of_copies(piles, feed):
    assert segments.plan_segments(piles, KEY, TS, 20).heavy_ties
    assert_same(model_ready(piles, tie=TIE), model_ready(piles, tie=TIE, target_rows=20))
    seen = slot_plans.observations(piles, KEY, TS, Y, TIE)
    grid = slots.slot_grid(seen, KEY, "ts")
    assert_same(asof_join(grid, seen, KEY, "t_slot", "ts", TIE), asof_join(grid, seen, KEY, "t_slot", "ts", TIE, target_rows=20))


@pytest.mark.parametrize("tolerance", [60, 720])
def test_slot_targets_by_aggregation_equal_the_asof_join(fine, tolerance):
    joined = asof_join(slots.slot_grid(fine, KEY, "ts"), fine, KEY, "t_slot", "ts", TIE, tolerance)
    joined = joined.select(KEY, "t_slot", "slot_label", "y", F.col("ts").alias("ts_matched"))
    assert_same(joined, slot_plans.slot_targets(fine, tolerance_minutes=tolerance, tie=TIE))


@pytest.mark.parametrize("hourly", [False, True])
def test_slot_features_by_reduction_and_by_windows(fine, feed, hourly):
    rows = slot_plans.observations(feed, KEY, TS, Y, TIE) if hourly else fine
    targets = materialize(slot_plans.slot_targets(fine, tolerance_minutes=720, tie=TIE), "targets")
    windows = rounded(slot_plans.slot_features_any(targets, rows, tie=TIE), *MEANS)
    assert_same(windows, rounded(slot_plans.slot_features_reduced(targets, rows, tie=TIE), *MEANS))
    assert_same(windows, rounded(slot_plans.slot_features_any(targets, rows, tie=TIE, target_rows=20), *MEANS))


def test_slot_features_with_an_age_limit(fine):
    targets = slot_plans.slot_targets(fine, tolerance_minutes=720, tie=TIE)
    windows = rounded(slot_plans.slot_features_any(targets, fine, tie=TIE, max_age_minutes=300), *MEANS)
    assert_same(windows, rounded(slot_plans.slot_features_reduced(targets, fine, tie=TIE, max_age_minutes=300), *MEANS))


def test_dense_feeds_are_reduced(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    dense = spark.createDataFrame([("a", start + timedelta(minutes=i), float(i % 7)) for i in range(3000)], "station_id string, ts timestamp_ntz, y double")
    assert not slot_plans._is_dense(dense, slots.DEFAULT_SLOTS, 13)
    monkeypatch.setattr(slot_plans, "TARGET_ROWS", 100)
    assert slot_plans._is_dense(dense, slots.DEFAULT_SLOTS, 13)
    targets = slot_plans.slot_targets(dense)
    assert_same(rounded(slot_plans.slot_features(targets, dense), *MEANS), rounded(slot_plans.slot_features_any(targets, dense), *MEANS))


def test_global_sequences_in_parts(spark, monkeypatch):
    rows = status(spark, FOLDER)
    ready = model_ready(status_hourly(spark, FOLDER), tie=TIE)
    folds = split.fold_cuts(ready, TS)
    whole = [monitor.interarrival_mode(rows, TS).first(), monitor.ks_drift(ready, TS, "y_lag1", folds[0][2], folds[-1][2]).first()]
    monkeypatch.setattr(monitor, "ONE_TASK_ROWS", 50)
    monkeypatch.setattr(monitor, "PART_ROWS", 20)
    assert whole[0] == monitor.interarrival_mode(rows, TS).first()
    assert whole[1] == monitor.ks_drift(ready, TS, "y_lag1", folds[0][2], folds[-1][2]).first()


def test_gaps_with_piles_of_copies(piles, monkeypatch):
    whole = {(r["minutes"], r["n"]) for r in monitor.interarrival_counts(piles, TS).collect()}
    monkeypatch.setattr(monitor, "ONE_TASK_ROWS", 50)
    monkeypatch.setattr(monitor, "PART_ROWS", 20)
    assert whole == {(r["minutes"], r["n"]) for r in monitor.interarrival_counts(piles, TS).collect()}


def test_split_cuts_by_narrowing(spark, monkeypatch):
    rows = status(spark, FOLDER)
    whole = split.split_cuts(rows, TS)
    monkeypatch.setattr(split, "MAX_COLLECT", 3)
    assert split.split_cuts(rows, TS) == whole
    dense = spark.range(5000).select((F.lit("2024-01-01 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * F.lit(0.000007).cast("decimal(18,6)"))).alias("t"))
    expected = datetime(2024, 1, 1, 10) + timedelta(microseconds=7 * 3500)
    assert split.split_cuts(dense, "t")[0] == expected


@pytest.mark.parametrize("accuracy", [10, 50, 10_000])
def test_bracketed_quantiles(spark, accuracy):
    values = status(spark, FOLDER).select(F.length("event_type").alias("h"), F.round(Y, 0).alias("_v"))
    shares, names = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0), [f"q{i}" for i in range(6)]
    exact = values.groupBy("h").agg(*[F.percentile("_v", p).alias(n) for p, n in zip(shares, names, strict=True)])
    assert_same(rounded(exact, *names), rounded(bracketed_quantiles(values, "h", shares, names, accuracy), *names))


@pytest.mark.parametrize("keep", [1, 2, 8])
def test_top_nearby_with_few_candidates_per_cell(spark, keep):
    table = materialize(served(spark, "/root/testdata/sf0.01"), "served")
    assert_same(serving.top_recommendations(table, 800.0), serving.top_recommendations(table, 800.0, keep_per_cell=keep))


def test_top_nearby_with_equal_values(spark, monkeypatch):
    """Ties on the value are decided by distance, so nothing may be settled by value alone."""
    monkeypatch.setattr(nearby, "KEEP_GROWTH", 2)
    table = spark.range(60).select(
        F.col("id").alias("station_id"), (F.lit(-34.6) + F.col("id") * 0.0003).alias("lat"), F.lit(-58.4).alias("lon"), F.lit(5.0).alias("yhat")
    )
    assert_same(nearby.top_nearby(table, table, 700.0), nearby.top_nearby(table, table, 700.0, keep_per_cell=2))


def test_forecast_has_one_row_per_station_and_horizon(spark):
    out = linear_forecast(spark, FOLDER)
    assert out.count() == out.select(KEY, "h").distinct().count()


def test_one_shuffle_carries_dedup_and_history(spark):
    plan = model_ready(status_hourly(spark, FOLDER), tie=TIE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_observations_are_combined_before_the_slot_shuffle(spark):
    plan = slot_plans.slot_targets(obs(spark, FOLDER), tolerance_minutes=60, tie=TIE)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
