"""Models beat the baseline where there is something to learn, and score the same rows the same way."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from dockcast.operators import leaderboard, split
from dockcast.operators.contracts import ContractError
from dockcast.operators.metrics import metrics_by, persistence
from dockcast.plans import backtest, forecast, ledger, training
from dockcast.plans import slots as slot_plans
from dockcast.plans.features import model_ready
from dockcast.session import materialize, scratch_path

Y, TS = "num_bikes_available", "ts_local"
FEATURES = ["hour", "dow", "is_weekend", "hour_sin", "hour_cos", "y_lag1", "y_lag2", "y_ma3"]


@pytest.fixture(scope="module")
def feed(spark):
    """Hourly daily waves with a little noise: yesterday's shape is predictable, the last value alone is not enough."""
    rng, start = np.random.default_rng(1), datetime(2024, 1, 1)
    rows = [
        (s, start + timedelta(hours=h), float(20 + 10 * np.sin(2 * np.pi * (h % 24) / 24 + s) + rng.normal(0, 0.5))) for s in range(6) for h in range(24 * 20)
    ]
    return materialize(spark.createDataFrame(rows, f"station_id long, {TS} timestamp_ntz, {Y} double"), "wave")


@pytest.fixture(scope="module")
def rows(spark, feed):
    return materialize(split.temporal_split(model_ready(feed, tie=[Y]), TS), "rows")


@pytest.fixture(scope="module")
def model(rows):
    return training.train_forest(rows, FEATURES, Y, trees=12, depth=6)


def test_forest_beats_persistence(rows, model):
    base = {r["split"]: r["rmse"] for r in metrics_by(rows, ["split"], Y, persistence()).collect()}
    for r in model[1].collect():
        assert r["rmse"] < base[r["split"]]


def test_importance_sums_to_one(spark, model):
    report = training.feature_importance(spark, model[0]).collect()
    assert [r["feature"] for r in report] == FEATURES
    assert sum(r["importance"] for r in report) == pytest.approx(1.0)


def test_saved_model_scores_the_same(spark, rows, model):
    path = scratch_path(spark, "model")
    training.save_model(model[0], path)
    loaded = training.load_model(path)
    assert training.expected_features(loaded) == FEATURES
    a, b = (m.transform(rows).select("station_id", TS, F.round("prediction", 9).alias("p")) for m in (model[0], loaded))
    assert a.exceptAll(b).isEmpty()


@pytest.fixture(scope="module")
def deep(spark, rows):
    """A saved forest of full depth."""
    path = scratch_path(spark, "deep")
    training.save_model(training.train_forest(rows, FEATURES, Y, trees=5, depth=30)[0], path)
    return path


def test_stored_leaves_are_the_trees_own(spark, rows, deep):
    forest = training.load_model(deep).stages[-1]
    assert max(t.depth for t in forest.trees) > 10
    table = {(r["tree"], r["leaf"]): r["value"] for r in training.stored_leaves(spark, deep).collect()}
    assert len(table) == sum((t.numNodes + 1) // 2 for t in forest.trees)
    assembled = training.load_model(deep).stages[0].transform(rows.limit(200))
    scored = forest.copy().setLeafCol("leaf").transform(assembled).select("features", vector_to_array("leaf").alias("leaf"), "prediction").collect()
    for r in scored[:50]:
        per_tree = [table[i, int(leaf)] for i, leaf in enumerate(r["leaf"])]
        assert per_tree == pytest.approx([t.predict(r["features"]) for t in forest.trees])
        assert np.mean(per_tree) == pytest.approx(r["prediction"])


def test_forecast_interval_is_the_spread_of_the_trees(spark, rows, deep):
    latest = rows.orderBy(F.desc(TS)).limit(6).drop("split")
    model = training.load_model(deep)
    asof = forecast.resolve_asof(rows, TS)
    interval = training.forest_interval(training.stored_leaves(spark, deep))
    out = forecast.recursive_forecast(latest, training.model_scorer(model, leaf=True), asof, interval=interval).collect()
    plain = forecast.recursive_forecast(latest, training.model_scorer(model), asof).collect()
    assert {(r["station_id"], r["h"], r["yhat"]) for r in out} == {(r["station_id"], r["h"], r["yhat"]) for r in plain}
    assert len(out) == 24
    assert all(r["yhat_lo"] <= r["yhat"] <= r["yhat_hi"] for r in out)
    first = {c: F.col(c).cast("double") for c in FEATURES}
    calendar = {n: F.lit(float(v)) for n, v in forecast.calendar_of(asof + timedelta(hours=1)).items()}
    inputs = latest.select("station_id", *[({**first, **calendar}[c]).alias(c) for c in FEATURES])
    forest = model.stages[-1]
    for r in model.stages[0].transform(inputs).collect():
        own = np.std([t.predict(r["features"]) for t in forest.trees])
        found = next(x for x in out if x["station_id"] == r["station_id"] and x["h"] == 1)
        assert found["yhat_hi"] - found["yhat"] == pytest.approx(training.INTERVAL_Z * own)


def test_tree_histograms_grow_with_the_level_within_bounds():
    assert training.histogram_mb(5, 32) == training.LEAST_HISTOGRAM_MB
    assert training.LEAST_HISTOGRAM_MB < training.histogram_mb(13, 32) <= training.histogram_mb(30, 32) == training.MOST_HISTOGRAM_MB
    assert training.build_estimator("forest", {"maxDepth": 30}).getCacheNodeIds()


def test_features_of_a_stored_model(spark, rows, deep, tmp_path):
    assert training.stored_features(spark, deep) == FEATURES
    bare = f"{tmp_path}/bare"
    training.load_model(deep).stages[-1].write().save(f"{bare}/stages/1_forest")
    assert training.stored_features(spark, bare, rows.select("hour", "y_lag1", Y, "split"), (Y,)) == ["hour", "y_lag1"]
    with pytest.raises(ContractError):
        training.stored_features(spark, bare)


def test_recipes(spark, rows):
    for family, params in (("ridge", {"regParam": 0.7}), ("lasso", {}), ("huber", {"epsilon": 1.5}), ("tree", {"maxDepth": 3}), ("boosted", {"maxIter": 3, "maxDepth": 2}), ("forest", {"numTrees": 4})):
        path = scratch_path(spark, "recipe")
        training.save_model(training.fit(rows, FEATURES, Y, training.build_estimator(family, params)), path)
        found, own = training.recipe_of(training.load_model(path))
        assert found == family
        assert all(own[k] == v for k, v in params.items())


def test_registered_champion_is_refitted_without_a_search(spark, rows, monkeypatch):
    entries = []
    for day, (family, params) in enumerate((("tree", {"maxDepth": 2}), ("ridge", {"regParam": 0.3})), start=1):
        path = scratch_path(spark, "registered")
        training.save_model(training.fit(rows.where("split = 'train'"), FEATURES[:4] if day == 1 else FEATURES, Y, training.build_estimator(family, params)), path)
        entries.append(("champion", family, path, datetime(2024, 1, day)))
    registry = leaderboard.registry_table(spark.createDataFrame(entries, "name string, framework string, model_path string, registered_at timestamp_ntz"))
    assert {r["framework"]: r["stage"] for r in registry.collect()} == {"tree": "Archived", "ridge": "Production"}
    seen = []
    real = training.fit
    monkeypatch.setattr(training, "fit", lambda df, *a: seen.append(df.count()) or real(df, *a))
    for mode in training.REFIT_MODES:
        family, model = training.refit_registered(spark, registry, "champion", rows, Y, mode)
        assert family == "ridge" and training.expected_features(model) == FEATURES
        assert training.recipe_of(model)[1]["regParam"] == 0.3
    assert seen == [rows.where("split <> 'test'").count(), rows.count()]
    with pytest.raises(ValueError):
        training.refit_registered(spark, registry, "champion", rows, Y, "all")
    with pytest.raises(ContractError):
        training.refit_registered(spark, registry, "unknown", rows, Y)


class Lost(Exception):
    """The driver is gone."""


def test_a_search_goes_on_where_it_stopped(spark, rows, monkeypatch):
    folds = split.fold_cuts(rows, TS, n_splits=2)
    path, version = scratch_path(spark, "trials"), ledger.data_version(rows)
    monkeypatch.setattr(training, "PARALLEL_FITS", 1)
    families = ("lasso", "tree", "linear")
    real, fits = training.fit, []

    def dying(*a):
        if len(fits) == 4:
            raise Lost
        fits.append(1)
        return real(*a)

    monkeypatch.setattr(training, "fit", dying)
    monkeypatch.setattr(training, "in_parallel", lambda work, items: [work(x) for x in items])
    with pytest.raises(Lost):
        training.compare_models(rows, TS, folds, FEATURES, Y, families, ledger=ledger.Ledger(spark, path, version))
    monkeypatch.setattr(training, "fit", lambda *a: fits.append(1) or real(*a))
    again = ledger.Ledger(spark, path, version)
    trials = training.compare_models(rows, TS, folds, FEATURES, Y, families, ledger=again)
    assert len(fits) == 6 and again.fitted == 2
    third = ledger.Ledger(spark, path, version)
    assert training.compare_models(rows, TS, folds, FEATURES, Y, families, ledger=third) == trials and third.fitted == 0
    summary = {r["family"]: r["rmse"] for r in third.summary().collect()}
    assert summary == pytest.approx({t.family: t.rmse for t in trials})
    other = ledger.Ledger(spark, path, ledger.data_version(rows.limit(100)))
    assert other.version != version and other.own().isEmpty()


def test_data_version_ignores_order_and_sees_values(rows):
    some = materialize(rows.select("station_id", TS, Y), "some")
    assert ledger.data_version(some) == ledger.data_version(some.orderBy(F.desc(TS)).repartition(3))
    assert ledger.data_version(some) != ledger.data_version(some.withColumn(Y, F.col(Y) + F.when(F.col("station_id") == 1, 1).otherwise(0)))


def test_halving_finds_what_an_exhaustive_search_finds(spark, rows):
    train, val = (materialize(rows.where(f"split = '{p}'").select(*FEATURES, Y), p) for p in ("train", "val"))
    grid = [("ridge", {"regParam": r}) for r in (0.01, 50.0, 500.0)] + [("lasso", {"regParam": r}) for r in (5.0, 50.0)] + [("tree", {"maxDepth": d}) for d in (1, 2)] + [("boosted", {"maxIter": n, "maxDepth": 1}) for n in (3, 9)]
    trials = training.halving(train, val, FEATURES, Y, grid, least_rows=100)
    assert [sum(t.rung == r for t in trials) for r in (0, 1, 2)] == [9, 3, 1]
    assert {t.rung for t in training.halving(train, val, FEATURES, Y, grid[:4], least_rows=train.count())} == {0}
    assert all(t.cost_s > 0 for t in trials)
    winner = trials[-1]
    whole = [(training.evaluate(training.fit(train, FEATURES, Y, training.build_estimator(f, p)), val, Y, lower=0.0).first()["rmse"], f, p) for f, p in grid]
    best = min(whole, key=lambda x: x[0])
    assert (winner.family, winner.params) == best[1:] and winner.rmse == pytest.approx(best[0])
    assert training.with_share("boosted", {"maxIter": 18}, 1 / 9) == {"maxIter": 2}


def test_scorer_agrees_with_the_pipeline(rows, model):
    score = training.model_scorer(model[0])
    both = score(model[0].transform(rows), {c: F.col(c) for c in FEATURES}, "again")
    assert both.where(F.abs(F.col("prediction") - F.col("again")) > 1e-9).isEmpty()


def test_comparison_search_and_refit(spark, rows):
    folds = split.fold_cuts(rows, TS, n_splits=2)
    trials = training.compare_models(rows, TS, folds, FEATURES, Y, ("lasso", "tree", "linear"))
    assert [t.rmse for t in trials] == sorted(t.rmse for t in trials)
    tree = next(t for t in trials if t.family == "tree")
    assert training.tune_model(rows, TS, folds, FEATURES, Y, tree, iterations=2).rmse <= tree.rmse
    assert training.trials_table(spark, trials).count() == 3
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    best, tried = training.budget_search(train, val, FEATURES, Y, seconds=0.0, families=("ridge", "tree"))
    assert [t.family for t in tried] == ["ridge", "tree"] and best in tried
    refit = training.refit(rows.where("split <> 'test'"), FEATURES, Y, trials[0])
    assert training.evaluate(refit, rows.where("split = 'test'"), Y, lower=0.0).first()["r2"] > 0.5


def test_unknown_family():
    with pytest.raises(ValueError):
        training.build_estimator("nearest_neighbours")
    assert training.build_estimator("forest", {"numTrees": 4.6, "maxDepth": 3.2}).getNumTrees() == 5


def test_backtest_reports_model_and_baseline(rows):
    folds = split.fold_cuts(rows, TS)
    scored = backtest.model_backtest(rows, TS, Y, FEATURES, folds, "tree")
    for r in backtest.backtest_summary(scored, Y).collect():
        assert r["val_rmse"] < r["baseline_rmse"]
    assert backtest.sample_per_fold(scored, ["station_id", TS]).groupBy("fold").count().where("count <> 50").isEmpty()


def test_slot_models_use_only_their_features(feed):
    obs = slot_plans.observations(feed, "station_id", TS, Y)
    features = materialize(slot_plans.slot_features(slot_plans.slot_targets(obs), obs), "slot")
    models = training.train_slots(features, ["09:00", "13:00", "23:00"], n_splits=2, families=("ridge",), min_rows=50)
    assert [m.label for m in models] == ["09:00", "13:00"]
    assert not {"station_id", "y", "lead_minutes"} & set(models[0].features)
    out = training.predict_slots(features, models)
    assert {r["slot_label"] for r in out.select("slot_label").distinct().collect()} == {"09:00", "13:00"}
    assert out.columns == ["station_id", "t_slot", "slot_label", "yhat", "generated_at"]
    assert training.train_slot(features, "09:00", 2, ("ridge",), min_rows=10_000) is None


def test_a_fit_deals_its_rows_by_what_a_task_holds(spark, rows, monkeypatch):
    many = materialize(rows.repartition(12), "many")
    assert many.rdd.getNumPartitions() > 1
    assert training.dealt(many, 1_000).rdd.getNumPartitions() == 1
    assert training.task_count(24_000_000 * 300, 12) == 450 and training.task_count(137_616 * 20, 12) == 3
    assert training.task_count(0, 4) == 1 and training.task_count(5_000_000, 4) == 4
    wide = training.dealt(many, 40 * training.MOST_TASK_CELLS)
    assert wide.rdd.getNumPartitions() == 40 and wide.exceptAll(many).isEmpty() and wide.count() == many.count()
    largest, whole = [], training.Pipeline.fit

    def watched(self, df, *a):
        largest.append(max(df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()))
        return whole(self, df, *a)

    monkeypatch.setattr(training.Pipeline, "fit", watched)
    monkeypatch.setattr(training, "MOST_TASK_CELLS", 20_000)
    monkeypatch.setattr(training, "LEAST_TASK_CELLS", 2_000)
    model = training.fit(rows, FEATURES, Y, training.build_estimator("forest", {"numTrees": 40, "maxDepth": 2}))
    assert largest[0] <= 2 * 20_000 // 40
    monkeypatch.setattr(training, "SCORED_TASK_CELLS", 10_000)
    spread = training.dealt_for_scoring(rows, model)
    assert spread.rdd.getNumPartitions() >= rows.count() * 40 // 10_000
    assert training.evaluate(model, rows, Y).first()["n_rows"] == rows.count()


def test_node_ids_of_very_large_shallow_forests_are_not_kept(rows, monkeypatch):
    kept, whole = [], training.Pipeline.fit
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, df, *a: kept.append(self.getStages()[-1].getCacheNodeIds()) or whole(self, df, *a))
    few = rows.limit(300)
    shallow, deep = (training.build_estimator("forest", {"numTrees": 3, "maxDepth": d}) for d in (3, 20))
    same = [training.fit(few, FEATURES, Y, shallow).stages[-1].toDebugString]
    monkeypatch.setattr(training, "MOST_NODE_ID_CELLS", 1)
    same.append(training.fit(few, FEATURES, Y, shallow).stages[-1].toDebugString)
    training.fit(few, FEATURES, Y, deep)
    assert kept == [True, False, True]
    assert same[0].split("\n")[1:] == same[1].split("\n")[1:]


def test_all_fits_of_a_comparison_run_side_by_side(spark, rows, monkeypatch):
    """A family's folds do not wait for each other; the long families start first."""
    folds, started = split.fold_cuts(rows, TS, n_splits=3), []

    def scored(past, after, fold, features, label, family, params, seed, ledger, lower=None):
        started.append(family)
        return {"rmse": float(len(fold)), "mae": 1.0, "r2": 0.0, "cost_s": 1.0}

    monkeypatch.setattr(training, "_scored", scored)
    monkeypatch.setattr(training, "in_parallel", lambda work, items: [work(x) for x in items])
    trials = training.compare_models(rows, TS, folds, FEATURES, Y, ("linear", "huber", "boosted"))
    assert started == ["boosted"] * 3 + ["huber"] * 3 + ["linear"] * 3
    assert {t.family: t.cost_s for t in trials} == {"linear": 3.0, "huber": 3.0, "boosted": 3.0}


def test_boosting_keeps_no_node_ids_of_shallow_trees(rows):
    assert not training.build_estimator("boosted").getCacheNodeIds()
    assert training.build_estimator("boosted", {"maxDepth": 20}).getCacheNodeIds()
    few = rows.limit(300)
    fits = [training.fit(few, FEATURES, Y, training.build_estimator("boosted", {"maxIter": 3, "cacheNodeIds": k})).stages[-1].toDebugString for k in (True, False)]
    assert fits[0].split("\n")[1:] == fits[1].split("\n")[1:]


def test_least_squares_tries_share_one_pass_over_a_fold(spark, rows, monkeypatch):
    """A try of a linear family is no fit over all rows, and gives what that fit gives."""
    folds = split.fold_cuts(rows, TS, n_splits=2)
    tries = [(f, p) for f in ("linear", "ridge", "lasso", "elasticnet") for p in ({}, {"regParam": 0.02})]
    alone = [training._means_over_folds(rows, TS, folds, FEATURES, Y, [t], 1)[0] for t in [("tree", {})]]
    expected = []
    for family, params in tries:
        each = []
        for _, train_end, val_end in folds:
            past, after = training.fold_parts(rows, TS, train_end, val_end)
            each.append(training.evaluate(training.fit(past, FEATURES, Y, training.build_estimator(family, params)), after, Y).first()["rmse"])
        expected.append(float(np.mean(each)))
    fits, whole = [], training.fit
    monkeypatch.setattr(training, "fit", lambda df, *a: fits.append(df.count()) or whole(df, *a))
    got = training._means_over_folds(rows, TS, folds, FEATURES, Y, [*tries, ("tree", {})], 1)
    assert sum(n > 100 for n in fits) == len(folds) and np.allclose([t.rmse for t in got], [*expected, alone[0].rmse], rtol=1e-9)


def test_condensed_rows_give_the_same_solution_or_are_refused(spark):
    draw = np.random.default_rng(2)
    table = [(float(a), float(b), 7.0, 3 * a - b + c if i % 9 else None) for i, (a, b, c) in enumerate(draw.normal(5, 2, (300, 3)).tolist() * 2)]
    df = spark.createDataFrame(table, "a double, b double, c double, y double").repartition(5)
    for family, params in [("linear", {}), ("ridge", {"regParam": 2.0}), ("lasso", {"regParam": 0.3}), ("elasticnet", {"regParam": 0.2, "elasticNetParam": 0.3})]:
        full = training.fit(df, ["a", "b", "c"], "y", training.build_estimator(family, params)).stages[-1]
        few = training.fit_condensed(training.condensed(df, ["a", "b", "c"], "y"), ["a", "b", "c"], "y", training.build_estimator(family, params)).stages[-1]
        assert np.allclose([*few.coefficients, few.intercept], [*full.coefficients, full.intercept], rtol=1e-8, atol=1e-10)
    odd = {"a null": df.withColumn("a", F.when(F.col("a") > 5, F.col("a"))), "c broken": df.withColumn("c", F.lit(0.1)), "y constant": df.withColumn("y", F.lit(2.0)),
           "none": df.limit(0), "no target": df.withColumn("y", F.lit(None).cast("double")), "a NaN": df.withColumn("a", F.lit(float("nan")))}
    assert {k for k, v in odd.items() if training.condensed(v, ["a", "b", "c"], "y") is not None} == set()
