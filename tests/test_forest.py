"""Grown forests: whole trees, the same with and without upper parts, and every tree's own values in forecasts and deviations."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockcast import catalog
from dockcast.plans import forest, training
from dockcast.session import scratch_path


def plain_branch(bins, w, y, depth):
    """Values of the rows by plain recursion over all features and bins, ties to the first."""
    out, n = np.full(len(y), (w * y).sum() / w.sum()), len(y)
    if depth == 0 or n < 2 or y.min() == y.max():
        return out
    best, at = 1e-9, None
    for f in range(len(bins)):
        for b in range(forest.BINS - 1):
            left = bins[f] <= b
            if left.any() and not left.all():
                gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (w * y).sum() ** 2 / w.sum()
                best, at = (gain, (f, b)) if gain > best + 1e-9 else (best, at)
    if at:
        left = bins[at[0]] <= at[1]
        for s in (left, ~left):
            out[s] = plain_branch(bins[:, s], w[s], y[s], depth - 1)
    return out


@pytest.mark.parametrize("n,depth", [(7, 30), (60, 30), (150, 3), (150, 30)])
def test_a_branch_is_the_tree_of_plain_recursion(n, depth):
    rng = np.random.default_rng(n)
    bins, w, y = rng.integers(0, 6, (2, n)).astype(np.uint8), rng.integers(1, 4, n).astype(float), rng.normal(size=n)
    tree, _ = forest.grow_branch(bins, w, y, 2, depth, rng)
    assert tree.value[tree.route(bins)] == pytest.approx(plain_branch(bins, w, y, depth))


def test_counted_and_sorted_nodes_have_the_same_cuts():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 40, 300)
    node, first = np.repeat(np.arange(300), sizes), np.append(0, np.cumsum(sizes)[:-1])
    values, w = rng.integers(0, forest.BINS, len(node)).astype(np.uint8), rng.integers(1, 4, len(node)).astype(float)
    wy = w * rng.normal(size=len(node))
    counted = forest.best_cut(forest.histograms(values, node, 300, w, wy))
    few = forest.best_cut_of_few(values, node, first, w, wy)
    assert counted[1] == pytest.approx(few[1])
    can = np.isfinite(few[1])
    assert [c for c, ok in zip(counted[0], can, strict=True) if ok] == [c for c, ok in zip(few[0], can, strict=True) if ok]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), float(np.sin(a) * 10 + b)) for i, (a, b) in enumerate(zip(rng.uniform(0, 6, 3000), rng.integers(0, 3, 3000), strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double").repartition(3)


def test_upper_parts_change_no_tree(table, monkeypatch):
    """With one feature nothing is left to chance but the bags, which are the same."""
    whole = forest.grow_forest(table, ["a"], "y", 6, 30, 1)
    monkeypatch.setattr(forest, "BRANCH_ROWS", 4 * 4000)
    same_blocks = forest.grow_forest(table, ["a"], "y", 6, 30, 1)
    assert all(len(t.feature) == 1 for t in [*whole.tops, *same_blocks.tops])
    real = forest.in_blocks
    monkeypatch.setattr(forest, "in_blocks", lambda *a: real(*a[:-1], 4000))
    monkeypatch.setattr(forest, "BRANCH_ROWS", 300)
    parts = forest.grow_forest(table, ["a"], "y", 6, 30, 1)
    assert all(len(t.feature) > 10 for t in parts.tops)
    a, b = ({r["id"]: r["prediction"] for r in f.transform(table).collect()} for f in (same_blocks, parts))
    assert len(a) == 3000 and b == pytest.approx(a)


def test_upper_parts_close_nodes_that_nothing_can_cut(spark, monkeypatch):
    """Two hundred rows a value: larger than a task may take, and alike in every feature."""
    monkeypatch.setattr(forest, "BRANCH_ROWS", 50)
    rows = spark.createDataFrame([(float(i % 4), 0.0, 0.0, 0.0, float(10 * (i % 4) + i % 2)) for i in range(800)], "a double, b double, c double, d double, y double")
    model = forest.grow_forest(rows, ["b", "a", "c", "d"], "y", 3, 30, 1)
    assert [len(t.feature) for t in model.tops] == [7, 7, 7]
    found = model.transform(rows).groupBy("a").agg(F.avg("prediction").alias("p"), F.avg("y").alias("y"), F.stddev_pop("prediction").alias("s")).collect()
    assert len(found) == 4 and all(abs(r["p"] - r["y"]) < 0.3 and r["s"] < 1e-9 for r in found)


def test_a_saved_forest_scores_all_rows_by_all_trees(spark, table):
    model = forest.grow_forest(table, ["a", "b"], "y", 9, 30, 3)
    path = scratch_path(spark, "grown")
    training.save_model(model, path)
    loaded = training.load_model(path)
    assert training.stored_features(spark, path) == ["a", "b"] == training.expected_features(loaded)
    found = {r["id"]: r for r in loaded.transform(table, "p", "s").collect()}
    rows = {r["id"]: r for r in table.collect()}
    ids = list(rows)
    bins = np.array([np.searchsorted(c, [rows[i][f] for i in ids]) for f, c in zip(["a", "b"], model.cuts, strict=True)]).astype(np.uint8)
    said = []
    for r in sorted(spark.read.parquet(model.nodes).collect(), key=lambda r: r["tree"]):
        kinds = (("feature", np.int16), ("cut", np.uint8), ("left", np.int32), ("value", np.float64))
        tree = forest.Tree(*(np.frombuffer(r[c], k) for c, k in kinds))
        said.append(tree.value[tree.left[tree.route(bins)]])
    assert [found[i]["p"] for i in ids] == pytest.approx(np.mean(said, axis=0))
    assert [found[i]["s"] for i in ids] == pytest.approx(np.std(said, axis=0), abs=1e-6)
    assert np.mean([(found[i]["p"] - rows[i]["y"]) ** 2 for i in ids]) < 0.2
    assert sum(model.importances) == pytest.approx(1.0) and model.importances[0] > model.importances[1]


def test_a_missing_feature_is_an_error(spark, table):
    model = forest.grow_forest(table, ["a", "b"], "y", 2, 3, 3)
    with pytest.raises(Exception, match="missing"):
        model.transform(table.withColumn("b", F.when(F.col("id") > 5, F.col("b"))))


def test_the_stored_forest_grows_whole_trees(spark, tmp_path):
    """Leaves of whole trees hold rows of one target or of one set of bins; at a depth of 8 a tree has 256 leaves at most."""
    rng, start = np.random.default_rng(4), datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=31 * i), i % 5, "view", float(v), '{"k": 1}') for i, v in enumerate(rng.uniform(0, 90, 1400).round(2))]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    metrics = {r["split"]: r for r in catalog.train_rf(spark, str(tmp_path)).collect()}
    assert set(metrics) == {"val", "test", "baseline_lag1"}
    model = training.load_model(catalog.stored_forest(spark, str(tmp_path))[1])
    assert len(model.tops) == training.DEFAULT_TREES
    leaves = [r["n"] for r in spark.read.parquet(model.nodes).select((F.length("value") / 8).alias("n")).collect()]
    assert min(leaves) > 300
