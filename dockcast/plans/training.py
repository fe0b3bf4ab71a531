"""Model training, comparison, search and scoring with MLlib; every fit is a distributed job."""

from __future__ import annotations

import math
import random
import threading
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast.functions.timestamps import lit_ts
from dockcast.functions.values import clip
from dockcast.operators import leaderboard
from dockcast.operators.encoding import kept_features, numeric_columns, screen_features
from dockcast.operators.metrics import metrics_by, regression_metrics
from dockcast.operators.split import fold_cuts
from dockcast.operators.contracts import ContractError
from dockcast.plans.forecast import require_features
from dockcast.plans.forest import GrownForest, grow_forest
from dockcast.plans.ledger import Ledger, params_text
from dockcast.session import materialize

Folds = Sequence[tuple[int, datetime, datetime]]

# fixed values: sizes of the original jobs
DEFAULT_TREES = 300
DEFAULT_SEED = 42
DEFAULT_BUDGET_SECONDS = 600
DEFAULT_TUNE_ITERATIONS = 50
MIN_SLOT_ROWS = 100
MAX_TREE_DEPTH = 30
PARALLEL_FITS = 4
DEFAULT_ETA = 3
BRACKET = 9
#: Rows of a rung are so many hash parts out of this number.
RUNG_PARTS = 10_000
LEAST_RUNG_ROWS = 1_000
INTERVAL_Z = 1.96
WEIGHT = "_weight_of_condensed"
_NOT_RECIPE = ("featuresCol", "labelCol", "predictionCol", "weightCol", "leafCol", "seed", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval")
SLOT_NON_FEATURES = ("station_id", "t_slot", "slot_label", "generated_from", "y")

LEAST_HISTOGRAM_MB, MOST_HISTOGRAM_MB = 256, 1024
# families that grow trees level by level; which node a row is in is kept between levels, and that chain is cut every few of them
_GROWN = ("forest", "boosted")
_GROWTH = {"cacheNodeIds": True, "checkpointInterval": 10}
# a task's share of a fit in cells, a cell being a row in one tree (about 15 bytes of a task's cached block with its node id, a third without).
# Below the least, tasks cost more than their work; above the most, blocks outgrow a task
LEAST_TASK_CELLS, MOST_TASK_CELLS = 1_000_000, 16_000_000
#: A task's share of a scoring; a cell takes about a microsecond.
SCORED_TASK_CELLS = 2_000_000
#: Rows of a fit without many trees weigh as much as those of so many.
LEAST_TREES = 20
#: Node ids of more cells than this are not kept if trees are shallow: finding a row's node again costs less than what the ids push out of memory.
MOST_NODE_ID_CELLS, SHALLOW = 1_000_000_000, 10
#: Forests that may have more nodes than this are kept as a table (`forest.py`); an MLlib model holds all of them in the driver.
MOST_MODEL_NODES = 100_000
_GROWN_PARAMS = {"featuresCol", "labelCol", "predictionCol", "seed", "numTrees", "maxDepth", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval"}
#: Families by what their fits take, longest first, so that none of them starts last.
_LONG_FITS = ("boosted", "huber", "forest", "tree")
_INTEGER_PARAMS = ("numTrees", "maxDepth", "maxBins", "maxIter", "minInstancesPerNode")
_ROUNDS = ("numTrees", "maxIter")
#: Tables with more features are not condensed: every task sends the driver the square of so many numbers.
MOST_CONDENSED_FEATURES = 200
#: Families whose fit depends on the rows by their means and covariances alone.
_LEAST_SQUARES = ("linear", "ridge", "lasso", "elasticnet")
_FAMILIES: dict[str, tuple[type, dict[str, Any]]] = {
    "linear": (LinearRegression, {}),
    "ridge": (LinearRegression, {"regParam": 1.0, "elasticNetParam": 0.0}),
    "lasso": (LinearRegression, {"regParam": 1.0, "elasticNetParam": 1.0}),
    "elasticnet": (LinearRegression, {"regParam": 1.0, "elasticNetParam": 0.5}),
    "huber": (LinearRegression, {"loss": "huber"}),
    "tree": (DecisionTreeRegressor, {"maxDepth": 8}),
    "forest": (RandomForestRegressor, {"numTrees": 20, "maxDepth": 8}),
    "boosted": (GBTRegressor, {"maxIter": 20}),
}
SEARCH_SPACE: dict[str, dict[str, tuple[float, float]]] = {
    "linear": {"regParam": (0.0, 0.1)},
    "huber": {"epsilon": (1.05, 2.5), "regParam": (0.0, 1.0)},
    "ridge": {"regParam": (0.001, 10.0)},
    "lasso": {"regParam": (0.001, 1.0)},
    "elasticnet": {"regParam": (0.001, 1.0), "elasticNetParam": (0.05, 0.95)},
    "tree": {"maxDepth": (2, 10), "minInstancesPerNode": (1, 50)},
    "forest": {"numTrees": (5, 40), "maxDepth": (3, 10), "minInstancesPerNode": (1, 20)},
    "boosted": {"maxIter": (5, 30), "maxDepth": (2, 6), "stepSize": (0.05, 0.3)},
}


def histogram_mb(depth: int, bins: int, features: int = 100) -> int:
    """Memory for the histograms of a level: as many nodes as a level of this depth can hold, within bounds.

    Nodes that do not fit wait for another pass over the rows, so a deep tree with too little of it reads the rows again and again.
    """
    nodes = 1 << min(depth, 14)
    return int(min(MOST_HISTOGRAM_MB, max(LEAST_HISTOGRAM_MB, nodes * bins * features * 3 * 8 >> 20)))


def build_estimator(name: str, params: Mapping[str, Any] | None = None, seed: int = DEFAULT_SEED, label: str = "label"):
    """An estimator by family name; whole-number parameters may arrive as floats."""
    family = name.lower()
    if family not in _FAMILIES:
        raise ValueError(f"unknown model family {name!r}; known: {sorted(_FAMILIES)}")
    kind, defaults = _FAMILIES[family]
    chosen = {**defaults, **(params or {})}
    chosen = {k: int(round(v)) if k in _INTEGER_PARAMS else v for k, v in chosen.items()}
    if family in _GROWN:
        # boosting grows one tree at a time: in a shallow one a row's node is found again in less time than it takes to keep it
        kept = family != "boosted" or chosen.get("maxDepth", 5) > SHALLOW
        chosen = {**_GROWTH, "cacheNodeIds": kept, "maxMemoryInMB": histogram_mb(chosen.get("maxDepth", 5), chosen.get("maxBins", 32)), **chosen}
    estimator = kind(featuresCol="features", labelCol=label, predictionCol="prediction", **chosen)
    return estimator.setSeed(seed) if estimator.hasParam("seed") else estimator


def task_count(cells: int, parts: int) -> int:
    """So many tasks as there are, unless a task's share of the cells would be too small or too large."""
    least, most = math.ceil(cells / MOST_TASK_CELLS), math.ceil(cells / LEAST_TASK_CELLS)
    return max(1, least, min(parts, most))


def dealt(rows: DataFrame, cells: int) -> DataFrame:
    """The rows over as many tasks as their cells ask for; small tables keep their tasks or merge them, without a shuffle."""
    parts = rows.rdd.getNumPartitions()
    wanted = task_count(cells, parts)
    return rows if wanted == parts else rows.coalesce(wanted) if wanted < parts else rows.repartition(wanted)


def _trees(stage) -> int:
    """Trees that hold every row at the same time."""
    return int(stage.getOrDefault("numTrees")) if stage.hasParam("numTrees") else 1


def dealt_for_scoring(df: DataFrame, model: PipelineModel | GrownForest, times: int = 1) -> DataFrame:
    """Rows that a large forest scores, over as many tasks as that takes; other models score rows as they are read, or deal them themselves."""
    if isinstance(model, GrownForest):
        return df
    trees = _trees(model.stages[-1])
    if trees <= LEAST_TREES:
        return df
    wanted = math.ceil(df.count() * trees * times / SCORED_TASK_CELLS)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def outgrows_driver(estimator, rows: int) -> bool:
    """Whether this is a plain forest that may get more nodes than the driver should hold."""
    if not isinstance(estimator, RandomForestRegressor) or not {p.name for p in estimator.params if estimator.isSet(p)} <= _GROWN_PARAMS:
        return False
    return estimator.getNumTrees() * min(2 << estimator.getMaxDepth(), 2 * rows) > MOST_MODEL_NODES


def fit(df: DataFrame, features: Sequence[str], label: str, estimator) -> PipelineModel | GrownForest:
    """Fit on the rows with a known target, weighted if the estimator says so. The feature list lives in the model's first stage.

    A fit goes over its rows once per level or step, so they are dealt to tasks by what a task has to hold of them, not by the files they come from.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    known = df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))
    known = known.select(*features, label, *([estimator.getWeightCol()] if estimator.hasParam("weightCol") and estimator.isSet("weightCol") else []))
    trees, n_rows = _trees(estimator), known.count()
    cells = n_rows * max(trees, LEAST_TREES)
    if outgrows_driver(estimator, n_rows):
        return grow_forest(dealt(known, cells), features, label, trees, estimator.getMaxDepth(), estimator.getSeed())
    if trees > 1 and cells > MOST_NODE_ID_CELLS and estimator.getMaxDepth() <= SHALLOW:
        estimator = estimator.copy().setCacheNodeIds(False)
    return Pipeline(stages=[assembler, estimator.setLabelCol(label)]).fit(dealt(known, cells))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of doubles to one row of a task: how many, their means, and the sums of products of what they differ by from these."""
    n, mean, products = 0, None, None
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if len(x):
            own = x.mean(axis=0)
            part = (len(x), own, (x - own).T @ (x - own))
            n, mean, products = part if n == 0 else _joined_moments((n, mean, products), part)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])], ["n", "mean", "products"])


def _joined_moments(a: tuple, b: tuple) -> tuple:
    n, off = a[0] + b[0], b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * b[0] / n)


def condensed(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame | None:
    """A few weighted rows with the number, means and covariances of all rows with a known target, by one pass over these.

    Least squares with any penalty has the same solution on them, so many tries need not read all rows again. None where
    that would not be safe: missing values, columns that hardly vary, no rows. A column of one whole number is safe, as its sums are exact.
    """
    names = [*features, label]
    if len(features) > MOST_CONDENSED_FEATURES:
        return None
    known = rows.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)])
    found = known.mapInArrow(_moments, "n long, mean array<double>, products array<double>").orderBy("n", "mean").collect()
    if not found:
        return None
    size = len(names)
    parts = [(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(size, size)) for r in found]
    n, mean, products = parts[0]
    for part in parts[1:]:
        n, mean, products = _joined_moments((n, mean, products), part)
    spread = np.sqrt(np.diag(products) / n)
    if not (np.isfinite(mean).all() and np.isfinite(products).all()):
        return None
    constant = (spread == 0) & (mean == np.round(mean)) & (np.abs(mean) < 1 << 20)
    if not (constant | (spread > 1e-9 * np.maximum(1.0, np.abs(mean)))).all() or constant[-1]:
        return None
    scale = np.where(constant, 1.0, spread)
    values, vectors = np.linalg.eigh(products / n / np.outer(scale, scale))
    root = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    # orthonormal columns that are orthogonal to a column of ones: a reflection that takes the first axis to it
    m = 1 << size.bit_length()
    axis = np.full(m, m**-0.5)
    axis[0] -= 1
    turn = np.eye(m) - 2 * np.outer(axis, axis) / (axis @ axis)
    points = mean + m**0.5 * (turn[:, 1 : size + 1] @ root) * spread
    schema = ", ".join(f"`{c}` double" for c in names) + f", {WEIGHT} double"
    return rows.sparkSession.createDataFrame([(*p, n / m) for p in points.tolist()], schema).coalesce(1)


def fit_condensed(points: DataFrame, features: Sequence[str], label: str, estimator) -> PipelineModel:
    """A least squares fit on condensed rows."""
    return fit(points, features, label, estimator.copy().setWeightCol(WEIGHT))


def expected_features(model: PipelineModel | GrownForest) -> list[str]:
    return model.features if isinstance(model, GrownForest) else model.stages[0].getInputCols()


def stored_features(spark: SparkSession, path: str, training: DataFrame | None = None, leave_out: Sequence[str] = ()) -> list[str]:
    """The features of a saved model, from the metadata of its first stage; without such metadata, the numeric columns of its training table."""
    if (grown := GrownForest.load(spark, path)) is not None:
        return grown.features
    try:
        found = spark.read.json(f"{path}/stages/0_VectorAssembler*/metadata").select("paramMap.inputCols").first()
    except AnalysisException:
        found = None
    if found is not None and found["inputCols"]:
        return list(found["inputCols"])
    if training is None:
        raise ContractError(f"the model under {path} does not say its features, and there is no training table to ask")
    return [c for c in numeric_columns(training) if c not in leave_out]


def recipe_of(model: PipelineModel) -> tuple[str, dict[str, Any]]:
    """Family and parameters of a fitted model, enough to fit it anew."""
    stage = model.stages[-1]
    kinds = {name: kind for name, (kind, _) in _FAMILIES.items()}
    same = [name for name, kind in kinds.items() if type(stage).__name__.startswith(kind.__name__.removesuffix("or"))]
    if not same:
        raise ContractError(f"no family fits a {type(stage).__name__}")
    estimator = kinds[same[0]]()
    names = [p.name for p in estimator.params if p.name not in _NOT_RECIPE and stage.hasParam(p.name) and stage.isSet(p.name)]
    params = {n: stage.getOrDefault(n) for n in names}
    if kinds[same[0]] is LinearRegression:
        shrunk, mix = params.get("regParam", 0.0) > 0, params.get("elasticNetParam", 0.0)
        family = "huber" if params.get("loss") == "huber" else "linear" if not shrunk else "ridge" if mix == 0 else "lasso" if mix == 1 else "elasticnet"
        return family, params
    return same[0], params


def model_scorer(
    model: PipelineModel | GrownForest, leaf: bool = False, absent_as_zero: bool = False, names: Sequence[str] = ()
) -> Callable[[DataFrame, Mapping[str, Column], str], DataFrame]:
    """Score a table whose features are expressions. An absent feature is an error unless it is asked to count as 0.

    With `leaf`, what an interval needs comes along: the leaf of every tree, or the deviation of a grown forest's trees.
    """
    names = list(names) or expected_features(model)
    predictor = model if isinstance(model, GrownForest) else model.stages[-1].copy()

    def score(df: DataFrame, features: Mapping[str, Column], output: str) -> DataFrame:
        if not absent_as_zero:
            require_features(names, features)
        cells = [F.coalesce(features[c], F.lit(0.0)) if c in features else F.lit(0.0) for c in names]
        inputs = df.withColumn("_inputs", F.struct(*[e.cast("double").alias(c) for e, c in zip(cells, names, strict=True)]))
        assembler = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(names))], outputCol="_features")
        wide = inputs.withColumns({f"_f{i}": F.col(f"_inputs.`{c}`") for i, c in enumerate(names)})
        if isinstance(predictor, GrownForest):
            grown = replace(predictor, features=[f"_f{i}" for i in range(len(names))])
            scored = grown.transform(wide, output, f"_spread{output}" if leaf else None)
            return scored.drop("_inputs", *grown.features)
        stage = predictor.copy().setFeaturesCol("_features").setPredictionCol(output)
        if leaf:
            stage = stage.setLeafCol(f"_leaf{output}")
        scored = stage.transform(assembler.transform(wide))
        return scored.drop("_inputs", "_features", *[f"_f{i}" for i in range(len(names))])

    return score


def stored_leaves(spark: SparkSession, path: str) -> DataFrame:
    """The leaves of a saved forest as a table: tree, leaf (left to right, as the leaf column counts them) and its value.

    Nodes are saved in the order of a walk from the root, left before right, so leaves are numbered by the order of their ids.
    """
    nodes = spark.read.parquet(f"{path}/stages/*_RandomForestRegress*/data").select("treeID", "nodeData.*")
    order = Window.partitionBy("treeID").orderBy("id")
    leaves = nodes.where(F.col("leftChild") < 0)
    return leaves.select(F.col("treeID").alias("tree"), (F.row_number().over(order) - 1).alias("leaf"), F.col("prediction").alias("value"))


def tree_spread(scored: DataFrame, leaves: DataFrame, row: str, outputs: Sequence[str]) -> DataFrame:
    """Per row and output the population deviation of the trees' own values: an equi-join of every (tree, leaf) that a row falls into."""
    cells = [F.struct(F.lit(i).alias("output"), F.col(f"_leaf{o}").alias("leaves")) for i, o in enumerate(outputs)]
    each = scored.select(row, F.explode(F.array(*cells)).alias("cell")).select(row, "cell.output", F.posexplode("cell.leaves").alias("tree", "leaf"))
    met = each.select(row, "output", "tree", F.col("leaf").cast("int").alias("leaf")).join(leaves, ["tree", "leaf"])
    per_output = met.groupBy(row, "output").agg(F.stddev_pop("value").alias("spread"))
    return per_output.groupBy(row).agg(*[F.max(F.when(F.col("output") == i, F.col("spread"))).alias(f"_spread{o}") for i, o in enumerate(outputs)])


def forest_interval(leaves: DataFrame) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """Adds forecast ± 1.96 population deviations over the trees as `_lo` and `_hi` of each output; rows must carry their leaf columns."""
    table = materialize(leaves, "leaves")

    def add(scored: DataFrame, outputs: Sequence[str]) -> DataFrame:
        plain = scored.withColumns({f"_leaf{o}": vector_to_array(F.col(f"_leaf{o}")) for o in outputs})
        rows = materialize(plain.withColumn("_row", F.monotonically_increasing_id()), "scored")
        met = rows.join(tree_spread(rows, table, "_row", outputs), "_row", "left")
        return spread_interval(met, outputs).drop("_row")

    return add


def spread_interval(scored: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """The interval of rows that carry the deviation over the trees."""
    bounds = {}
    for o in outputs:
        half = F.lit(INTERVAL_Z) * F.col(f"_spread{o}")
        bounds |= {f"_lo{o}": F.col(o) - half, f"_hi{o}": F.col(o) + half}
    return scored.withColumns(bounds).drop(*[f"_spread{o}" for o in outputs])


def stored_interval(spark: SparkSession, path: str) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """The interval of a saved forest: a grown one has the deviation of its trees already, as rows meet all its leaves when they are scored."""
    return forest_interval(stored_leaves(spark, path)) if GrownForest.load(spark, path) is None else spread_interval


def evaluate(model: PipelineModel | GrownForest, df: DataFrame, label: str, by: Sequence[str] = (), lower: float | None = None) -> DataFrame:
    """rmse, mae and r2 of a model, per group if asked; forecasts are held above `lower` first."""
    scored = model.transform(dealt_for_scoring(df, model))
    yhat = clip(F.col("prediction"), lower) if lower is not None else F.col("prediction")
    if by:
        return metrics_by(scored, list(by), label, yhat)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), *regression_metrics(F.col(label), yhat))


def train_forest(
    labelled: DataFrame, features: Sequence[str], label: str, trees: int = DEFAULT_TREES, depth: int = MAX_TREE_DEPTH, seed: int = DEFAULT_SEED
) -> tuple[PipelineModel | GrownForest, DataFrame]:
    """The baseline forest on the training rows, and its metrics per split."""
    model = fit(labelled.where("split = 'train'"), features, label, build_estimator("forest", {"numTrees": trees, "maxDepth": depth}, seed))
    return model, evaluate(model, labelled.where("split <> 'train'"), label, ["split"])


def feature_importance(spark: SparkSession, model: PipelineModel | GrownForest) -> DataFrame:
    """Importance per feature; one row per model input."""
    weights = model.importances if isinstance(model, GrownForest) else model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(expected_features(model), weights, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double")


METRIC_SCHEMA = "trial int, framework string, params string, rmse double, mae double, r2 double, rung int, cost_s double"


@dataclass(frozen=True)
class Trial:
    """One candidate: a family, its parameters and what it scored."""

    family: str
    params: dict[str, Any]
    rmse: float
    mae: float
    r2: float
    rung: int = 0
    cost_s: float = 0.0

    def better_than(self, other: Trial | None, metric: str) -> bool:
        if other is None:
            return True
        mine, theirs = getattr(self, metric), getattr(other, metric)
        return mine > theirs if metric == "r2" else mine < theirs


def trials_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    rows = [(i, t.family, params_text(t.params), t.rmse, t.mae, t.r2, t.rung, t.cost_s) for i, t in enumerate(trials)]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def in_parallel(work: Callable[[Any], Any], items: Sequence[Any], width: int = PARALLEL_FITS) -> list[Any]:
    """Run independent driver-side fits side by side, so that the cluster is not idle between their small jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(items)))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), items))


class Past:
    """The rows that several fits learn from; those of least squares share one pass over them."""

    def __init__(self, rows: DataFrame):
        self.rows, self._lock, self._condensed = rows, threading.Lock(), []

    def condensed(self, features: Sequence[str], label: str) -> DataFrame | None:
        with self._lock:
            if not self._condensed:
                self._condensed.append(condensed(self.rows, features, label))
            return self._condensed[0]

    def fit(self, features: Sequence[str], label: str, family: str, estimator) -> PipelineModel:
        few = self.condensed(features, label) if family in _LEAST_SQUARES else None
        return fit(self.rows, features, label, estimator) if few is None else fit_condensed(few, features, label, estimator)


def _scored(
    past: DataFrame | Past, after: DataFrame, fold: str, features: Sequence[str], label: str, family: str, params: Mapping[str, Any], seed: int,
    ledger: Ledger | None, lower: float | None = None,
) -> Mapping[str, float]:
    """Scores of one fit, from the ledger if it has them."""

    def work() -> Mapping[str, float]:
        estimator = build_estimator(family, params, seed)
        model = past.fit(features, label, family, estimator) if isinstance(past, Past) else fit(past, features, label, estimator)
        return evaluate(model, after, label, lower=lower).first().asDict()

    if ledger is not None:
        return ledger.measure(family, params, fold, features, seed, work)
    started = time.monotonic()
    return {**work(), "cost_s": time.monotonic() - started}


def _means_over_folds(
    rows: DataFrame, ts: str, folds: Folds, features: Sequence[str], label: str, candidates: Sequence[tuple[str, Mapping[str, Any]]], seed: int,
    ledger: Ledger | None = None,
) -> list[Trial]:
    """Fit every candidate on each fold's past, score on what follows it, and average the folds. All those fits run side by side, long ones first.

    A fold's least squares fits share one pass over its past.
    """
    parts = {fold: fold_parts(rows, ts, *fold[1:]) for fold in folds}
    pasts = {fold: Past(past) for fold, (past, _) in parts.items()}

    def score(item: tuple[int, tuple[int, datetime, datetime]]) -> Mapping[str, float]:
        (family, params), (_, train_end, val_end) = candidates[item[0]], item[1]
        name = f"{train_end.isoformat()}/{val_end.isoformat()}"
        return _scored(pasts[item[1]], parts[item[1]][1], name, features, label, family, params, seed, ledger)

    length = {family: -i for i, family in enumerate(reversed(_LONG_FITS), start=1)}
    items = sorted(((i, fold) for i in range(len(candidates)) for fold in folds), key=lambda x: length.get(candidates[x[0]][0], 0))
    found: dict[int, list[Mapping[str, float]]] = {i: [] for i in range(len(candidates))}
    for (i, _), scored in zip(items, in_parallel(score, items), strict=True):
        found[i].append(scored)
    trials = []
    for i, (family, params) in enumerate(candidates):
        rmse, mae, r2 = (float(np.mean([s[m] for s in found[i]])) for m in ("rmse", "mae", "r2"))
        trials.append(Trial(family, dict(params), rmse, mae, r2, cost_s=float(sum(s["cost_s"] for s in found[i]))))
    return trials


def fold_parts(rows: DataFrame, ts: str, train_end: datetime, val_end: datetime) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut, and the validation rows after it; plain time filters on one stored table."""
    at, cut = F.col(ts), lit_ts(train_end)
    return rows.where(at <= cut), rows.where((at > cut) & (at <= lit_ts(val_end)))


def compare_models(
    rows: DataFrame,
    ts: str,
    folds: Folds,
    features: Sequence[str],
    label: str,
    families: Sequence[str] = tuple(_FAMILIES),
    metric: str = "rmse",
    seed: int = DEFAULT_SEED,
    ledger: Ledger | None = None,
) -> list[Trial]:
    """Every family on the expanding folds, best first. `rows` should be a stored table: all fits read it."""
    trials = _means_over_folds(rows, ts, folds, features, label, [(family, {}) for family in families], seed, ledger)
    return sorted(trials, key=lambda t: -t.r2 if metric == "r2" else getattr(t, metric))


def sample_params(family: str, rng: random.Random) -> dict[str, float]:
    return {k: rng.uniform(low, high) for k, (low, high) in SEARCH_SPACE.get(family, {}).items()}


def tune_model(
    rows: DataFrame,
    ts: str,
    folds: Folds,
    features: Sequence[str],
    label: str,
    base: Trial,
    iterations: int = DEFAULT_TUNE_ITERATIONS,
    metric: str = "rmse",
    seed: int = DEFAULT_SEED,
    ledger: Ledger | None = None,
) -> Trial:
    """Random search around one family on the folds; the original stays unless something beats it."""
    if base.family not in SEARCH_SPACE:
        return base
    rng, best = random.Random(seed), base
    tries = [(base.family, sample_params(base.family, rng)) for _ in range(iterations)]
    for trial in _means_over_folds(rows, ts, folds, features, label, tries, seed, ledger):
        best = trial if trial.better_than(best, metric) else best
    return best


def with_share(family: str, params: Mapping[str, Any], share: float) -> dict[str, Any]:
    """Parameters with the trees or boosting rounds that go with a share of the rows."""
    whole = {**_FAMILIES[family][1], **params}
    return {k: max(2, round(v * share)) if k in _ROUNDS else v for k, v in whole.items()} if share < 1 else dict(params)


def halving(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    label: str,
    candidates: Sequence[tuple[str, Mapping[str, Any]]],
    eta: int = DEFAULT_ETA,
    metric: str = "rmse",
    seed: int = DEFAULT_SEED,
    ledger: Ledger | None = None,
    least_rows: int = LEAST_RUNG_ROWS,
) -> list[Trial]:
    """Successive halving: all candidates on a share of the rows, trees and rounds, the best of every rung on eta times as much.

    A rung has at least `least_rows` rows, as a choice among fits on fewer would be chance; a small table is searched in one rung. The last rung fits on all rows with all trees and rounds, so its scores compare with any other full fit. Rows of a lower rung are
    chosen by a hash of their values: the same in every run, and a part of the next rung's rows.
    """
    last, live, trials = 0, list(candidates), []
    n_rows = train.count()
    while eta ** (last + 1) <= min(len(live), n_rows / least_rows):
        last += 1
    for rung in range(last + 1):
        share = float(eta) ** (rung - last)
        chosen = F.pmod(F.xxhash64(*features, label), F.lit(RUNG_PARTS)) < F.lit(int(share * RUNG_PARTS))
        rows = train if rung == last else train.where(chosen)

        def fit_one(candidate: tuple[str, Mapping[str, Any]], rows=rows, share=share, rung=rung) -> tuple[Trial, tuple]:
            family, params = candidate
            own = with_share(family, params, share)
            s = _scored(rows, val, f"holdout/{share:.6f}", features, label, family, own, seed, ledger, lower=0.0)
            return Trial(family, dict(params), s["rmse"], s["mae"], s["r2"], rung, s["cost_s"]), candidate

        scored = in_parallel(fit_one, live)
        trials += [t for t, _ in scored]
        ranked = sorted(scored, key=lambda x: -x[0].r2 if metric == "r2" else getattr(x[0], metric))
        live = [c for _, c in ranked[: max(1, len(ranked) // eta)]]
    return trials


def budget_search(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    label: str,
    seconds: float = DEFAULT_BUDGET_SECONDS,
    metric: str = "rmse",
    seed: int = DEFAULT_SEED,
    families: Sequence[str] = tuple(SEARCH_SPACE),
    max_trials: int | None = None,
    ledger: Ledger | None = None,
) -> tuple[Trial, list[Trial]]:
    """Search on a fixed holdout within a time budget; the first bracket has every family's default, later ones random candidates.

    A bracket is a successive halving. Another one is started only if the one before shows that it can end in time, by what its fits cost. The
    winner is the best of the last rungs, whose fits saw all rows.
    """
    rng, started = random.Random(seed), time.monotonic()
    train, val = (materialize(d.select(*features, label), "search") for d in (train, val))
    candidates = [(f, {}) for f in families]
    best, trials = None, []
    while True:
        began = time.monotonic()
        tried = halving(train, val, features, label, candidates, metric=metric, seed=seed, ledger=ledger)
        trials += tried
        for t in tried:
            if t.rung == max(x.rung for x in tried):
                best = t if t.better_than(best, metric) else best
        spent = time.monotonic() - began
        if time.monotonic() - started + spent > seconds or (max_trials is not None and len(trials) >= max_trials):
            return best, trials
        candidates = [(f, sample_params(f, rng)) for f in (rng.choice(list(families)) for _ in range(BRACKET))]


def refit(full: DataFrame, features: Sequence[str], label: str, winner: Trial, seed: int = DEFAULT_SEED) -> PipelineModel:
    """The winner's family and parameters on all given rows."""
    return fit(full, features, label, build_estimator(winner.family, winner.params, seed))


REFIT_MODES = ("trainval", "curated")


def refit_rows(labelled: DataFrame, mode: str) -> DataFrame:
    """What a champion is refitted on: training and validation rows, or the whole curated table."""
    if mode not in REFIT_MODES:
        raise ValueError(f"mode must be one of {REFIT_MODES}, not {mode!r}")
    return labelled.where("split <> 'test'") if mode == "trainval" else labelled


def refit_registered(
    spark: SparkSession, registry: DataFrame, name: str, labelled: DataFrame, label: str, mode: str = "trainval", seed: int = DEFAULT_SEED
) -> tuple[str, PipelineModel]:
    """The model that the registry has in production, fitted anew: its stored version tells the family, the parameters and the features."""
    entry = leaderboard.in_production(registry, name)
    family, params = recipe_of(load_model(entry["model_path"]))
    features = stored_features(spark, entry["model_path"], labelled.where("split = 'train'"), (label, "split"))
    return family, fit(refit_rows(labelled, mode), features, label, build_estimator(family, params, seed))


def slot_feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns of the slot features that are known often enough and vary."""
    candidates = [c for c in numeric_columns(df) if c not in SLOT_NON_FEATURES]
    return kept_features(screen_features(df, candidates))


@dataclass(frozen=True)
class SlotModel:
    label: str
    features: list[str]
    model: PipelineModel
    trials: list[Trial]

    def save(self, base: str) -> str:
        """Stored under the slot's name without what a path cannot hold."""
        path = f"{base}/{self.label.replace(':', '')}"
        save_model(self.model, path)
        return path


def load_slot_model(spark: SparkSession, path: str, label: str, training: DataFrame | None = None) -> SlotModel:
    """A slot's stored model with the features that its own metadata names."""
    return SlotModel(label, stored_features(spark, path, training, SLOT_NON_FEATURES), load_model(path), [])


def train_slot(
    features_table: DataFrame, slot: str, n_splits: int, families: Sequence[str], min_rows: int = MIN_SLOT_ROWS, seed: int = DEFAULT_SEED
) -> SlotModel | None:
    """Compare families for one slot on temporal folds by mae and refit the best on all its rows; None below `min_rows`."""
    rows = features_table.where((F.col("slot_label") == slot) & F.col("y").isNotNull())
    n_rows = rows.count()
    if n_rows < min_rows:
        return None
    names = slot_feature_columns(rows)
    if not names:
        return None
    doubles = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names]
    # all fits of the slot read it, so it is a table of its own, without the other slots' rows
    filled = rows.select("t_slot", F.col("y").cast("double").alias("y"), *doubles)
    filled = materialize(dealt(filled, n_rows * LEAST_TREES), "slot_rows")
    trials = compare_models(filled, "t_slot", fold_cuts(filled, "t_slot", n_splits), names, "y", families, "mae", seed)
    return SlotModel(slot, names, refit(filled, names, "y", trials[0], seed), trials)


def train_slots(
    features_table: DataFrame, slots: Sequence[str], n_splits: int = 5, families: Sequence[str] = tuple(_FAMILIES), min_rows: int = MIN_SLOT_ROWS
) -> list[SlotModel]:
    """One model per slot that has enough rows. `features_table` should be a stored table."""
    found = in_parallel(lambda slot: train_slot(features_table, slot, n_splits, families, min_rows), slots)
    return [m for m in found if m]


def predict_slots(features_table: DataFrame, models: Sequence[SlotModel]) -> DataFrame:
    """Score each slot's rows with its own model and exactly the features it was trained on."""
    if not models:
        raise ContractError("no slot model")
    parts = []
    for slot in models:
        rows = features_table.where(F.col("slot_label") == slot.label)
        inputs = rows.select("station_id", "t_slot", "slot_label", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in slot.features])
        scored = slot.model.transform(inputs).withColumnRenamed("prediction", "yhat")
        parts.append(scored.select("station_id", "t_slot", "slot_label", "yhat", F.current_timestamp().alias("generated_at")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def save_model(model: PipelineModel | GrownForest, path: str) -> None:
    if isinstance(model, GrownForest):
        model.save(path)
    else:
        model.write().save(path)


def load_model(path: str) -> PipelineModel | GrownForest:
    return GrownForest.load(SparkSession.active(), path) or PipelineModel.load(path)
