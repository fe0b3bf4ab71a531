"""Model leaderboard: pivot, paths, ranking, champion, registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from dockcast.operators.contracts import ContractError, require_columns

# fixed values: column names of the wide board and the short names of its metrics
WIDE_METRICS = ("val_rmse", "val_mae", "val_r2", "test_rmse", "test_mae", "test_r2")
METRIC_ALIASES = {"rmse": "val_rmse", "mae": "val_mae", "r2": "val_r2"}
SPLIT_NAMES = {"val": "val", "validation": "val", "test": "test"}


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def canonical_split(name: Column) -> Column:
    """val, test, or NULL for a name that is neither."""
    lowered, out = F.lower(name), F.lit(None).cast("string")
    for known, canonical in SPLIT_NAMES.items():
        out = F.when(lowered == known, canonical).otherwise(out)
    return out


def resolve_metric(name: str) -> str:
    short = name.strip().lower()
    return METRIC_ALIASES.get(short, short if short in WIDE_METRICS else name)


def higher_is_better(metric: str) -> bool:
    return "r2" in metric.lower()


def wide_board(metrics: DataFrame) -> DataFrame:
    """One row per framework: smallest rmse and mae and largest r2 per split, each on its own.

    Conditional aggregates need one shuffle where a pivot per metric and two joins would need several.
    An already wide board passes through. A framework seen only under unknown split names drops out.
    """
    board = normalize_headers(metrics)
    if "val_rmse" in board.columns or "test_rmse" in board.columns:
        return board.select(*[c for c in ("framework", "model_path", *WIDE_METRICS) if c in board.columns])
    require_columns(board, "framework", "split", "rmse")
    known = board.withColumn("split", canonical_split(F.col("split"))).where(F.col("split").isNotNull())
    best = {"rmse": F.min, "mae": F.min, "r2": F.max}
    cells = [
        pick(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")
        for split in ("val", "test")
        for metric, pick in best.items()
        if metric in board.columns
    ]
    out = known.groupBy("framework").agg(*cells)
    if "model_path" in board.columns:
        paths = board.where(F.col("model_path").isNotNull()).select("framework", "model_path").distinct()
        out = out.join(paths, "framework", "left")
    return out


def fill_model_paths(board: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Add model_path from a framework → path mapping where the board has none."""
    if "model_path" in board.columns and not board.where(F.col("model_path").isNotNull()).isEmpty():
        return board
    if not paths:
        raise ContractError("no model_path on the board and no mapping")
    pairs = F.create_map(*[F.lit(x) for item in paths.items() for x in item])
    lowered = board.withColumn("framework", F.lower("framework"))
    return lowered.withColumn("model_path", pairs[F.col("framework")])


def metric_order(metric: str) -> Column:
    return F.desc_nulls_last(metric) if higher_is_better(metric) else F.asc_nulls_last(metric)


def ranking(columns: Sequence[str], metrics: Sequence[str] = ("val_rmse", "val_mae", "val_r2")) -> list[Column]:
    """Sort keys: each metric in its direction, unknown values last, the framework name as the final word."""
    return [*[metric_order(m) for m in metrics if m in columns], F.asc_nulls_last("framework")]


def rank_models(board: DataFrame, metrics: Sequence[str] = ("val_rmse", "val_mae", "val_r2")) -> DataFrame:
    """Number the rows of a board (one row per framework) from best to worst."""
    order = Window.orderBy(*ranking(board.columns, metrics))
    return board.withColumn("place", F.row_number().over(order))


def choose_best(board: DataFrame, metric: str = "val_rmse", tiebreakers: Sequence[str] = ()) -> DataFrame:
    """The winning row among those with the metric."""
    name = resolve_metric(metric)
    require_columns(board, name)
    return board.where(F.col(name).isNotNull()).orderBy(*ranking(board.columns, [name, *tiebreakers])).limit(1)


def upsert(board: DataFrame, rows: DataFrame) -> DataFrame:
    """Add the rows of frameworks that are not on the board yet."""
    missing = rows.join(board.select("framework").distinct(), "framework", "left_anti")
    return board.unionByName(missing, allowMissingColumns=True)


def champion_manifest(winner: DataFrame, metric: str, model_name: str, stage: str, champion_path: str | None = None) -> DataFrame:
    """One row that records a selection."""
    return winner.select(
        F.col("framework").alias("winner_framework"),
        F.lit(metric).alias("metric_used"),
        F.col("model_path").alias("winner_model_path"),
        F.lit(model_name).alias("registered_name"),
        F.lit(stage).alias("stage"),
        F.lit(champion_path).cast("string").alias("champion_path"),
    )


def registry_table(registrations: DataFrame, name: str = "name", at: str = "registered_at", stage: str = "Production") -> DataFrame:
    """Versions per model name in order of registration; the newest holds the stage, older ones are archived."""
    order = Window.partitionBy(name).orderBy(at)
    whole = Window.partitionBy(name)
    version = F.row_number().over(order)
    newest = version == F.count(F.lit(1)).over(whole)
    return registrations.withColumns({"version": version, "stage": F.when(newest, stage).otherwise("Archived")})


def in_production(registry: DataFrame, name: str, stage: str = "Production") -> Row:
    """The registry's row of a model that holds the stage; the newest, if several do."""
    found = registry.where((F.col("name") == name) & (F.col("stage") == stage)).orderBy(F.desc("version")).first()
    if found is None:
        raise ContractError(f"no version of {name!r} is in stage {stage!r}")
    return found


def compare_summary(board: DataFrame) -> DataFrame:
    """Number of models compared and the best value of each metric."""
    return board.agg(
        F.count_distinct("framework").alias("models_evaluated"),
        F.min("rmse").alias("best_rmse"),
        F.min("mae").alias("best_mae"),
        F.max("r2").alias("best_r2"),
    )
