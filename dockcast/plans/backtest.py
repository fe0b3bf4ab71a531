"""Expanding-window backtest: folds on global time, a persistence baseline and a model per fold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.timestamps import lit_ts
from dockcast.operators.metrics import mape, persistence, regression_metrics
from dockcast.operators.split import label_folds
from dockcast.plans.training import Folds, build_estimator, dealt_for_scoring, fit, fold_parts, in_parallel

SAMPLE_ROWS = 50


def fold_report(folded: DataFrame) -> DataFrame:
    """Rows and time range of every fold's parts."""
    return folded.groupBy("fold", "part").agg(
        F.first("train_end").alias("train_end"), F.first("val_end").alias("val_end"), F.count(F.lit(1)).alias("n_rows")
    )


def persistence_backtest(df: DataFrame, ts: str, y: str, folds: Folds) -> DataFrame:
    """The baseline's metrics on every fold's validation part, in one aggregate."""
    validation = label_folds(df, ts, folds).where("part = 'val'")
    metrics = regression_metrics(F.col(y), persistence())
    return validation.groupBy("fold", "train_end", "val_end").agg(F.count(F.lit(1)).alias("n_rows"), *metrics)


def model_backtest(
    df: DataFrame, ts: str, y: str, features: Sequence[str], folds: Folds, family: str = "forest", params: dict | None = None
) -> DataFrame:
    """Validation rows of every fold with the forecast of the model fitted on that fold's past; `df` should be a stored table."""

    def score(fold: tuple[int, datetime, datetime]) -> DataFrame:
        number, train_end, val_end = fold
        past, after = fold_parts(df, ts, train_end, val_end)
        model = fit(past, features, y, build_estimator(family, params))
        part = model.transform(dealt_for_scoring(after, model)).drop("features")
        return part.withColumns({"fold": F.lit(number), "train_end": lit_ts(train_end), "val_end": lit_ts(val_end)})

    return reduce(lambda a, b: a.unionByName(b), in_parallel(score, folds))


def backtest_summary(scored: DataFrame, y: str) -> DataFrame:
    """Model and baseline metrics per fold."""
    model = [c.alias(f"val_{n}") for c, n in zip(regression_metrics(F.col(y), F.col("prediction")), ("rmse", "mae", "r2"), strict=True)]
    base = [c.alias(f"baseline_{n}") for c, n in zip(regression_metrics(F.col(y), persistence()), ("rmse", "mae", "r2"), strict=True)]
    return scored.groupBy("fold", "train_end", "val_end").agg(*model, *base)


def sample_per_fold(scored: DataFrame, order: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The report's first rows of each fold; the limit per fold is applied before the shuffle."""
    first = Window.partitionBy("fold").orderBy(*order)
    return scored.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= rows).drop("_rn")


def error_report(scored: DataFrame, by: Sequence[str], y: Column, yhat: Column) -> DataFrame:
    """Error figures per group, such as hour and horizon."""
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *regression_metrics(y, yhat), mape(y, yhat))
