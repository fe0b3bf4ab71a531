"""Regression metrics as SQL aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(y: Column, yhat: Column) -> list[Column]:
    """rmse, mae and r2 in one pass over the rows with a target and a forecast; r2 of a constant target is 1 if every error is 0, else 0."""
    error = y - yhat
    squares = F.sum(error * error)
    scored = F.when(yhat.isNotNull(), y)
    total = F.var_pop(scored) * F.count(scored)
    r2 = F.when(total > 0, 1 - squares / total).when(squares == 0, 1.0).otherwise(0.0)
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
    ]


def mape(y: Column, yhat: Column) -> Column:
    """Mean absolute percentage error over rows with a non-zero target."""
    return (F.avg(F.when(y != 0, F.abs((y - yhat) / y))) * 100).alias("mape")


def metrics_by(df: DataFrame, by: list[str], y: str, yhat: Column) -> DataFrame:
    aggregates = regression_metrics(F.col(y), yhat)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)


def persistence(lag: str = "y_lag1") -> Column:
    """The baseline forecast: the previous value, 0 where there is none."""
    return F.coalesce(F.col(lag), F.lit(0.0))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round doubles for a report; adding 0.0 turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in names})
