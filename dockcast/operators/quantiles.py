"""Exact quantiles per group without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ONE_TASK_ROWS = 1_000_000
ACCURACY = 10_000


def grouped_quantiles(df: DataFrame, by: str, value: str, probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row per group with linearly interpolated quantiles, exact at any size.

    A small table goes through the built-in exact percentile, which keeps a group's values in one task.
    A large one first gets a sketch per group that brackets every wanted rank; only values inside a
    bracket, a few ten-thousandths of the rows, are then ordered, and the others merely counted.
    """
    known = df.where(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("_v"))
    if known.count() <= ONE_TASK_ROWS:
        return known.groupBy(by).agg(*[F.percentile("_v", p).alias(n) for p, n in zip(probabilities, names, strict=True)])
    return bracketed_quantiles(known, by, probabilities, names)


def bracketed_quantiles(known: DataFrame, by: str, probabilities: Sequence[float], names: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Quantiles of _v per group, by sketch, bracket and exact rank."""
    slack = 2.0 / accuracy
    edges = [e for p in probabilities for e in (max(0.0, p - slack), min(1.0, p + slack))]
    sketch = known.groupBy(by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.percentile_approx("_v", edges, accuracy).alias("_e")
    )
    cells = [
        F.struct(
            F.lit(i).alias("_i"),
            (F.lit(p) * (F.col("_n") - 1)).alias("_rank"),
            F.when(F.lit(p <= slack), F.col("_min")).otherwise(F.col("_e")[2 * i]).alias("_low"),
            F.when(F.lit(p >= 1 - slack), F.col("_max")).otherwise(F.col("_e")[2 * i + 1]).alias("_high"),
        )
        for i, p in enumerate(probabilities)
    ]
    brackets = sketch.select(by, F.array(*cells).alias("_brackets"))
    # the join is on the group; a large group's rows are split over tasks by the adaptive skew join
    rows = known.join(brackets, by).select(by, "_v", F.inline("_brackets"))
    side = F.when(F.col("_v") < F.col("_low"), -1).when(F.col("_v") > F.col("_high"), 1).otherwise(0)
    rows = rows.withColumn("_side", side).withColumn("_inside", F.when(F.col("_side") == 0, F.col("_v")))
    # values before a bracket become one entry that stands for their largest, values after it for their smallest
    entry = F.when(F.col("_side") < 0, F.max("_v")).otherwise(F.min("_v"))
    counts = rows.groupBy(by, "_i", "_rank", "_side", "_inside").agg(F.count(F.lit(1)).alias("_c"), entry.alias("_at"))
    order = Window.partitionBy(by, "_i").orderBy("_side", "_at")
    ranked = counts.withColumn("_upto", F.sum("_c").over(order))
    lower = F.min(F.when(F.col("_upto") > F.floor("_rank"), F.col("_at")))
    upper = F.min(F.when(F.col("_upto") > F.ceil("_rank"), F.col("_at")))
    picked = ranked.groupBy(by, "_i", "_rank").agg(lower.alias("_a"), upper.alias("_b"))
    exact = F.col("_a") + (F.coalesce("_b", "_a") - F.col("_a")) * (F.col("_rank") - F.floor("_rank"))
    wide = [F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]
    return picked.withColumn("_q", exact).groupBy(by).agg(*wide)
