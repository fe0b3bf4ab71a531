"""Ordered work per key without one task per key.

Lags, rolling means and as-of joins need each key's rows in time order. A plain window puts a whole
key in one task, which fails once one key holds a large share of the rows. Keys above a row target
are therefore cut into time segments of about equal size; a window then runs per (key, segment), and
the few rows that a segment needs from earlier ones are copied into it first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_ROWS = 5_000_000
MAX_SEGMENTS = 100_000
MAX_PARTS = 4_096
SEGMENT = "_segment"
CUTS = "_cuts"
BORROWED = "_borrowed"


@dataclass(frozen=True)
class Segments:
    """Cut points of the keys that are too large for one task; `cuts` is None where there are none.

    `cuts` has at most MAX_SEGMENTS rows and twice as many times (a few MB) however large the data is:
    a cut key has more than total / MAX_SEGMENTS rows and each further segment needs as many again.
    That bound is what makes broadcasting it safe.
    `heavy_ties` says that one (key, time) pair alone fills a segment.
    """

    key: str
    ts: str
    cuts: DataFrame | None = None
    heavy_ties: bool = False

    @property
    def active(self) -> bool:
        return self.cuts is not None

    @property
    def partition_columns(self) -> list[str]:
        return [self.key, SEGMENT] if self.active else [self.key]

    def window(self, order: Sequence[Column]) -> WindowSpec:
        return Window.partitionBy(*self.partition_columns).orderBy(*order)

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the segment number of each row; keys without cuts are segment 0."""
        if not self.active:
            return df
        joined = df.join(F.broadcast(self.cuts), self.key, "left")
        return joined.withColumn(SEGMENT, segment_of(F.col(CUTS), F.col(self.ts))).drop(CUTS)


def segment_of(cuts: Column, value: Column, max_cuts: int = MAX_PARTS) -> Column:
    """How many of the sorted cuts are below the value, by binary search; 0 without cuts."""
    steps = F.array(*[F.lit(1 << p) for p in reversed(range(max_cuts.bit_length()))])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda position, step: F.when(F.get(cuts, position + step - 1) < value, position + step).otherwise(position),
    )
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def plan_segments(df: DataFrame, key: str, ts: str, target_rows: int | None = None) -> Segments:
    """Measure the keys and cut those above the target.

    Reads only the key and time columns, aggregates before it shuffles, and brings a bounded number
    of rows to the driver. A table smaller than one target needs no more than its row count. Keys
    of like size share one quantile pass, so a pass returns few more times than are used.
    """
    target = target_rows or TARGET_ROWS
    total = df.count()
    if total <= target:
        return Segments(key, ts)
    floor = max(target, total // MAX_SEGMENTS)
    sizes = df.groupBy(key).count().where(F.col("count") > floor).collect()
    if not sizes:
        return Segments(key, ts)
    pieces = {row[key]: min(MAX_PARTS, math.ceil(row["count"] / floor)) for row in sizes}
    classes: dict[int, list] = {}
    for k, n in pieces.items():
        classes.setdefault(min(MAX_PARTS, 4 ** math.ceil(math.log(n, 4))), []).append(k)

    rows, heavy_ties = [], False
    for parts, keys in classes.items():
        shares = [i / parts for i in range(1, parts)]
        wanted = df.sparkSession.createDataFrame([(k,) for k in keys], T.StructType([df.schema[key]]))
        quantiles = (
            df.select(key, ts)
            .join(F.broadcast(wanted), key, "left_semi")
            .groupBy(key)
            .agg(F.percentile_approx(ts, shares, max(10_000, 4 * parts)).alias(CUTS))
            .collect()
        )
        for row in quantiles:
            n = pieces[row[key]]
            points = [row[CUTS][round(i * parts / n) - 1] for i in range(1, n)]
            distinct = sorted(set(points))
            heavy_ties = heavy_ties or len(distinct) < len(points)
            rows.append((row[key], distinct))
    schema = T.StructType([df.schema[key], T.StructField(CUTS, T.ArrayType(df.schema[ts].dataType))])
    return Segments(key, ts, df.sparkSession.createDataFrame(rows, schema), heavy_ties)


def rows_before(
    tagged: DataFrame, segments: Segments, reads: Sequence[str], lookback: int, tie: Sequence[str] = (), copies: bool = False
) -> DataFrame:
    """For each segment of a cut key, the last `lookback` rows of that key's earlier segments.

    Every segment first keeps the rows at its own last times (Spark applies that limit before the
    shuffle). Of rows with one key and time the first in tie order is taken, or all of them with `copies`.
    The window over a key's segments sees at most `lookback` rows of each of `lookback` segments.
    """
    key, ts = segments.key, segments.ts
    kept = list(dict.fromkeys([ts, *(tie if copies else ()), *reads]))
    newest = Window.partitionBy(key, SEGMENT).orderBy(F.col(ts).desc())
    own = (
        tagged.join(F.broadcast(segments.cuts.select(key)), key, "left_semi")
        .select(key, SEGMENT, *dict.fromkeys([*kept, *tie]))
        .withColumn("_rank", F.dense_rank().over(newest))
        .where(F.col("_rank") <= lookback)
        .drop("_rank")
    )
    if tie and not copies:
        first = F.min_by(F.struct(*kept), F.struct(*tie))
        own = own.groupBy(key, SEGMENT, ts).agg(first.alias("_row")).select(key, SEGMENT, "_row.*")
    if copies:
        last = Window.partitionBy(key, SEGMENT).orderBy(*[F.col(c).desc() for c in (ts, *tie)])
        own = own.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") <= lookback).drop("_rank")
    own = own.groupBy(key, SEGMENT).agg(F.sort_array(F.collect_list(F.struct(*kept))).alias("_own"))
    earlier = Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(-lookback, -1)
    return (
        own.withColumn("_before", F.flatten(F.collect_list("_own").over(earlier)))
        .withColumn("_before", F.slice("_before", F.greatest(F.size("_before") - lookback + 1, F.lit(1)), lookback))
        .select(key, SEGMENT, F.inline("_before"))
    )


def numeric_cuts(df: DataFrame, value: str, parts: int) -> list[float]:
    """Distinct inner cut points of about equal row count over a numeric column; a sketch, at most parts - 1 numbers."""
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(value, shares, max(10_000, 4 * parts)).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_part(cuts: Sequence[Column], value: Column) -> Column:
    """The number of sorted cuts below the value, for an order-preserving split of a global sequence."""
    return segment_of(F.array(*cuts), value, max_cuts=len(cuts)) if cuts else F.lit(0)
