"""Holdout by place: whole blocks of the map are kept for testing, and training stays away from their edges.

A block is a cube around the sphere, as in the nearby search. A hash of its coordinates decides whether it is held out, so the
choice needs no pass over the data and is the same in every run and for every later station. Stations within the buffer of a held-out
one are left out of training, as their demand leaks into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.geo import haversine_m
from dockcast.operators.metrics import regression_metrics
from dockcast.operators.nearby import AXES, in_cell, in_reach

DEFAULT_SIDE_M = 2_000.0
DEFAULT_SHARE = 0.2
DEFAULT_BUFFER_M = 250.0
#: Draws per block; a share is held to one part in so many.
DRAWS = 1_000_000


def block_draw(block: Column, seed: int) -> Column:
    """A number from 0 to DRAWS - 1 that depends on the block and the seed alone."""
    digits = F.substring(F.md5(F.concat(block, F.lit(f":{seed}")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % DRAWS


def with_block(stations: DataFrame, side_m: float = DEFAULT_SIDE_M) -> DataFrame:
    """Stations with `block`, the cube of that side they lie in; NULL without a position."""
    cells = in_cell(stations, side_m / 2)
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return cells.withColumn("block", F.when(placed, F.concat_ws(",", *AXES))).drop(*AXES)


def spatial_split(
    stations: DataFrame,
    side_m: float = DEFAULT_SIDE_M,
    share: float = DEFAULT_SHARE,
    buffer_m: float = DEFAULT_BUFFER_M,
    seed: int = 42,
) -> DataFrame:
    """Stations with `block` and `part`: test (held out), buffer (too close to one held out), train, or unplaced.

    Closeness is an equi-join on cubes of twice the buffer: the positions held out are listed in every cube they reach, and a station looks
    into its own. It stops at the first one found, so a crowd of stations at one place costs no more than one.
    """
    if not 0 < share < 1 or side_m <= 0 or buffer_m < 0:
        raise ValueError("share must be in (0, 1), the side positive and the buffer not negative")
    blocks = with_block(stations, side_m)
    held = block_draw(F.col("block"), seed) < F.lit(int(share * DRAWS))
    marked = blocks.withColumn("_held", F.coalesce(held, F.lit(False)))
    radius = max(buffer_m, 1.0)
    spots = marked.where("_held").select(F.col("lat").alias("_tlat"), F.col("lon").alias("_tlon")).distinct()
    reached = in_reach(spots, radius, "_tlat", "_tlon").withColumnsRenamed({a: f"_t{a}" for a in AXES})
    others = in_cell(marked.where(~F.col("_held") & F.col("block").isNotNull()).select("lat", "lon").distinct(), radius)
    same_cell = [F.col(a) == F.col(f"_t{a}") for a in AXES]
    near = haversine_m(F.col("lat"), F.col("lon"), F.col("_tlat"), F.col("_tlon")) <= F.lit(buffer_m)
    close = others.join(reached, [*same_cell, near], "left_semi").select("lat", "lon", F.lit(True).alias("_close"))
    part = (
        F.when(F.col("block").isNull(), "unplaced")
        .when(F.col("_held"), "test")
        .when(F.col("_close"), "buffer")
        .otherwise("train")
    )
    return marked.join(close, ["lat", "lon"], "left").withColumn("part", part).select(*stations.columns, "block", "part")


def holdout_by_block(rows: DataFrame, y: str, yhat: Column, key: str = "station_id") -> DataFrame:
    """Metrics per held-out block of scored rows that carry their station's block."""
    return rows.groupBy("block").agg(
        F.count_distinct(key).alias("n_stations"), F.count(F.lit(1)).alias("n_rows"), *regression_metrics(F.col(y), yhat)
    )


def profile_of(train: DataFrame, by: list[str], y: str) -> DataFrame:
    """The mean target per value of some columns: a forecast that any station can be given, with a bounded number of rows."""
    return train.groupBy(*by).agg(F.avg(y).alias("_profile"))


def spatial_holdout(
    rows: DataFrame, stations: DataFrame, y: str, by: list[str], key: str = "station_id", **options: float
) -> DataFrame:
    """How well the profile of the training stations forecasts the stations of each held-out block.

    Rows of stations in the buffer, and of stations without a position, are neither learnt from nor scored.
    """
    parts = spatial_split(stations.select(key, "lat", "lon"), **options).select(key, "block", "part")
    placed = rows.join(parts, key)
    profile = profile_of(placed.where("part = 'train'"), by, y)
    scored = placed.where("part = 'test'").join(F.broadcast(profile), by, "left")
    return holdout_by_block(scored, y, F.col("_profile"), key)
