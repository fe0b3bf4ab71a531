"""Map-ready tables: tiles, the serving map, nearby recommendations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.display import (
    capacity_column,
    capacity_metrics,
    level,
    level_color,
    light_hex,
    light_label,
    light_rgb,
)
from dockcast.functions.values import clip, round_half_even, to_numeric
from dockcast.operators.history import latest_per_key
from dockcast.operators.nearby import top_nearby, within_radius
from dockcast.operators.contracts import require_columns
from dockcast.sources import io

MAX_BROADCAST_STATIONS = 500_000
TILE_COLUMNS = ["station_id", "name", "lat", "lon", "timestamp_pred", "h", "yhat", "level", "color"]
GOOD_LIGHTS = ("verde", "amarillo")


def enrich(predictions: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of the station columns; the stations are broadcast only if their count allows it."""
    small = stations.count() <= MAX_BROADCAST_STATIONS
    return predictions.join(F.broadcast(stations) if small else stations, "station_id", "left")


def tiles(predictions: DataFrame, stations: DataFrame, null_as_na: bool = False) -> DataFrame:
    """One coloured tile per prediction. An unknown forecast counts as 0 unless `null_as_na`."""
    require_columns(predictions, "station_id", "yhat", "timestamp_pred", "h")
    require_columns(stations, "station_id", "lat", "lon")
    value = to_numeric(F.col("yhat"))
    if not null_as_na:
        value = F.coalesce(value, F.lit(0.0))
    joined = enrich(predictions, stations).withColumn("yhat", clip(value, 0.0))
    leveled = joined.withColumn("level", level(F.col("yhat")))
    coloured = leveled.withColumn("color", level_color(F.col("level")))
    return coloured.select(*[c for c in TILE_COLUMNS if c in coloured.columns])


def publish_tiles(predictions: DataFrame, stations: DataFrame, base: str, asof: datetime, step_minutes: int, null_as_na: bool = False) -> str:
    """Publish the tiles of a forecast as a version of their own."""
    return io.publish(tiles(predictions, stations, null_as_na), base, asof, step_minutes)


def serving_map(predictions: DataFrame, stations: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The latest prediction per station with capacity figures, rounded to one decimal before the light is chosen."""
    latest = latest_per_key(predictions, "station_id", order) if order else predictions
    joined = enrich(latest, stations).withColumn("yhat", to_numeric(F.col("yhat")))
    joined = joined.withColumn("capacity", capacity_column(joined.columns))
    metrics = capacity_metrics(F.col("yhat"), F.col("capacity"))
    joined = joined.withColumns(metrics)
    joined = joined.withColumns({c: round_half_even(F.col(c), 1) for c in ("yhat", *metrics)})
    labelled = joined.withColumn("light", light_label(F.col("pct_bikes"), F.col("yhat")))
    return labelled.withColumns({"color_rgb": light_rgb(F.col("light")), "color_hex": light_hex(F.col("light"))})


def available(served: DataFrame) -> DataFrame:
    """Stations worth recommending."""
    return served.where(F.col("light").isin(*GOOD_LIGHTS))


def nearby_available(served: DataFrame, radius_m: float) -> DataFrame:
    """All recommendable stations around every station position of the map."""
    return within_radius(served.select("station_id", "lat", "lon"), available(served), radius_m)


def top_recommendations(served: DataFrame, radius_m: float, **options: int) -> DataFrame:
    """The five best stations around every station of the map, as shown in the sidebar table."""
    columns = ["station_id", "name", "lat", "lon", "yhat", "docks_pred", "pct_bikes", "light"]
    best = top_nearby(served.select("station_id", "lat", "lon"), available(served).select(*columns), radius_m, **options)
    return best.select(
        "focus_id",
        "place",
        "station_id",
        "name",
        round_half_even(F.col("yhat"), 0).cast("bigint").alias("bikes"),
        round_half_even(F.col("docks_pred"), 0).cast("bigint").alias("free_docks"),
        "pct_bikes",
        "light",
        round_half_even(F.col("distance_m"), 0).cast("bigint").alias("distance_m"),
    )
