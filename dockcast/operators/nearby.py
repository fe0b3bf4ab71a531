"""Stations near a point, through a grid of cubes around the sphere.

A position becomes a point on the sphere in metres; two positions within r metres of each other differ
by at most r on every axis. With cubes of side 2r a position has at most eight cubes to look into, so
the search is an equi-join, without poles or a date line as special cases.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.geo import EARTH_RADIUS_M, haversine_m
from dockcast.session import materialize

AXES = ("_cx", "_cy", "_cz")
HALF_CIRCUMFERENCE_M = 20_020_000.0
FIRST_RADIUS_M = 500.0
RADIUS_GROWTH = 4.0
KEEP_PER_CELL = 64
KEEP_GROWTH = 64
TOP = 5


def _position(lat: Column, lon: Column) -> list[Column]:
    phi, lam, r = F.radians(lat), F.radians(lon), F.lit(EARTH_RADIUS_M)
    return [r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)]


def _cell(axis: Column, radius_m: float) -> Column:
    return F.floor(axis / F.lit(2 * radius_m)).cast("int")


def in_cell(df: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Tag each row with the one cube it lies in."""
    position = _position(F.col(lat), F.col(lon))
    return df.withColumns({name: _cell(axis, radius_m) for name, axis in zip(AXES, position, strict=True)})


def in_reach(df: DataFrame, radius_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Repeat each row for every cube that a position within the radius can lie in, at most eight."""
    reach = radius_m + 0.01
    for name, axis in zip(AXES, _position(F.col(lat), F.col(lon)), strict=True):
        df = df.withColumn(name, F.explode(F.sequence(_cell(axis - reach, radius_m), _cell(axis + reach, radius_m))))
    return df


def _points(df: DataFrame, prefix: str) -> DataFrame:
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        F.col("lat").alias(f"{prefix}lat"), F.col("lon").alias(f"{prefix}lon")
    ).distinct()


def point_pairs(focus: DataFrame, others: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of distinct positions (flat, flon) and (lat, lon) within the radius, with their distance."""
    left = in_reach(_points(focus, "f"), radius_m, "flat", "flon")
    right = in_cell(_points(others, ""), radius_m)
    distance = haversine_m(F.col("flat"), F.col("flon"), F.col("lat"), F.col("lon"))
    near = left.join(right, list(AXES)).drop(*AXES).withColumn("distance_m", distance)
    return near.where(F.col("distance_m") <= radius_m)


def within_radius(focus: DataFrame, others: DataFrame, radius_m: float) -> DataFrame:
    """Every station within the radius of each focus position (focus_lat, focus_lon), with the distance.

    Stations at one position share one list, so a pile of stations at one place is not paired with
    itself. A station at the focus position is listed too; around_station() leaves out the focus itself.
    """
    pairs = point_pairs(focus, others, radius_m)
    return pairs.join(others, ["lat", "lon"]).withColumnsRenamed({"flat": "focus_lat", "flon": "focus_lon"})


def around_station(found: DataFrame, focus: DataFrame, focus_id: object, key: str = "station_id") -> DataFrame:
    """The list of one focus station, without the station itself."""
    here = focus.where(F.col(key) == focus_id).select(F.col("lat").alias("focus_lat"), F.col("lon").alias("focus_lon"))
    return found.join(F.broadcast(here.limit(1)), ["focus_lat", "focus_lon"]).where(F.col(key) != focus_id)


def nearest_station(points: DataFrame, stations: DataFrame, point_key: str, key: str = "station_id") -> DataFrame:
    """The nearest station of each point (lat, lon) and its distance; the smallest id on a tie at millimetre level.

    Every point is returned; one without a position, or without any station, has NULLs. Looks within a small radius first and repeats with a larger one for the points that found none,
    so few points ever meet far stations. Stations at one position count as one candidate.
    """
    sites = stations.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon").agg(F.min(key).alias(key))
    sites = materialize(sites, "sites")
    left = points.select(point_key, F.col("lat").alias("flat"), F.col("lon").alias("flon"))
    placed = F.col("flat").isNotNull() & F.col("flon").isNotNull()
    nowhere, left = left.where(~placed), left.where(placed)
    waiting = left.select(point_key).distinct().count() if not sites.isEmpty() else 0
    radius, rounds = FIRST_RADIUS_M, []
    while waiting and radius < RADIUS_GROWTH * HALF_CIRCUMFERENCE_M:
        rounds.append(materialize(_best_site(_reachable(left, sites, radius), point_key, key), "nearest"))
        waiting -= rounds[-1].count()
        left = left.join(rounds[-1].select(point_key), point_key, "left_anti")
        radius *= RADIUS_GROWTH
    absent = nowhere.unionByName(left).select(
        point_key, F.lit(None).cast(stations.schema[key].dataType).alias(key), F.lit(None).cast("double").alias("distance_m")
    )
    return reduce(lambda a, b: a.unionByName(b), rounds, absent)


def _reachable(left: DataFrame, sites: DataFrame, radius_m: float) -> DataFrame:
    distance = haversine_m(F.col("flat"), F.col("flon"), F.col("lat"), F.col("lon"))
    near = in_reach(left, radius_m, "flat", "flon").join(in_cell(sites, radius_m), list(AXES))
    return near.withColumn("distance_m", distance).where(F.col("distance_m") <= radius_m)


def _best_site(pairs: DataFrame, point_key: str, key: str) -> DataFrame:
    best = F.min_by(F.struct(key, "distance_m"), F.struct(F.round("distance_m", 3), key))
    return pairs.groupBy(point_key).agg(best.alias("_best")).select(point_key, "_best.*")


def top_nearby(
    focus: DataFrame,
    candidates: DataFrame,
    radius_m: float,
    value: str = "yhat",
    key: str = "station_id",
    top: int = TOP,
    keep_per_cell: int = KEEP_PER_CELL,
) -> DataFrame:
    """The best `top` candidates by value, then distance, within the radius of each focus station; all focuses at once.

    A dense area must not pair every focus with every candidate. First only the best candidates of each
    cube are paired. A focus is settled once its last place beats the best value left out of the cubes
    it looked into; the others are done again with many more candidates per cube, and at the end with all.
    Stations at one position share their distance, so of those only the best top + 1 can matter. Candidates without a
    value or a position have no place in an order by value and are not listed.
    """
    here = Window.partitionBy("lat", "lon").orderBy(F.desc(value), F.asc(key))
    pool = candidates.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col(value).isNotNull())
    pool = pool.withColumn("_at", F.row_number().over(here)).where(F.col("_at") <= top + 1).drop("_at")
    cells = in_cell(pool, radius_m)
    largest = cells.groupBy(*AXES).count().agg(F.max("count")).first()[0] or 0
    open_focus = focus.select(F.col(key).alias("focus_id"), F.col("lat").alias("flat"), F.col("lon").alias("flon")).where(
        F.col("flat").isNotNull() & F.col("flon").isNotNull()
    )
    limit, settled = keep_per_cell, []
    while limit < largest:
        best = materialize(_top_of_best(open_focus, cells, radius_m, value, key, top, limit), "nearby")
        done = best.select("focus_id", "_settled").distinct().where("_settled").select("focus_id")
        settled.append(best.where(F.col("_settled") & F.col(key).isNotNull()).drop("_settled"))
        open_focus = open_focus.join(done, "focus_id", "left_anti")
        if open_focus.isEmpty():
            break
        limit *= KEEP_GROWTH
    else:
        settled.append(_ranked(_near(open_focus, cells, radius_m, key), value, key, top))
    return reduce(lambda a, b: a.unionByName(b), settled)


def _near(focus: DataFrame, cells: DataFrame, radius_m: float, key: str) -> DataFrame:
    distance = haversine_m(F.col("flat"), F.col("flon"), F.col("lat"), F.col("lon"))
    pairs = in_reach(focus, radius_m, "flat", "flon").join(cells, list(AXES)).drop(*AXES)
    pairs = pairs.where(F.col("focus_id") != F.col(key)).withColumn("distance_m", distance)
    return pairs.where(F.col("distance_m") <= radius_m).drop("flat", "flon")


def _ranked(pairs: DataFrame, value: str, key: str, top: int) -> DataFrame:
    order = Window.partitionBy("focus_id").orderBy(F.desc(value), F.round("distance_m", 3), F.asc(key))
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def _top_of_best(
    focus: DataFrame, cells: DataFrame, radius_m: float, value: str, key: str, top: int, limit: int
) -> DataFrame:
    """Places from the best `limit` candidates per cube, and per focus whether nothing left out can change them."""
    order = Window.partitionBy(*AXES).orderBy(F.desc(value), F.asc(key))
    ranked = cells.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit + 1)
    kept = ranked.where(F.col("_rank") <= limit).drop("_rank")
    left_out = ranked.where(F.col("_rank") == limit + 1).select(*AXES, F.col(value).alias("_left_out"))
    places = _ranked(_near(focus, kept, radius_m, key), value, key, top)
    last = places.where(F.col("place") == top).select("focus_id", F.col(value).alias("_last"))
    threat = (
        in_reach(focus, radius_m, "flat", "flon").join(left_out, list(AXES)).groupBy("focus_id").agg(F.max("_left_out").alias("_threat"))
    )
    state = (
        focus.select("focus_id")
        .join(threat, "focus_id", "left")
        .join(last, "focus_id", "left")
        .select(
            "focus_id",
            F.coalesce(F.col("_threat").isNull() | (F.col("_last") > F.col("_threat")), F.lit(False)).alias("_settled"),
        )
    )
    return state.join(places, "focus_id", "left")
