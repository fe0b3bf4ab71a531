"""The holdout by place: blocks are whole, and no training station is near a held-out one."""

import pytest
from pyspark.sql import functions as F

from dockcast.functions.geo import haversine_m
from dockcast.operators import spatial


@pytest.fixture(scope="module")
def stations(spark):
    """A town of ten by ten kilometres, a pile of stations at one place, and stations around a pole and the date line."""
    town = [(i, 48.0 + (i * 37 % 100) * 0.001, 2.0 + (i * 61 % 100) * 0.001) for i in range(800)]
    pile = [(1000 + i, 48.02, 2.02) for i in range(50)]
    odd = [(2000 + i, 89.99, float(i)) for i in range(0, 360, 20)] + [(3000 + i, 0.001 * i, 179.999 if i % 2 else -179.999) for i in range(40)]
    return spark.createDataFrame([*town, *pile, *odd, (9000, None, 1.0), (9001, 1.0, None)], "station_id long, lat double, lon double")


@pytest.mark.parametrize(("side", "buffer"), [(2_000.0, 250.0), (700.0, 900.0), (5_000.0, 0.0)])
def test_no_training_station_inside_the_buffer(stations, side, buffer):
    out = spatial.spatial_split(stations, side, 0.3, buffer)
    assert out.count() == stations.count()
    test, rest = (out.where(p).select("station_id", "part", F.col("lat").alias(f"lat{i}"), F.col("lon").alias(f"lon{i}")) for i, p in enumerate(("part = 'test'", "part IN ('train', 'buffer')")))
    distance = haversine_m(F.col("lat0"), F.col("lon0"), F.col("lat1"), F.col("lon1"))
    least = rest.join(test.drop("station_id", "part"), F.lit(True)).groupBy("station_id", "part").agg(F.min(distance).alias("d"))  # test data: all pairs
    for r in least.collect():
        assert (r["d"] <= buffer) == (r["part"] == "buffer")
    assert out.where("part = 'unplaced'").count() == 2
    per_block = out.where("block IS NOT NULL").groupBy("block").agg(F.max(F.col("part") == "test").alias("a"), F.min(F.col("part") == "test").alias("b"))
    assert per_block.where("a <> b").isEmpty()


def test_the_choice_of_blocks_is_stable(stations):
    all_, some = spatial.spatial_split(stations), spatial.spatial_split(stations.where("station_id % 3 = 0"))
    held = {r["station_id"] for r in all_.where("part = 'test'").collect()}
    assert {r["station_id"] for r in some.where("part = 'test'").collect()} == {s for s in held if s % 3 == 0}
    other = {r["station_id"] for r in spatial.spatial_split(stations, seed=7).where("part = 'test'").collect()}
    assert other != held


def test_holdout_learns_from_training_stations_only(spark, stations):
    parts = {r["station_id"]: r["part"] for r in spatial.spatial_split(stations).collect()}
    rows = [(s, h, 1.0 if p == "train" else 100.0 if p == "buffer" else 3.0) for s, p in parts.items() for h in (0, 1)]
    out = spatial.spatial_holdout(spark.createDataFrame(rows, "station_id long, hour int, y double"), stations, "y", ["hour"]).collect()
    assert out and all(r["mae"] == 2.0 for r in out)
    assert sum(r["n_stations"] for r in out) == sum(p == "test" for p in parts.values())


def test_bad_settings(stations):
    with pytest.raises(ValueError):
        spatial.spatial_split(stations, share=1.0)
