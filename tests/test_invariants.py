"""Properties that must hold on any feed."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockcast.catalog import KEY, TIE, TS, Y, all_queries, obs, ready, targets
from dockcast.operators import split
from dockcast.operators.asof import asof_join
from dockcast.operators.history import add_slot_history
from dockcast.operators.nearby import around_station, nearest_station, within_radius
from dockcast.plans.features import model_ready
from dockcast.session import materialize
from dockcast.sources.adapters import status_hourly

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)
ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.one_of(st.none(), st.integers(0, 9).map(float))), min_size=1, max_size=25
)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_splits_are_disjoint_and_complete(spark):
    rows = ready(spark, FOLDER)
    labelled = split.temporal_split(rows, TS)
    report = {r["split"]: r for r in split.split_report(labelled, TS).collect()}
    assert sum(r["n_rows"] for r in report.values()) == rows.count()
    assert report["train"]["last_ts"] < report["val"]["first_ts"] and report["val"]["last_ts"] < report["test"]["first_ts"]


def test_folds_grow_and_never_look_ahead(spark):
    rows = ready(spark, FOLDER)
    folds = split.fold_cuts(rows, TS)
    assert [f[0] for f in folds] == [1, 2, 3] and folds[0][1] < folds[1][1] < folds[2][1]
    labelled = split.label_folds(rows, TS, folds)
    assert labelled.where((F.col("part") == "train") & (F.col(TS) > F.col("train_end"))).isEmpty()
    assert labelled.where((F.col("part") == "val") & ((F.col(TS) <= F.col("train_end")) | (F.col(TS) > F.col("val_end")))).isEmpty()


def test_features_do_not_see_the_present_or_the_future(spark):
    """Changing every value from a time on leaves the features up to that time alone."""
    raw, cut = status_hourly(spark, FOLDER), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    changed = raw.withColumn(Y, F.when(F.col(TS) >= cut, F.col(Y) + 1000).otherwise(F.col(Y)))
    columns = [KEY, TS, "y_lag1", "y_lag2", "y_ma3"]
    before, after = (model_ready(d, tie=TIE).where(F.col(TS) < cut).select(*columns) for d in (raw, changed))
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_slot_targets_never_match_later_rows(spark):
    found = targets(spark, FOLDER)
    assert found.where(F.col("ts_matched") > F.col("t_slot")).isEmpty()
    assert found.count() == found.select(KEY, "t_slot").distinct().count()


@pytest.mark.parametrize("name", ["model_ready", "asof_tolerance", "slot_features", "latest_per_station", "top5_nearby"])
def test_row_order_and_partitions_do_not_matter(spark, tmp_path, name):
    for table in ("events", "customer"):
        shuffled = spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(7).orderBy(F.rand(3))
        shuffled.write.parquet(f"{tmp_path}/{table}.parquet")
    plain, mixed = (materialize(all_queries()[name](spark, d), name) for d in (FOLDER, str(tmp_path)))
    assert plain.count() == mixed.count()
    assert plain.exceptAll(mixed).isEmpty()


@QUICK
@given(ROWS, ROWS, st.sampled_from([None, 1, 7, 30]))
def test_asof_equals_pandas(spark, left, right, tolerance):
    probes = [(k, T0 + timedelta(minutes=m), i) for i, (k, m, _) in enumerate(left)]
    seen = [(k, T0 + timedelta(minutes=m), v, i) for i, (k, m, v) in enumerate(right)]
    limit = None if tolerance is None else pd.Timedelta(minutes=tolerance)
    pleft = pd.DataFrame(probes, columns=["k", "at", "i"]).sort_values("at")
    pright = pd.DataFrame(seen, columns=["k", "ts", "v", "tie"]).sort_values(["ts", "tie"])
    want = pd.merge_asof(pleft, pright, left_on="at", right_on="ts", by="k", tolerance=limit)
    got = asof_join(
        spark.createDataFrame(probes, "k string, at timestamp_ntz, i long"),
        spark.createDataFrame(seen, "k string, ts timestamp_ntz, v double, tie long"),
        *("k", "at", "ts", ["tie"], tolerance),
    ).collect()
    assert {r["i"]: r["tie"] for r in got} == {r.i: None if pd.isna(r.tie) else int(r.tie) for r in want.itertuples()}


@QUICK
@given(ROWS)
def test_running_means_equal_pandas(spark, rows):
    unique = {(k, m): v for k, m, v in rows}
    data = [(k, T0 + timedelta(minutes=m), v) for (k, m), v in sorted(unique.items())]
    pdf = pd.DataFrame(data, columns=["k", "ts", "y"]).astype({"y": float})
    pdf["want"] = pdf.groupby("k")["y"].transform(lambda s: s.rolling(3, min_periods=1).mean())
    got = add_slot_history(spark.createDataFrame(data, "k string, ts timestamp_ntz, y double"), "k", "ts", "y", 2, (3,)).orderBy("k", "ts").toPandas()
    pd.testing.assert_series_equal(got["y_ma3"], pdf["want"], check_names=False)


def places(spark, points, key):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], f"{key} long, lat double, lon double")


@settings(QUICK, max_examples=3)
@given(
    st.lists(st.tuples(st.integers(-90, 90), st.integers(-180, 180)), min_size=1, max_size=6),
    st.lists(st.tuples(st.integers(-90, 90), st.integers(-180, 180)), min_size=1, max_size=8),
)
def test_nearest_anywhere_on_the_sphere(spark, points, sites):
    """Poles and the date line included; the distance is what counts, since ties may name another site."""
    from dockcast.functions.geo import haversine_m

    found = nearest_station(places(spark, points, "p"), places(spark, sites, "station_id"), "p")
    other = places(spark, sites, "station_id").withColumnsRenamed({"lat": "slat", "lon": "slon"})
    pairs = places(spark, points, "p").crossJoin(other)
    brute = pairs.groupBy("p").agg(F.min(haversine_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))).alias("d"))
    got, want = ({r["p"]: r[1] for r in d.collect()} for d in (found.select("p", "distance_m"), brute))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 0.01 for k in want)


def test_radius_across_the_date_line(spark):
    sites = places(spark, [(0.0, 179.9999), (0.0, -179.9999), (89.9999, 0.0), (89.9999, 180.0), (1.0, 1.0)], "station_id")
    around = within_radius(sites, sites, 30.0)
    found = {(f, r["station_id"]) for f in range(5) for r in around_station(around, sites, f).collect()}
    assert found == {(0, 1), (1, 0), (2, 3), (3, 2)}


def test_nearest_without_stations(spark):
    assert [tuple(r) for r in nearest_station(places(spark, [(0, 0)], "p"), places(spark, [], "station_id"), "p").collect()] == [(0, None, None)]
    lost = spark.createDataFrame([(1, None, 5.0)], "p long, lat double, lon double")
    found = nearest_station(places(spark, [(0, 0)], "p").select("p", "lat", "lon").unionByName(lost), places(spark, [(0, 0)], "station_id"), "p").collect()
    assert sorted((r["p"], r["station_id"]) for r in found) == [(0, 0), (1, None)]


def test_observations_drop_unknown_ids_and_times(spark):
    assert obs(spark, FOLDER).where("station_id IS NULL OR ts IS NULL").isEmpty()
