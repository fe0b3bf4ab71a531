"""Hand-written rows for the semantics that are easy to get wrong."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dockcast.functions import display, geo, timestamps, values
from dockcast.operators import contracts, encoding, history, leaderboard, monitor, slots, split
from dockcast.operators.asof import asof_join
from dockcast.operators.metrics import regression_metrics
from dockcast.plans import forecast, serving
from dockcast.plans import slots as slot_plans
from dockcast.plans.features import model_ready
from dockcast.plans.training import Trial

T0 = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def feed(spark, rows):
    return spark.createDataFrame(rows, "station_id string, ts_local timestamp_ntz, num_bikes_available double, tie int")


def test_null_target_empties_the_next_means_but_stays_itself(spark):
    values_ = [1.0, None, 3.0, 4.0, 5.0, 6.0]
    raw = feed(spark, [("1", at(i), v, i) for i, v in enumerate(values_)])
    rows = history.add_training_history(raw, "station_id", "ts_local", "num_bikes_available", ["tie"]).orderBy("ts_local").collect()
    assert [r["y_ma3"] for r in rows] == [None, None, None, None, None, 4.0]
    kept = model_ready(raw, tie=["tie"]).collect()
    assert [r["num_bikes_available"] for r in kept] == [6.0]


def test_dedup_keeps_the_first_by_tie(spark):
    raw = feed(spark, [("1", at(0), 2.0, 2), ("1", at(0), 1.0, 1), ("1", at(1), 5.0, 3)])
    out = history.dedup_pk(raw, "station_id", "ts_local", ["tie"]).orderBy("ts_local").collect()
    assert [r["num_bikes_available"] for r in out] == [1.0, 5.0]


@pytest.fixture()
def probe(spark):
    return spark.createDataFrame([("a", at(5))], "station_id string, t_slot timestamp_ntz")


def observed(spark, *rows):
    return spark.createDataFrame([("a", at(m), y, i) for i, (m, y) in enumerate(rows)], "station_id string, ts timestamp_ntz, y double, tie int")


def test_asof_tolerance_is_inclusive(spark, probe):
    obs = observed(spark, (0, 7.0))
    assert asof_join(probe, obs, "station_id", "t_slot", "ts", ["tie"], 5).first()["y"] == 7.0
    late = asof_join(probe, obs, "station_id", "t_slot", "ts", ["tie"], 4.999)
    assert late.first()["ts"] is None


def test_asof_takes_the_last_row_even_if_null(spark, probe):
    out = asof_join(probe, observed(spark, (1, 1.0), (4, None)), "station_id", "t_slot", "ts", ["tie"]).first()
    assert (out["ts"], out["y"]) == (at(4), None)


def test_asof_exact_time_and_tie(spark, probe):
    assert asof_join(probe, observed(spark, (4, 1.0), (4, 2.0)), "station_id", "t_slot", "ts", ["tie"]).first()["y"] == 2.0
    assert asof_join(probe, observed(spark, (4, 1.0), (5, 3.0), (6, 9.0)), "station_id", "t_slot", "ts", ["tie"]).first()["y"] == 3.0


def test_slot_grid_spans_all_stations_and_is_clipped(spark):
    obs = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 10)), ("b", datetime(2024, 1, 2, 13))], "station_id string, ts timestamp_ntz"
    )
    grid = slots.slot_grid(obs, "station_id", "ts").collect()
    expected = {datetime(2024, 1, 1, 13), datetime(2024, 1, 1, 16), datetime(2024, 1, 1, 20), datetime(2024, 1, 2, 9), datetime(2024, 1, 2, 13)}
    for station in "ab":
        assert {r["t_slot"] for r in grid if r["station_id"] == station} == expected


def test_next_slot(spark):
    times = [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 0, 0, 1), datetime(2024, 1, 1, 23), datetime(2024, 1, 1, 8, 51)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    out = [r[0] for r in df.select(slots.next_slot(F.col("t"), slots.DEFAULT_SLOTS)).collect()]
    assert out == [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 13), datetime(2024, 1, 2, 9), datetime(2024, 1, 1, 9)]
    lead = [r[0] for r in df.select(slots.next_slot(F.col("t"), slots.DEFAULT_SLOTS, 10)).collect()]
    assert lead == [datetime(2024, 1, 1, 13), datetime(2024, 1, 1, 13), datetime(2024, 1, 2, 9), datetime(2024, 1, 1, 13)]


def test_exact_slots_claim_a_match_time_and_fan_out(spark):
    nine = datetime(2024, 1, 1, 9)
    obs = spark.createDataFrame(
        [("a", nine, 1.0), ("a", nine, 2.0), ("a", datetime(2024, 1, 1, 13, 30), 3.0)], "station_id string, ts timestamp_ntz, y double"
    )
    out = slot_plans.slot_targets(obs, how="exact").orderBy("t_slot", "y").collect()
    assert [(r["t_slot"].hour, r["y"], r["ts_matched"] == r["t_slot"]) for r in out] == [(9, 1.0, True), (9, 2.0, True), (13, None, True)]


def test_split_index_is_truncated_and_inclusive(spark):
    df = spark.createDataFrame([(at(i),) for i in range(7)], "ts timestamp_ntz")
    labels = split.temporal_split(df, "ts", 0.70, 0.15)
    assert split.split_cuts(df, "ts") == (at(4), at(5))
    assert {r["split"]: r["count"] for r in labels.groupBy("split").count().collect()} == {"train": 5, "val": 1, "test": 1}
    with pytest.raises(contracts.ContractError):
        split.check_split_sizes(labels, 100)
    with pytest.raises(contracts.ContractError):
        split.split_cuts(df.limit(2), "ts")


def test_split_uses_binary_fractions(spark):
    df = spark.createDataFrame([(at(i),) for i in range(710)], "ts timestamp_ntz")
    assert split.split_cuts(df, "ts")[0] == at(496)


def test_id_column_is_typed_as_a_whole(spark):
    def kind(*ids):
        return dict(contracts.normalize_id(spark.createDataFrame([(i,) for i in ids], "id string"), "id").dtypes)["id"]

    assert kind("1", "2", "x") == "string"
    assert kind("1", "2") == "bigint"
    assert kind() == "bigint"
    assert kind("1", None) == "bigint"


def test_contract_counts_nulls_before_anything_is_stringified(spark):
    raw = feed(spark, [(None, at(0), 1.0, 0), ("1", None, 1.0, 1), ("1", at(1), -1.0, 2), ("1", at(2), None, 3)])
    found = contracts.contract_report(raw, "station_id", "ts_local", "num_bikes_available").first().asDict()
    assert found == {"n_rows": 4, "null_id": 1, "null_ts": 1, "negative_y": 1}
    with pytest.raises(contracts.ContractError):
        contracts.check_contract(raw, "station_id", "ts_local", "num_bikes_available")
    with pytest.raises(contracts.ContractError):
        model_ready(raw, tie=["tie"], enforce=True)


def test_missing_columns_and_candidates(spark):
    df = spark.createDataFrame([(1, 2)], "value int, time int")
    assert contracts.find_column(df, contracts.TARGET_CANDIDATES) == "value"
    assert contracts.find_column(df, contracts.TS_CANDIDATES) == "time"
    with pytest.raises(contracts.ContractError):
        contracts.require_columns(df, "station_id")


def test_dropped_times_are_counted_in_the_same_pass(spark):
    seen = Observation("times")
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("nope",), (None,)], "ts string")
    assert contracts.parse_time(df, "ts", seen).count() == 1
    assert seen.get == {"n_rows": 3, "n_bad": 2}


def test_asof_times(spark):
    df = spark.createDataFrame([(at(5),)], "ts timestamp_ntz")
    assert forecast.resolve_asof(df, "ts") == at(5)
    assert forecast.resolve_asof(df, "ts", "2024-01-01 10:00:00") == datetime(2024, 1, 1, 10)
    assert forecast.resolve_asof(df, "ts", "2024-01-01T10:00:00+00:00", slots.DEFAULT_ZONE) == datetime(2024, 1, 1, 7)
    with pytest.raises(contracts.ContractError):
        forecast.resolve_asof(df.limit(0), "ts")


def test_strict_times(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("nope",)], "ts string")
    assert contracts.parse_time(df, "ts").count() == 1
    with pytest.raises(contracts.ContractError):
        contracts.check_times(df, "ts")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_zone_handling_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([("2024-03-10T02:30:00-03:00",)], "s string").select(F.col("s").try_cast("timestamp").alias("t"))
        row = df.select(
            timestamps.to_naive(F.col("t"), "utc"), timestamps.to_naive(F.col("t"), "local", slots.DEFAULT_ZONE)
        ).first()
        assert list(row) == [datetime(2024, 3, 10, 5, 30), datetime(2024, 3, 10, 2, 30)]
        wall = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 5, 123456),)], "t timestamp_ntz")
        same = wall.select(timestamps.from_micros(timestamps.micros(F.col("t"))), timestamps.hour_start(F.col("t"))).first()
        assert list(same) == [datetime(2024, 3, 10, 2, 30, 5, 123456), datetime(2024, 3, 10, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_json_values(spark):
    df = spark.createDataFrame([('{"k":true,"z":"3"}',), ('{"k":2}',), ("{bad}",), ('{"k":{"c":1}}',), (None,)], "j string")
    assert encoding.json_keys(df, "j") == ["k", "z"]
    cells = encoding.json_values("j", ["k", "z"])
    out = df.select(*[c.alias(n) for n, c in cells.items()]).collect()
    assert [tuple(r) for r in out] == [(1.0, 3.0), (2.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_onehot_drops_the_first_and_zeroes_null(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "a string")
    found = encoding.categories(df, ["a"])
    out = df.select(*[c.alias(n) for n, c in encoding.onehot_columns("a", found["a"]).items()]).collect()
    assert [r["a_y"] for r in out] == [0, 1, 0]


def test_wide_text_columns_are_not_onehot(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("wide"), (F.col("id") < 20).cast("string").alias("narrow"))
    assert list(encoding.categories(df, ["wide", "narrow"])) == ["narrow"]
    twenty = spark.range(21).select(F.col("id").cast("string").alias("c"))
    assert encoding.categories(twenty, ["c"]) == {}
    assert len(encoding.categories(twenty.limit(20), ["c"])["c"]) == 20


def test_encoding_learnt_on_training_rows_fits_other_tables(spark):
    train = spark.createDataFrame([(1, "a", '{"k":1}', True), (2, "b", '{"k":2}', False)], "n int, c string, j string, flag boolean")
    learnt = encoding.learn_encoding(train)
    assert learnt.features == ["n", "j_k", "c_b"]
    other = spark.createDataFrame([(5, "z")], "extra int, c string")
    assert tuple(encoding.encode(other, learnt).first()) == (0.0, 0.0, 0.0)
    assert encoding.learn_encoding(train, onehot=False).features == ["n", "j_k"]


def test_levels_and_tiles(spark):
    preds = spark.createDataFrame(
        [(i, v, at(0), 1) for i, v in enumerate([None, -1.0, 3.0, 10.0])], "station_id long, yhat double, timestamp_pred timestamp_ntz, h int"
    )
    stations = spark.createDataFrame([(i, 0.0, 0.0) for i in range(4)], "station_id long, lat double, lon double")
    rows = serving.tiles(preds, stations).orderBy("station_id").collect()
    assert [(r["yhat"], r["level"]) for r in rows] == [(0.0, "low"), (0.0, "low"), (3.0, "medium"), (10.0, "high")]
    assert serving.tiles(preds, stations, null_as_na=True).where("station_id = 0").first()["level"] == "na"


def test_traffic_light_rounds_first(spark):
    preds = spark.createDataFrame([(1, 0.04), (2, 9.0), (3, 10.0), (4, None)], "station_id long, yhat double")
    stations = spark.createDataFrame([(i, 20.0) for i in range(1, 5)], "station_id long, capacity double")
    rows = serving.serving_map(preds, stations).orderBy("station_id").collect()
    assert [r["light"] for r in rows] == ["rojo", "amarillo", "verde", "gris"]
    assert rows[0]["color_rgb"] == [220, 0, 0]


def test_capacity_discovery(spark):
    df = spark.createDataFrame([(1.0, "30")], "yhat double, dock_count string")
    assert df.select(display.capacity_column(df.columns)).first()[0] == 30.0
    assert df.drop("dock_count").select(display.capacity_column(["yhat"])).first()[0] is None


def test_clip_keeps_null_and_rounding_is_half_even(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (7.0,)], "x double")
    assert [r[0] for r in df.select(values.clip(F.col("x"), 0.0, 5.0)).collect()] == [None, 0.0, 5.0]
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (0.25,)], "x double")
    assert [r[0] for r in halves.select(values.round_half_even(F.col("x"), 0)).collect()] == [0.0, 2.0, 2.0, 0.0]


def test_leaderboard(spark):
    rows = [("a", "validation", 2.0, 1.0, 0.5), ("a", "VAL", 1.0, 3.0, 0.9), ("b", "foo", 0.1, 0.1, 0.9), ("c", "test", 4.0, 4.0, 0.1)]
    wide = leaderboard.wide_board(spark.createDataFrame(rows, " framework string, split string, RMSE double, mae double, r2 double"))
    found = {r["framework"]: r for r in wide.collect()}
    assert set(found) == {"a", "c"}
    assert (found["a"]["val_rmse"], found["a"]["val_mae"], found["a"]["val_r2"]) == (1.0, 1.0, 0.9)
    assert found["c"]["val_rmse"] is None and found["c"]["test_rmse"] == 4.0
    assert leaderboard.wide_board(wide).columns == wide.columns
    order = [r["framework"] for r in leaderboard.rank_models(wide).orderBy("place").collect()]
    assert order == ["a", "c"]
    assert leaderboard.choose_best(wide, "test_rmse").first()["framework"] == "c"


def test_ranking_ties_and_directions(spark):
    rows = [("a", 1.0, 2.0, 0.1), ("b", 1.0, 2.0, 0.9), ("c", 1.0, 1.0, 0.0), ("d", None, 0.0, 1.0)]
    board = spark.createDataFrame(rows, "framework string, val_rmse double, val_mae double, val_r2 double")
    order = [r["framework"] for r in leaderboard.rank_models(board).orderBy("place").collect()]
    assert order == ["c", "b", "a", "d"]
    assert leaderboard.choose_best(board, "r2").first()["framework"] == "d"


def test_upsert_and_paths(spark):
    board = spark.createDataFrame([("A", 1.0)], "framework string, val_rmse double")
    more = spark.createDataFrame([("A", 9.0), ("b", 2.0)], "framework string, val_rmse double")
    merged = leaderboard.upsert(board, more)
    assert sorted(tuple(r) for r in merged.collect()) == [("A", 1.0), ("b", 2.0)]
    paths = leaderboard.fill_model_paths(merged, {"a": "models/a"})
    assert {r["framework"]: r["model_path"] for r in paths.collect()} == {"a": "models/a", "b": None}
    with pytest.raises(contracts.ContractError):
        leaderboard.fill_model_paths(board, {})


def test_registry_archives_older_versions(spark):
    rows = [("m", at(2), "b"), ("m", at(1), "a"), ("n", at(0), "c")]
    table = leaderboard.registry_table(spark.createDataFrame(rows, "name string, registered_at timestamp_ntz, path string"))
    found = {(r["name"], r["path"]): (r["version"], r["stage"]) for r in table.collect()}
    assert found == {("m", "a"): (1, "Archived"), ("m", "b"): (2, "Production"), ("n", "c"): (1, "Production")}


def test_leak_guard(spark):
    df = spark.createDataFrame([(float(i), 7.0, float(i), float(i * i % 5), 2.0 * i + 1) for i in range(9)], "Y double, const double, copy double, other double, line double")
    report = {r["feature"]: r["keep"] for r in encoding.leak_guard(df.withColumnRenamed("Y", "target"), "target", ["const", "copy", "other", "line"]).collect()}
    assert report == {"const": True, "copy": False, "other": True, "line": False}
    named = encoding.leak_guard(df.withColumn("Y_lagged", F.lit(1.0)), "Y", ["Y_lagged"]).first()
    assert named["by_name"] and not named["keep"]


def test_screening(spark):
    df = spark.createDataFrame([(float(i), None if i else 1.0, 3.0) for i in range(10)], "good double, rare double, flat double")
    assert encoding.kept_features(encoding.screen_features(df, df.columns)) == ["good"]


def test_interarrival_global_and_per_station(spark):
    rows = [(s, at(i)) for s in ("a", "b") for i in range(5)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz")
    assert monitor.interarrival_mode(df, "ts").first()[0] == 0.0
    assert monitor.interarrival_mode_per_station(df, "station_id", "ts", ["ts"]).first()[0] == 1.0


def test_ks_needs_more_than_a_hundred_values(spark):
    few = spark.createDataFrame([(at(i), float(i)) for i in range(150)], "ts timestamp_ntz, v double")
    assert monitor.ks_drift(few, "ts", "v", at(74), at(149)).count() == 0
    many = spark.createDataFrame([(at(i), float(i >= 200)) for i in range(400)], "ts timestamp_ntz, v double")
    row = monitor.ks_drift(many, "ts", "v", at(199), at(399)).first()
    assert (row["ks_stat"], row["n_early"], row["n_late"]) == (1.0, 200, 200) and row["pvalue"] < 1e-50


def test_zero_share_counts_null_as_not_zero(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", None), ("a", 1.0), ("a", 0.0)], "id string, y double")
    assert monitor.zero_share(df, "id", "y").first()["p_zero"] == 0.5


def test_constant_target_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 2.0)], "y double, good double, bad double")
    assert df.agg(*regression_metrics(F.col("y"), F.col("good"))).first()["r2"] == 1.0
    assert df.agg(*regression_metrics(F.col("y"), F.col("bad"))).first()["r2"] == 0.0


def latest(spark, *rows):
    schema = "station_id long, ts_local timestamp_ntz, num_bikes_available double, y_lag1 double, y_lag2 double, y_ma3 double, capacity double"
    return spark.createDataFrame(rows, schema)


def test_recursion_moves_lags_once_per_listed_horizon(spark):
    rows = latest(spark, (1, at(0), 100.0, 10.0, 20.0, 30.0, None), (2, at(0), 1.0, None, 1.0, 1.0, None))
    out = forecast.recursive_forecast(rows, forecast.LinearScore({"y_lag1": 1.0, "y_ma3": 0.1}), at(0), (3, 1, 3)).orderBy("h").collect()
    assert [(r["station_id"], r["h"], r["timestamp_pred"]) for r in out] == [(1, 1, at(60)), (1, 3, at(180))]
    first = 10.0 + 3.0
    second = first + 0.1 * (first + 10.0 + 20.0) / 3
    assert [r["yhat"] for r in out] == pytest.approx([first, second])


def test_forecast_clips_only_with_capacity(spark):
    rows = latest(spark, (1, at(0), 5.0, -10.0, 0.0, 0.0, 8.0), (2, at(0), 5.0, 50.0, 0.0, 0.0, 8.0), (3, at(0), 5.0, 50.0, 0.0, 0.0, None))
    score = forecast.LinearScore({"y_lag1": 1.0})
    free = {r["station_id"]: r["yhat"] for r in forecast.recursive_forecast(rows, score, at(0), (1,)).collect()}
    held = {r["station_id"]: r["yhat"] for r in forecast.recursive_forecast(rows, score, at(0), (1,), capacity="capacity").collect()}
    assert free == {1: -10.0, 2: 50.0, 3: 50.0} and held == {1: 0.0, 2: 8.0, 3: 50.0}


def test_shift_in_current_uses_the_newest_observation(spark):
    rows = latest(spark, (1, at(0), 9.0, 3.0, 6.0, 0.0, None))
    score = forecast.LinearScore({"y_lag1": 1.0, "y_lag2": 10.0, "y_ma3": 100.0})
    out = forecast.recursive_forecast(rows, score, at(0), (1,), shift_in_current=True).first()
    assert out["yhat"] == 9.0 + 30.0 + 600.0


def test_haversine_known_distances(spark):
    df = spark.range(1).select(
        geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)), geo.haversine_m(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0))
    )
    assert list(df.first()) == pytest.approx([20015086.796, 0.0], abs=0.001)


def test_trial_direction():
    low, high = Trial("a", {}, 1.0, 1.0, 0.1), Trial("b", {}, 2.0, 2.0, 0.9)
    assert low.better_than(high, "rmse") and high.better_than(low, "r2") and low.better_than(None, "mae")
