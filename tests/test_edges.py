"""Inputs beyond the given tables: zones, gaps, mixed leads, unreadable files, missing features."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dockcast.operators import contracts, encoding
from dockcast.operators.metrics import metrics_by
from dockcast.plans import forecast
from dockcast.plans import slots as slot_plans
from dockcast.plans.features import model_ready
from dockcast.sources import io


@pytest.fixture
def other_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_instants_do_not_follow_the_session_zone(spark, other_zone):
    rows = spark.sql("SELECT '2024-05-01 13:00:00-03:00' AS text, TIMESTAMP'2024-05-01 13:00:00-03:00' AS zoned, '2024-05-01 13:00:00' AS plain")
    got = {c: contracts.parse_time(rows, c).first()[c] for c in rows.columns}
    assert got == {"text": datetime(2024, 5, 1, 16), "zoned": datetime(2024, 5, 1, 16), "plain": datetime(2024, 5, 1, 13)}
    local = contracts.parse_time(rows, "zoned", mode="local", zone="America/Argentina/Buenos_Aires").first()["zoned"]
    assert local == datetime(2024, 5, 1, 13)


def test_slot_observations_take_instants_text_and_text_ids(spark):
    rows = spark.createDataFrame([("7", "2024-05-01T12:00:00Z", 3.0, 1), ("8", None, 1.0, 2)], "id string, t string, y double, e long")
    got = slot_plans.observations(rows, "id", "t", "y", ["e"]).collect()
    assert [(r["station_id"], r["ts"]) for r in got] == [(7, datetime(2024, 5, 1, 9))]
    bad = rows.withColumn("t", F.lit("garbage"))
    with pytest.raises(contracts.ContractError):
        slot_plans.observations(bad, "id", "t", "y")
    assert slot_plans.observations(bad, "id", "t", "y", strict=False).isEmpty()


def test_metrics_skip_rows_without_a_forecast(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.0), ("a", 30.0, None), ("a", None, 4.0), ("b", 1.0, 2.0), ("b", 3.0, 2.0)], "g string, y double, p double")
    got = {r["g"]: r for r in metrics_by(rows, ["g"], "y", F.col("p")).collect()}
    assert (got["a"]["r2"], got["a"]["rmse"]) == (1.0, 0.0) and got["b"]["r2"] == 0.0


def test_slot_plans_agree_where_the_reduced_one_is_allowed(spark):
    minutes = [(s, datetime(2024, 5, d, h, m), float(s * 7 + d + h + m % 5), 0) for s in (1, 2) for d in (1, 2, 3) for h in range(6, 21) for m in range(0, 60, 20)]
    obs = spark.createDataFrame(minutes, "station_id long, ts timestamp_ntz, y double, e long")
    targets = slot_plans.slot_targets(obs, tolerance_minutes=60, tie=["e"])
    mixed = targets.withColumn("lead_minutes", F.when(F.col("slot_label") == "13:00", 240).otherwise(F.col("lead_minutes")))
    off = targets.withColumn("t_slot", F.col("t_slot") + F.expr("INTERVAL 3 HOURS"))
    for t in (targets, mixed, off):
        chosen = slot_plans.slot_features(t, obs, tie=["e"], target_rows=0)
        plain = slot_plans.slot_features_any(t, obs, tie=["e"])
        round_ = lambda rows: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows.collect()], key=str)
        assert round_(chosen) == round_(plain)


def test_features_of_a_model_must_be_there(spark):
    row = spark.createDataFrame([(1, 2.0, 3.0, 4.0, 5.0)], "station_id long, y_lag1 double, y_lag2 double, y_ma3 double, static double")
    at = datetime(2024, 5, 1)
    out = forecast.recursive_forecast(row, forecast.LinearScore({"static": 2.0}), at, (1,)).first()
    assert out["yhat"] == 10.0
    with pytest.raises(contracts.ContractError, match="absent"):
        forecast.recursive_forecast(row, forecast.LinearScore({"absent": 2.0}), at, (1,))


def test_contract_and_tie_are_required(spark):
    rows = spark.createDataFrame([(None, datetime(2024, 5, 1), 1.0, 1)], "station_id long, ts_local timestamp_ntz, num_bikes_available double, e long")
    with pytest.raises(contracts.ContractError):
        model_ready(rows, tie=["e"])
    with pytest.raises(ValueError, match="ties"):
        model_ready(rows)


def test_unreadable_files_are_an_error_or_reported(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    (tmp_path / "a" / "broken.parquet").write_bytes(b"PAR1 no table PAR1")
    with pytest.raises(Exception, match="(?i)parquet|footer|CANNOT_READ"):
        io.scan_glob(spark, f"{tmp_path}/a").count()
    found = spark.read.schema("id long").option("ignoreCorruptFiles", "true").parquet(f"{tmp_path}/a").select("*", F.col("_metadata.file_path").alias("source_file"))
    assert any("broken" in f for f in io.unread_files(spark, found, f"{tmp_path}/a"))


def test_json_of_any_width(spark):
    wide = "{" + ", ".join(f'"k{i}": {i}' for i in range(1500)) + "}"
    rows = spark.createDataFrame([(1, wide)], "id long, j string")
    assert len(encoding.json_keys(rows, "j")) == 1500 and encoding.json_pairs(rows, "j", ["id"]).count() == 1500
    with pytest.raises(contracts.ContractError):
        encoding.json_keys(rows, "j", most=1000)
