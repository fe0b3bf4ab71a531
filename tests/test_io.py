"""Sources and sinks."""

import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dockcast.operators.contracts import ContractError
from dockcast.plans.features import publish_ready, publish_split
from dockcast.session import scratch_path, shared_dir
from dockcast.sources import io


def forecast(spark, value=1.0):
    return spark.range(3).select(F.col("id").cast("string").alias("station_id"), F.lit(1).alias("h"), F.lit(value).alias("yhat"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_predictions_fall_back_and_end_empty(spark, tmp_path):
    slots_path, horizon = f"{tmp_path}/slots/*", f"{tmp_path}/horizon"
    assert io.load_predictions(spark, slots_path, horizon).schema == io.SLOT_PREDICTIONS
    io.write_table(forecast(spark), horizon)
    found = io.load_predictions(spark, slots_path, horizon)
    assert "h" in found.columns and dict(found.dtypes)["station_id"] == "bigint"
    io.write_table(forecast(spark).drop("h"), f"{tmp_path}/slots/0900")
    io.write_table(forecast(spark).drop("h").withColumn("extra", F.lit(1)), f"{tmp_path}/slots/1300")
    slots = io.load_predictions(spark, slots_path, horizon)
    assert {r["slot_label"]: r["count"] for r in slots.groupBy("slot_label").count().collect()} == {"09:00": 3, "13:00": 3}
    assert slots.where("slot_label = '09:00' AND extra IS NOT NULL").isEmpty()


def test_corrupt_files_are_skipped_on_request(spark, tmp_path):
    io.write_table(forecast(spark), f"{tmp_path}/a")
    (Path(tmp_path) / "a" / "part-broken.parquet").write_bytes(b"this is not parquet")
    assert io.scan_glob(spark, f"{tmp_path}/a", skip_corrupt=True).count() == 3


def test_stations_fall_back(spark, tmp_path):
    assert io.load_stations(spark, [f"{tmp_path}/one", f"{tmp_path}/two"]).schema == io.STATIONS
    io.write_table(spark.createDataFrame([("7", "x")], "station_id string, name string"), f"{tmp_path}/two")
    assert io.load_stations(spark, [f"{tmp_path}/one", f"{tmp_path}/two"]).first()["station_id"] == 7


def test_optional_input(spark, tmp_path):
    assert io.read_or_empty(spark, f"{tmp_path}/absent", io.METRICS_LONG).isEmpty()


def test_metric_log_only_grows(spark, tmp_path):
    rows = spark.createDataFrame([("a", "val", 1.0, 1.0, 1.0)], io.METRICS_LONG)
    first = io.append_metrics(rows, f"{tmp_path}/log")
    second = io.append_metrics(rows, f"{tmp_path}/log", run_ts=datetime(2024, 1, 1))
    log = spark.read.parquet(f"{tmp_path}/log")
    assert {r["run_id"] for r in log.collect()} == {first, second}
    assert log.where(F.col("run_id") == second).first()["run_ts"] == datetime(2024, 1, 1)


def test_run_parameters(spark, tmp_path):
    io.append_params(spark, f"{tmp_path}/params", "r1", {"trees": 300, "seed": 42})
    io.append_params(spark, f"{tmp_path}/params", "r2", {"trees": 20})
    found = {(r["run_id"], r["name"]): r["value"] for r in spark.read.parquet(f"{tmp_path}/params").collect()}
    assert found == {("r1", "trees"): "300", ("r1", "seed"): "42", ("r2", "trees"): "20"}


def test_readers_see_the_version_announced_last(spark, tmp_path):
    base = str(tmp_path)
    for value in (1.0, 2.0):
        path = io.publish(forecast(spark, value), base, datetime(2024, 1, 2, 3, 4), 60)
        assert "asof=20240102_0304/freq=60" in path
        assert io.read_latest(spark, base).first()["yhat"] == value
    forecast(spark, 9.0).write.parquet(f"{base}/versions/asof=20300101_0000/freq=60/unannounced")
    assert io.read_latest(spark, base).first()["yhat"] == 2.0


def test_nothing_published(spark, tmp_path):
    spark.createDataFrame([], "path string, asof timestamp_ntz, freq_minutes int, published_at timestamp").write.parquet(f"{tmp_path}/announced")
    with pytest.raises(ContractError):
        io.latest_version(spark, str(tmp_path))


def test_partitioned_table_is_pruned(spark, tmp_path):
    path = f"{tmp_path}/slots"
    rows = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("slot_label"))
    io.write_table(rows, path, ["slot_label"], ["id"])
    read = spark.read.parquet(path).where("slot_label = '1'")
    assert read.count() == 10
    assert "PartitionFilters: [isnotnull(slot_label" in read._jdf.queryExecution().toString()


def test_csv_roundtrip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "val", 0.1, None, -2.5)], io.METRICS_LONG)
    io.write_csv(rows, f"{tmp_path}/csv")
    assert io.read_csv(spark, f"{tmp_path}/csv", io.METRICS_LONG).collect() == rows.collect()


def test_newest_file_reads_no_column(spark, tmp_path):
    for i in range(3):
        io.write_table(forecast(spark, float(i)).coalesce(1), f"{tmp_path}/t/n={i}")
    assert "n=2/" in io.newest_file(spark, f"{tmp_path}/t")
    os.utime(next((Path(tmp_path) / "t" / "n=1").glob("*.parquet")), (4_000_000_000, 4_000_000_000))
    assert "n=1/" in io.newest_file(spark, f"{tmp_path}/t")
    same = [next((Path(tmp_path) / "t" / f"n={i}").glob("*.parquet")) for i in (0, 1, 2)]
    for f in same:
        os.utime(f, (4_100_000_000, 4_100_000_000))
    assert "n=2/" in io.newest_file(spark, f"{tmp_path}/t")
    plan = spark.read.parquet(f"{tmp_path}/t").select("_metadata.file_modification_time", "_metadata.file_path")
    assert "ReadSchema: struct<>" in plan._jdf.queryExecution().explainString(plan._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    io.write_table(forecast(spark).limit(0), f"{tmp_path}/empty")
    with pytest.raises(ContractError):
        io.newest_file(spark, f"{tmp_path}/empty")


def test_a_gate_stops_the_announcement(spark, tmp_path):
    base, at = f"{tmp_path}/gated", datetime(2024, 1, 1)
    rows = spark.range(400).select(F.lit(1).alias("station_id"), (F.lit(at).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id"))).alias("ts_local"), F.lit(1.0).alias("y"))
    first = publish_split(rows, base, at, 60, min_rows=59)
    with pytest.raises(ContractError, match="'test': 59"):
        publish_split(rows, base, at, 60, min_rows=60)
    assert io.latest_version(spark, base) == first
    assert spark.read.parquet(f"{base}/announced").count() == 1
    with pytest.raises(ContractError, match="negative_y"):
        publish_ready(rows.withColumn("y", F.lit(-1.0)), f"{base}/ready", at, 60, y="y")
    assert not io.path_exists(spark, f"{base}/ready/announced")
    publish_ready(rows, f"{base}/ready", at, 60, y="y")
    assert io.read_latest(spark, f"{base}/ready").count() == 400


def test_a_slot_replaces_its_own_partition_only(spark, tmp_path):
    path = f"{tmp_path}/slots"
    rows = spark.createDataFrame([(s, t, v) for s in range(20) for t, v in (("09:00", 1.0), ("13:00", 2.0))], "station_id long, slot_label string, yhat double")
    io.write_slots(rows, path)
    before = {f.name for f in Path(path).glob("slot_label=09*/*.parquet")}
    io.write_slots(rows.where("slot_label = '13:00' AND station_id < 5").withColumn("yhat", F.lit(7.0)), path)
    assert {f.name for f in Path(path).glob("slot_label=09*/*.parquet")} == before
    assert sorted((r.slot_label, r.yhat, r["count"]) for r in io.read_slots(spark, path).groupBy("slot_label", "yhat").count().collect()) == [("09:00", 1.0, 20), ("13:00", 7.0, 5)]
    one = io.read_slots(spark, path, "13:00")
    assert one.count() == 5 and all("slot_label=13" in f for f in (r.f for r in one.select(F.input_file_name().alias("f")).distinct().collect()))
    assert "PartitionFilters: [" in one._jdf.queryExecution().toString() or "isnotnull(slot_label" in one._jdf.queryExecution().toString()
