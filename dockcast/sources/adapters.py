"""The given tables seen as a status feed and a station table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.timestamps import hour_start


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def status(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("station_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts_local"),
        F.col("value").alias("num_bikes_available"),
        "event_id",
        "event_type",
        "props",
    )


def status_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """The feed at hour resolution, which has real duplicates of (station, time)."""
    return status(spark, folder).withColumn("ts_local", hour_start(F.col("ts_local")))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("station_id"),
        F.col("c_name").alias("name"),
        (F.lit(-34.60) + (key % 100) * F.lit(0.001)).alias("lat"),
        (F.lit(-58.40) + ((key * 7) % 100) * F.lit(0.001)).alias("lon"),
        (40 + key % 60).cast("double").alias("capacity"),
    )
