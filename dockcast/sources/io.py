"""Scans and sinks: globs with provenance, fallbacks, append logs, versioned publishing, manifests."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.functions.values import slot_from_path, to_numeric
from dockcast.operators.contracts import ContractError, normalize_id

SLOT_PREDICTIONS = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("t_slot", T.TimestampNTZType()),
        T.StructField("slot_label", T.StringType()),
        T.StructField("yhat", T.DoubleType()),
    ]
)
STATIONS = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("capacity", T.DoubleType()),
    ]
)
#: Files per slot, at most: a slot with many stations is written by as many tasks.
SLOT_FILES = 16
METRICS_LONG = T.StructType(
    [
        T.StructField("framework", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob holds parquet, on whatever file system it names."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An optional input: a typed empty table where it is absent."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def scan_glob(spark: SparkSession, *paths: str, skip_corrupt: bool = False) -> DataFrame:
    """All files of a glob by column name, each row with its file. An unreadable file is an error; on request it is skipped (see unread_files)."""
    reader = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("source_file"))


def unread_files(spark: SparkSession, found: DataFrame, *paths: str) -> list[str]:
    """Files of a glob that gave no row to a scan that skips unreadable ones; an empty file is among them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths)).select(F.col("path").alias("source_file"))
    return sorted(r["source_file"] for r in listed.join(found.select("source_file").distinct(), "source_file", "left_anti").collect())


def newest_file(spark: SparkSession, *paths: str) -> str:
    """The file modified last, of those that hold rows; of equally new ones the last by path. Reads no column, only what is known about the files."""
    files = spark.read.parquet(*paths).select("_metadata.file_modification_time", "_metadata.file_path")
    newest = files.agg(F.max(F.struct("file_modification_time", "file_path"))["file_path"].alias("path")).first()["path"]
    if newest is None:
        raise ContractError(f"no file with rows under {list(paths)}")
    return newest


def load_predictions(spark: SparkSession, slots_path: str, horizon_path: str) -> DataFrame:
    """Slot predictions if there are any, else horizon predictions, else a typed empty table.

    One published version is read, so no row comes twice. A missing slot label is taken from the path.
    """
    for path in (slots_path, horizon_path):
        if not path_exists(spark, path):
            continue
        found = scan_glob(spark, path)
        if path == slots_path and "slot_label" not in found.columns:
            found = found.withColumn("slot_label", slot_from_path(F.col("source_file")))
        if "yhat" in found.columns:
            found = found.withColumn("yhat", to_numeric(F.col("yhat")))
        return normalize_id(found, "station_id") if "station_id" in found.columns else found
    return spark.createDataFrame([], SLOT_PREDICTIONS)


def load_stations(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first station table that exists, else a typed empty one; ids typed as in the predictions."""
    for path in paths:
        if path_exists(spark, path):
            return normalize_id(spark.read.parquet(path), "station_id")
    return spark.createDataFrame([], STATIONS)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Parquet, optionally partitioned; sorted inside each task's files where an order helps readers prune."""
    out = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_slots(df: DataFrame, path: str, slot: str = "slot_label") -> None:
    """Predictions partitioned by slot; a slot that is written again replaces its own partition and no other."""
    out = df.repartition(slot, F.pmod(F.xxhash64("station_id"), F.lit(SLOT_FILES))).sortWithinPartitions(slot, "station_id")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slot).parquet(path)


def read_slots(spark: SparkSession, path: str, *slots: str) -> DataFrame:
    """Slot predictions, of some slots only if any are named; the others' files are not opened. A slot label stays text."""
    found = spark.read.parquet(path)
    kept = [f for f in found.schema.fields if f.name != "slot_label"]
    typed = spark.read.schema(T.StructType([*kept, T.StructField("slot_label", T.StringType())])).parquet(path)
    return typed.where(F.col("slot_label").isin(*slots)) if slots else typed


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def append_metrics(df: DataFrame, path: str, run_id: str | None = None, run_ts: datetime | None = None) -> str:
    """Append rows to a metric log under a run id. Nothing already written is read or rewritten."""
    run = run_id or uuid.uuid4().hex
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz") if run_ts else F.current_timestamp().cast("timestamp_ntz")
    df.withColumns({"run_id": F.lit(run), "run_ts": stamp}).write.mode("append").parquet(path)
    return run


def append_params(spark: SparkSession, path: str, run_id: str, params: Mapping[str, object]) -> None:
    """Append a run's parameters as (run_id, name, value) rows; with the metric log this is the record of runs."""
    rows = [(run_id, name, str(value)) for name, value in params.items()]
    spark.createDataFrame(rows, "run_id string, name string, value string").write.mode("append").parquet(path)


def record_run(
    metrics: DataFrame, base: str, params: Mapping[str, object], artefacts: Mapping[str, str], run_id: str | None = None
) -> str:
    """Record a run: its metrics, its parameters, and where what it made is stored. Three logs under one folder, joined by run_id."""
    run = append_metrics(metrics, f"{base}/metrics", run_id)
    spark = metrics.sparkSession
    append_params(spark, f"{base}/params", run, params)
    if artefacts:
        rows = [(run, name, path) for name, path in artefacts.items()]
        spark.createDataFrame(rows, "run_id string, name string, path string").write.mode("append").parquet(f"{base}/artefacts")
    return run


def run_artefact(spark: SparkSession, base: str, run_id: str, name: str) -> str:
    """Where a run's artefact is stored."""
    found = spark.read.parquet(f"{base}/artefacts").where((F.col("run_id") == run_id) & (F.col("name") == name)).first()
    if found is None:
        raise ContractError(f"run {run_id} has no artefact {name!r}")
    return found["path"]


def version_tag(asof: datetime, step_minutes: int) -> str:
    return f"asof={asof:%Y%m%d_%H%M}/freq={step_minutes}"


def publish(
    df: DataFrame,
    base: str,
    asof: datetime,
    step_minutes: int,
    measures: Mapping[str, Column] | None = None,
    gate: Callable[[Mapping[str, object]], None] | None = None,
) -> str:
    """Write one version and then announce it.

    The announcement is a row appended to a small log, so a reader sees the previous version or the
    whole new one, and a job that dies halfway announces nothing. `measures` are aggregates that the write itself takes, without a pass of
    their own; the gate sees them before the announcement and stops it by an error.
    """
    path = f"{base}/versions/{version_tag(asof, step_minutes)}/{uuid.uuid4().hex}"
    seen = Observation()
    observed = df.observe(seen, *[c.alias(n) for n, c in measures.items()]) if measures else df
    observed.write.mode("errorifexists").parquet(path)
    if gate is not None:
        gate(seen.get if measures else {})
    announcement = df.sparkSession.range(1).select(
        F.lit(path).alias("path"),
        F.lit(asof.isoformat(sep=" ")).cast("timestamp_ntz").alias("asof"),
        F.lit(step_minutes).alias("freq_minutes"),
        F.current_timestamp().alias("published_at"),
    )
    announcement.write.mode("append").parquet(f"{base}/announced")
    return path


def latest_version(spark: SparkSession, base: str) -> str:
    """Path of the version announced last."""
    newest = F.max_by("path", F.struct("published_at", "path")).alias("path")
    row = spark.read.parquet(f"{base}/announced").agg(newest).first()
    if row["path"] is None:
        raise ContractError(f"nothing published under {base}")
    return row["path"]


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(latest_version(spark, base))


def write_manifest(df: DataFrame, path: str) -> None:
    """A one-row selection record as JSON."""
    df.write.mode("errorifexists").json(path)
