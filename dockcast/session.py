"""Session defaults and the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def build_session(app: str = "dockcast", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library is written for; a cluster's own settings win if passed."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{k: str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets a folder of its own."""
    path = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@lru_cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"dockcast-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, one per call."""
    return f"{shared_dir(spark)}/dockcast/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back.

    Cuts the lineage before a loop of jobs over the same rows, and survives lost executors
    because the rows live in the shared folder.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
