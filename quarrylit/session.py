"""The session that the engine is meant to run in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "quarrylit", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; further settings as keyword arguments with _ for the dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("_", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; a session that is all on this machine may do
    without that setting and gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='quarrylit-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The rows in four tasks a core.  For rows that are few bytes but cost much: files are split by their bytes, so that a small
    file is one task whatever its rows cost."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)
