"""Status of phases from run logs, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"^\[(\d{2}:\d{2}:\d{2})\]\s*(.*)$"


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """(clock, message) of log lines, without terminal colours; lines of another form have a null clock."""
    plain = F.regexp_replace(column, "\x1b\\[[0-9;]*m", "")
    return lines.withColumn("clock", F.nullif(F.regexp_extract(plain, LINE, 1), F.lit(""))).withColumn("message", F.when(plain.rlike(LINE), F.regexp_extract(plain, LINE, 2)).otherwise(plain))


def last_status(lines: DataFrame, key: list[str], status: str, at: Column) -> DataFrame:
    """Per key the status of its last line: an aggregation that a stream can keep (update mode)."""
    return lines.groupBy(*key).agg(F.max_by(status, at).alias(status))


def failure_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(r"\b(?:error|failed|failure|traceback)\b"))


def tail(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the lines that files of a folder bring."""
    return parsed(spark.readStream.text(folder))


def watch(stream: DataFrame, name: str, path: str):
    """Starts a query that keeps each phase's last status in a table in memory; stop it by the returned handle.

    A line's phase is the word before its first colon; the latest clock wins."""
    rows = stream.select(F.regexp_extract("message", r"^([A-Za-z0-9_ ]+):", 1).alias("phase"), F.regexp_extract("message", r":\s*(\w+)", 1).alias("status"), F.col("clock").alias("at")).where("phase <> ''")
    return rows.groupBy("phase").agg(F.max_by("status", "at").alias("status")).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", path).start()
