"""Files of a run: documents, per-stage records, run folders; and the sinks that write them."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """Every PDF below a folder: path, modification time, length, content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)


def stage(spark: SparkSession, folder: str, suffix: str, schema: StructType | str) -> DataFrame:
    """The records of a stage, one JSON file a document, with the file's stem; unreadable files are kept as `_corrupt_record`."""
    read = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if "_corrupt_record" not in read.names:
        read = StructType([*read.fields]).add("_corrupt_record", "string")
    rows = spark.read.schema(read).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).json(folder)
    return rows.withColumn("stem", F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), f"{suffix.replace('.', '[.]')}$", ""))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Folders below that hold results, with their newest file's time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder).select("path", "modificationTime")
    found = files.select(F.regexp_extract("path", "^(.*)/results/[^/]+$", 1).alias("run"), "modificationTime").where("run <> ''")
    return found.groupBy("run").agg(F.max("modificationTime").alias("newest"))


def latest_run(spark: SparkSession, folder: str) -> str | None:
    row = runs(spark, folder).orderBy(F.desc("newest"), F.desc("run")).first()
    return row["run"] if row else None


def pages(documents: DataFrame, reader: Callable[[bytes], list[str]]) -> DataFrame:
    """(path, page, text) by a reader of page texts, which is whatever PDF library there is; a document that it can't
    read is one row with page 0 and the error as text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    out += [(path, i, t) for i, t in enumerate(reader(bytes(content)), 1)]
                except Exception as e:  # one bad document must not fail the task
                    out.append((path, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "page", "text"])

    return documents.select("path", "content").mapInPandas(run, "path string, page int, text string")


def write_records(rows: DataFrame, folder: str, by: str = "decision") -> None:
    """Records as JSON in a folder for each decision; partitions that are written again are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(folder)


def append_lines(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").json(folder)


def save_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, where the session's own file systems reach."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def manifest(spark: SparkSession, folder: str, **settings) -> str:
    """What a run was started with, as run.json in its folder; returns the file's path."""
    path = f"{folder.rstrip('/')}/run.json"
    save_text(spark, path, json.dumps(settings, ensure_ascii=False, indent=2, sort_keys=True, default=str))
    return path


def zipped(files: DataFrame, root: str) -> bytes:
    """The files (path, content) of one run's export, below `root`, as a ZIP archive in the order of their paths."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for r in files.orderBy("path").toLocalIterator():  # a file at a time
            z.writestr(zipfile.ZipInfo(r["path"].split(root.rstrip("/") + "/", 1)[-1]), bytes(r["content"]), zipfile.ZIP_DEFLATED)
    return out.getvalue()
