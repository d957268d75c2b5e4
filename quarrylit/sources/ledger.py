"""Appends that may be repeated: a table of files that only a commit makes visible.

Tasks write Parquet files and hand their names to the driver in commit messages; one commit file lists them, so a reader sees
all of an append or nothing, and what a failed task or job left behind is never read.  `append` drops rows whose key an earlier
commit holds, so a run that is repeated adds nothing; a `batch` that was committed is not committed again, which makes a
stream's `foreachBatch` exact.  One writer at a time; readers may come at any time."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

_COMMITS = "_commits"


def _commits(path: str) -> list[dict]:
    files, base = fs.FileSystem.from_uri(path)
    found = files.get_file_info(fs.FileSelector(posixpath.join(base, _COMMITS), allow_not_found=True))
    names = sorted(i.path for i in found if i.base_name.endswith(".json"))
    return [json.loads(files.open_input_file(n).read()) for n in names]


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    rows: int = 0


@dataclass
class File(InputPartition):
    path: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, batch: str | None):
        self.path, self.schema, self.batch = path, schema.json(), batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, base = fs.FileSystem.from_uri(self.path)
        name, out, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        files.create_dir(base)
                        out = pq.ParquetWriter(files.open_output_stream(posixpath.join(base, name)), batch.schema)
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written([name] if out is not None else [], rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = _commits(self.path)
        if self.batch is not None and any(c["batch"] == self.batch for c in done):
            self.abort(messages)
            return
        names = [n for m in messages if m for n in m.files]
        if not names and done and self.batch is None:
            return
        files, base = fs.FileSystem.from_uri(self.path)
        files.create_dir(posixpath.join(base, _COMMITS))
        target = posixpath.join(base, _COMMITS, f"{len(done):010d}.json")
        with files.open_output_stream(f"{target}.tmp") as out:
            out.write(json.dumps({"files": names, "rows": sum(m.rows for m in messages if m), "schema": self.schema, "batch": self.batch}).encode())
        files.move(f"{target}.tmp", target)

    def abort(self, messages: list[Written | None]) -> None:
        files, base = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for n in m.files if m else ():
                files.delete_file(posixpath.join(base, n))


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[File]:
        return [File(n) for c in _commits(self.path) for n in c["files"]] or [File("")]

    def read(self, file: File) -> Iterator[pa.RecordBatch]:
        if file.path:
            files, base = fs.FileSystem.from_uri(self.path)
            yield from pq.ParquetFile(files.open_input_file(posixpath.join(base, file.path))).iter_batches(columns=self.columns)


class Ledger(DataSource):
    """`spark.read/write.format("ledger")`, with a URI as the path; a write may name its `batch`."""

    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> StructType:
        done = _commits(self.options["path"])
        if not done:
            raise ValueError(f"nothing has been committed to {self.options['path']}")
        return StructType.fromJson(json.loads(done[-1]["schema"]))

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a ledger is appended to")
        return _Writer(self.options["path"], schema, self.options.get("batch"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Ledger)


def append(rows: DataFrame, path: str, keys: list[str], batch: str | None = None) -> None:
    """Adds the rows whose keys no earlier commit holds.  Keys are compared as they are, null with null; rows that come
    together may share one.  Columns stay those of the first commit."""
    spark = rows.sparkSession
    register(spark)
    if _commits(path):
        there = spark.read.format("ledger").load(path)
        if there.columns != rows.columns:
            raise ValueError(f"the ledger has {there.columns}, not {rows.columns}")
        held = there.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        rows = rows.join(held, same, "left_anti")
    writer = rows.write.format("ledger").mode("append")
    (writer.option("batch", batch) if batch is not None else writer).save(path)


def each_batch(path: str, keys: list[str], name: str) -> Callable[[DataFrame, int], None]:
    """For a stream's foreachBatch: a batch that is tried again is written once."""
    return lambda rows, number: append(rows, path, keys, f"{name}-{number}")
