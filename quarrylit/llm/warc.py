"""WARC through a chunked record table.

Payloads never travel whole once they left their table: where a row is read the JVM cuts it
into rows (record identifier, chunk number, at most ``chunk_bytes``), which then meet the
answer whether their payload is a copy; the writer streams these rows
into gzipped WARC members and keeps a running SHA-1, and the reader streams archives back
into the same rows, each with the digest of the payload so far.

Archives are files in the folder that all machines share (``spark.checkpoint.dir`` unless
given), one or more for each writing task.  A task writes under a name of its own attempt
and reports it in the manifest, so a lost executor or a second attempt leaves at most an
unlisted file.  The manifest is written before anything is read.

Duplicates: of equal payloads (SHA-1 and length) of ``min_revisit_bytes`` or more, the row
with the largest record id is the response and the others are revisits of it.  Rows that
share that largest id are all responses.  A null payload is empty; a null id is written
as ``null``, is never a response that others refer to unless all ids of its payload are
null, and comes back as null.  A null url is left out.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh

CHUNK = 64 << 10
#: An archive is closed at the first record's end beyond this many compressed bytes.
ARCHIVE = 256 << 20
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "archive string, records long, bytes long"
CHUNKS = "archive string, record_id string, record_type string, refers_to string, target_uri string, chunk_no int, chunk_bytes int, data binary, payload_bytes long, payload_digest string, last boolean, declared_bytes long, declared_digest string"


def chunk_rows(pages: DataFrame, *, id_column: str = "page_id", url: str = "url", payload: str = "html", chunk_bytes: int = CHUNK, min_revisit_bytes: int = 0) -> DataFrame:
    """(record_id, url, sha1, size, refers_to, chunk_no, data): the chunked record table that a writer takes.

    Only (digest, size, id) is grouped; payloads move once, in chunks, to meet their group's answer.  A
    payload that a third of all rows hold is one key of that join, whose sides Spark splits at run time by
    the tasks that rows come from, so a record's chunks stay together; they are put in order there."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("string").alias("record_id"), F.col(id_column).alias("__id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.select("*", F.sha1("body").alias("sha1"), F.octet_length("body").cast("long").alias("size"))
    repeated = rows.where(F.col("size") >= min_revisit_bytes).groupBy("sha1", "size").agg(F.max("__id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(chunk_bytes)).cast("int"))
    rows = rows.select("*", F.monotonically_increasing_id().alias("__row"), chunks.alias("chunks"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    data = F.substring(F.col("body"), F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))
    rows = rows.select("record_id", "__id", "__row", "url", "sha1", "size", "chunks", "chunk_no", data.alias("data")).join(repeated, ["sha1", "size"], "left")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("__id").eqNullSafe(F.col("first_id")), F.col("first_id").cast("string"))
    rows = rows.withColumn("refers_to", refers).where(F.col("refers_to").isNull() | (F.col("chunk_no") == 0)).sortWithinPartitions("sha1", "size", "__row", "chunk_no")
    last = F.col("refers_to").isNotNull() | (F.col("chunk_no") == F.col("chunks") - 1)
    return rows.select("record_id", "url", "sha1", "size", "refers_to", "chunk_no", last.alias("last"), F.when(F.col("refers_to").isNull(), F.col("data")).otherwise(F.lit(b"")).alias("data"))


def _urn(record_id: str | None) -> str:
    return f"<urn:record:{quote('null' if record_id is None else 'id-' + record_id, safe='')}>"


def _un_urn(urn: str) -> str | None:
    from urllib.parse import unquote

    got = unquote(urn[len("<urn:record:") : -1])
    return None if got == "null" else got[3:]


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


class _Member:
    """A file that takes gzip members."""

    def __init__(self, out):
        self.out, self.bytes, self.gzip = out, 0, None

    def write(self, data: bytes) -> None:
        if self.gzip is None:
            self.gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(self.gzip.compress(data))

    def close(self) -> None:
        self._put(self.gzip.flush())
        self.gzip = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)


_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _head(record_id, url, sha1, size, refers_to) -> bytes:
    revisit = refers_to is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(record_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": "sha1:" + base32(sha1),
        "WARC-Payload-Length": str(size),
        "WARC-Refers-To": _urn(refers_to) if revisit else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "Content-Length": str(len(_HTTP) + (0 if revisit else size)),
    }
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None).encode() + b"\r\n" + _HTTP


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(folder)
    archives, member, stream, running, records, n = [], None, None, None, 0, 0
    tag = os.urandom(8).hex()

    def close() -> None:
        stream.close()
        archives.append((f"{folder}/{tag}-{n}.warc.gz", records, member.bytes))

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)) for c in ("record_id", "url", "sha1", "size", "refers_to", "chunk_no", "last", "data")]
        for i in range(batch.num_rows):
            record_id, url, sha1, size, refers_to, chunk_no, last = (c[i].as_py() for c in cols[:-1])
            if chunk_no == 0:
                if stream is None:
                    fs.create_dir(root, recursive=True)
                    stream = fs.open_output_stream(f"{root}/{tag}-{n}.warc.gz", compression=None)
                    member, records = _Member(stream), 0
                running = hashlib.sha1()
                member.write(_head(record_id, url, sha1, size, refers_to))
            data = cols[-1][i].as_buffer()
            running.update(data)
            member.write(data)
            if last:
                if refers_to is None and running.hexdigest() != sha1:
                    raise ValueError(f"record {record_id}: chunks don't add up to the payload")
                member.write(b"\r\n\r\n")
                member.close()
                records += 1
                if member.bytes >= archive_bytes:
                    close()
                    stream, n = None, n + 1
    if stream is not None:
        close()
    if archives:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*archives), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["archive", "records", "bytes"])


def write(pages: DataFrame, folder: str | None = None, *, archive_bytes: int = ARCHIVE, **options) -> DataFrame:
    """Writes the archives now; returns their manifest (archive, records, bytes), itself a table in the folder."""
    spark = pages.sparkSession
    folder = folder or fresh(spark, "warc")
    chunk_rows(pages, **options).mapInArrow(lambda it: _write(it, f"{folder}/archives", archive_bytes), MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class _Inflated:
    """A gzipped file as a stream of its members' bytes, never more than a piece at once."""

    def __init__(self, stream, piece: int = 256 << 10):
        self.stream, self.piece, self.gzip, self.buffer, self.raw = stream, piece, None, b"", b""

    def _more(self) -> bool:
        if not self.raw:
            self.raw = bytes(self.stream.read(self.piece))
            if not self.raw:
                return False
        if self.gzip is None:
            self.gzip = zlib.decompressobj(31)
        self.buffer += self.gzip.decompress(self.raw, self.piece)
        self.raw = self.gzip.unconsumed_tail
        if self.gzip.eof:
            self.raw, self.gzip = self.gzip.unused_data, None
        return True

    def line(self) -> bytes:
        while (k := self.buffer.find(b"\n")) < 0 and self._more():
            pass
        out, self.buffer = self.buffer[: k + 1], self.buffer[k + 1 :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out

    def head(self) -> dict[str, str] | None:
        """The fields of the next header block, up to its empty line; None at the end."""
        first = self.line()
        if not first:
            return None
        out = {"": first.decode().strip()}
        while line := self.line().strip():
            k, _, v = line.decode().partition(":")
            out[k.lower()] = v.strip()
        return out


def read_archive(stream, name: str, chunk_bytes: int = CHUNK, with_data: bool = True) -> Iterator[tuple]:
    """The chunk rows of one archive, in order; every record has at least one."""
    source = _Inflated(stream)
    while (head := source.head()) is not None:
        if not head[""].startswith("WARC/"):
            raise ValueError(f"{name}: no WARC record where one should begin")
        left = int(head["content-length"])
        refers_to = head.get("warc-refers-to")
        own = (name, _un_urn(head["warc-record-id"]), head["warc-type"], refers_to and _un_urn(refers_to), head.get("warc-target-uri"))
        declared = (int(x) if (x := head.get("warc-payload-length")) else None, re.sub("^sha1:", "", head.get("warc-payload-digest", "")) or None)
        if "application/http" in head.get("content-type", ""):
            while line := source.line():
                left -= len(line)
                if not line.strip():
                    break
        running, done, chunk_no = hashlib.sha1(), 0, 0
        while True:
            data = source.take(min(left, chunk_bytes))
            if len(data) < min(left, chunk_bytes):
                raise ValueError(f"{name}: cut off in {own[1]}")
            left -= len(data)
            done += len(data)
            running.update(data)
            yield (*own, chunk_no, len(data), data if with_data else None, done, base64.b32encode(running.digest()).decode(), left == 0, *declared)
            chunk_no += 1
            if not left:
                break
        source.take(4)


def _read(batches: Iterator[pa.RecordBatch], chunk_bytes: int, with_data: bool) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in CHUNKS.split(", "))])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, at = pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(at, compression=None) as stream:
                rows, held = [], 0
                for row in read_archive(stream, path, chunk_bytes, with_data):
                    rows.append(row)
                    held += row[6] if with_data else 64
                    if held > (8 << 20) or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def read(manifest: DataFrame, *, chunk_bytes: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of the manifest's archives: a row for each chunk, digests running."""
    spark: SparkSession = manifest.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("archive").repartition(n, "archive").mapInArrow(lambda it: _read(it, chunk_bytes, with_data), CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """Per record: id, payload length and digest, type, and the response that a revisit refers to.

    A record's last chunk has the whole payload's digest, so no chunks are brought together.  Revisits
    have what the header declares of the payload they refer to."""
    own = F.col("record_type") == "response"
    return chunks.where("last").select(
        "record_id",
        F.when(own, F.col("payload_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(own, F.col("payload_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        (~own | (F.col("payload_digest") == F.col("declared_digest"))).alias("digest_matches"),
    )
