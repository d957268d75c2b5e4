"""Document fingerprints: the quartile codes of hashed byte triplets' counts, and the text's length.

A text's byte triplets are counted in ``BUCKETS`` buckets.  Each bucket is then told by the quartile
of the buckets that its count lies in, two bits, and the length in bytes by its logarithm, eight steps
an octave.  Two digests differ by the sum of their codes' distances, as a share of the sum of their
larger codes, and by the distance of their lengths, which counts a fifth; both are between 0 and 1,
so the likeness, 1 less the difference, is too.  Equal texts have equal digests and likeness 1.

``neighbours`` compares each document with an edited text, whose second half is the beginning of the
next document, and with that document.  Documents are brought into the order of their ids by ranges,
once; each task goes through its run and keeps two texts at a time.  The first and the last document
of each run are written beside the results and meet in a small join.

Defined cases: a null or empty text has no triplets, code 0 everywhere and length 0; documents with
one id stand in the order of their texts' hashes, null ids first; the last document is followed by the
first, so a single one follows itself; an empty table has no rows.  Other columns, whatever their
names, are not read.  Texts are read whole, in chunks of a megabyte.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext as at
from .shared import kept

BUCKETS = 1024
#: Steps of an octave that lengths are told in; the lengths that lie this many apart are as different as can be.
_STEPS, _FAR = 8, 32
_LENGTH_WEIGHT = 0.25
_CHUNK = 1 << 20


def _tables(buckets: int) -> list[np.ndarray]:
    """For each place of a triplet, what each byte gives; a triplet's bucket is the three taken together by exclusive or."""
    if buckets & (buckets - 1) or not 4 <= buckets <= 1 << 16:
        raise ValueError(f"{buckets} buckets: a power of two from 4 to 65536 is needed")
    numbers = at.mix(np.arange(1, 769, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return [(x & np.uint64(buckets - 1)).astype(np.uint16) for x in numbers.reshape(3, 256)]


def codes(text: str, tables: list[np.ndarray], buckets: int = BUCKETS) -> np.ndarray:
    """The buckets' quartile codes, and the length's at the end."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(buckets, np.int64)
    for i in range(0, len(data) - 2, _CHUNK):
        part = data[i : i + _CHUNK + 2]
        counts += np.bincount(tables[0][part[:-2]] ^ tables[1][part[1:-1]] ^ tables[2][part[2:]], minlength=buckets)
    low, middle, high = np.sort(counts)[[buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1]]
    out = np.empty(buckets + 1, np.int16)
    out[:-1] = (counts > low).astype(np.int16) + (counts > middle) + (counts > high)
    out[-1] = round(_STEPS * float(np.log2(1 + len(data))))
    return out


def digest(found: np.ndarray) -> str:
    """Codes as text: the length's in three digits, then four buckets a byte in base 64."""
    quarters = found[:-1].astype(np.uint8).reshape(-1, 4)
    packed = quarters[:, 0] | quarters[:, 1] << 2 | quarters[:, 2] << 4 | quarters[:, 3] << 6
    return f"{found[-1]:03d}{base64.b64encode(packed.tobytes()).decode()}"


def decoded(text: str) -> np.ndarray:
    packed = np.frombuffer(base64.b64decode(text[3:]), np.uint8)
    return np.append((packed[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).ravel(), int(text[:3])).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal codes, 0 for those that share nothing and whose lengths are far apart."""
    larger = int(np.maximum(a[:-1], b[:-1]).sum())
    apart = int(np.abs(a[:-1] - b[:-1]).sum()) / larger if larger else 0.0
    lengths = min(1.0, abs(int(a[-1]) - int(b[-1])) / _FAR)
    return 1 - (apart + _LENGTH_WEIGHT * lengths) / (1 + _LENGTH_WEIGHT)


def edited(text: str, following: str) -> str:
    """The text with the beginning of the following one in place of its second half."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = (("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"), ("fingerprint", pa.string(), "string"), ("edited_fingerprint", pa.string(), "string"), ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double"))
_RESULT, _FIRST, _LAST = 0, 1, 2


class _Comparer:
    def __init__(self, buckets: int):
        self.buckets, self.tables = buckets, _tables(buckets)

    def codes(self, text: str) -> np.ndarray:
        return codes(text, self.tables, self.buckets)

    def row(self, text: str, own: np.ndarray, following: str, next_codes: np.ndarray) -> tuple:
        other = edited(text, following)
        changed = self.codes(other)
        return len(text), hashlib.sha256(other.encode("utf-8", "replace")).hexdigest(), digest(own), digest(changed), likeness(own, changed), likeness(own, next_codes)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


#: Rows that a task holds results of before it passes them on.
_ROWS = 512


def neighbours(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like its own are this and the next document's."""
    own = F.coalesce(F.col(text), F.lit(""))
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("id"), own.alias("text"), F.xxhash64(own).alias("tie"))
    runs = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    names = ", ".join(f"{n} {s}" for n, _, s in _COLUMNS)
    id_type = kind.simpleString()

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer, part, before, schema = _Comparer(buckets), TaskContext.get().partitionId(), None, None
        none = (None,) * len(_COLUMNS)
        for batch in batches:
            schema = schema or pa.schema([("id", batch.schema.field("id").type), *((n, t) for n, t, _ in _COLUMNS), ("border", pa.int32()), ("run", pa.int32()), ("text", pa.string())])
            for i in range(0, batch.num_rows, _ROWS):
                out = []
                for key, words in zip(*(batch.column(c).slice(i, _ROWS).to_pylist() for c in ("id", "text")), strict=True):
                    found = comparer.codes(words)
                    if before is None:
                        out.append((key, *none, _FIRST, part, words))
                    else:
                        out.append((before[0], *comparer.row(*before[1:], words, found), _RESULT, part, None))
                    before = key, words, found
                yield _batch(schema, out)
        if before is not None:
            yield _batch(schema, [(before[0], *none, _LAST, part, before[1])])
        at.return_memory()

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer = _Comparer(buckets)
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field("id").type), *((n, t) for n, t, _ in _COLUMNS)])
            for key, words, following in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "following")), strict=True):
                yield _batch(schema, [(key, *comparer.row(words, comparer.codes(words), following, comparer.codes(following)))])

    table = kept(runs.mapInArrow(along, f"id {id_type}, {names}, border int, run int, text string"), "fingerprints")
    ends = table.where(F.col("border") != _RESULT)
    # the numbers of the runs that have rows, one a task
    numbers = sorted(r.run for r in ends.where(F.col("border") == _LAST).select("run").collect())
    after = table.sparkSession.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1], strict=True)), "run int, next_run int")
    first = ends.where(F.col("border") == _FIRST).select(F.col("run").alias("next_run"), F.col("text").alias("following"))
    last = ends.where(F.col("border") == _LAST).select("id", "run", "text").join(after, "run").join(first, "next_run").select("id", "text", "following")
    whole = table.where(F.col("border") == _RESULT).drop("border", "run", "text").unionByName(last.mapInArrow(across, f"id {id_type}, {names}"))
    return whole.withColumnRenamed("id", id_column)
