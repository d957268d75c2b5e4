"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams.

The benchmark's windows (13 consecutive normalised words; an item of fewer words is
one window) become a hash set.  Each document's words are hashed with a rolling
window, hits of the set are verified word by word, and the words inside verified
windows are marked.  Documents stream through row by row: no shuffle.

The set is broadcast in blocks of at most ``block_bytes`` of benchmark text, whose size
is computed before anything is sent.  With one block a text is read once and judged there.
With several, each block's pass over the texts gives only those that it hits, as a digest of
the text, packed bits of its hit words and the items; these rows are brought together by the
digest, so that no text moves or is written between blocks and any benchmark size gives
whole results.

Defined cases: a null or word-less text has no words and is clean; a null benchmark text
has no windows; a null item_id is written as the empty string, items that share an id are
one item; repeated document rows and rows without id each give a row; columns beside the text pass through,
whatever their names; very long texts are scanned whole; no documents give no rows, and of an empty
benchmark every document is clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .shared import kept

WINDOW = 13
#: Most benchmark text that one broadcast holds (its hash set takes about 20 times that).
BLOCK_BYTES = 4 << 20
_KEY, _BITS, _ITEMS = "__decon_key", "__decon_bits", "__decon_items"


class WindowSet:
    """The windows of some benchmark items: sorted hashes per length, and the words to verify hits."""

    def __init__(self, ids: list[str], texts: list[str | None], width: int):
        words = at.Words(at.Texts.of(pa.array(texts, pa.large_string())), at.ALNUM_LOWER)
        self.ids = ids
        flat = [words.folded[s:e].tobytes() for s, e in zip(words.start.tolist(), words.end.tolist(), strict=True)]
        self.words = [flat[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        lengths = np.minimum(words.count, width)
        self.by_length = {}
        for n in sorted({int(x) for x in lengths if x}):
            h = at.ngrams(words.hash, n)
            good = at.ngram_starts(words, n) & (lengths[words.owner[: len(h)]] == n)
            place = np.flatnonzero(good)
            order = place[np.argsort(h[place], kind="stable")]
            item = words.owner[order]
            near = np.zeros(1 << 20, bool)
            near[h[order] & np.uint64(len(near) - 1)] = True
            self.by_length[n] = (h[order], item, order - words.bounds[item], near)

    def hits(self, words: at.Words) -> Iterator[tuple[int, int, int]]:
        """(first word, length, item) of each verified occurrence."""
        for n, (hashes, items, offsets, near) in self.by_length.items():
            h = at.ngrams(words.hash, n)
            maybe = np.flatnonzero(near[h & np.uint64(len(near) - 1)] & at.ngram_starts(words, n))
            lo, hi = (np.searchsorted(hashes, h[maybe], side) for side in ("left", "right"))
            for k in np.flatnonzero(hi > lo):
                first = int(maybe[k])
                seen = [w for w in words.folded[words.start[first] : words.end[first + n - 1]].tobytes().split(b"\0") if w]
                for j in range(lo[k], hi[k]):
                    if self.words[items[j]][offsets[j] : offsets[j] + n] == seen:
                        yield first, n, int(items[j])


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in blocks whose text is within the bound (an item larger than that makes its own)."""
    sized = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")).where("text is not null")
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")
    parts = max(1, -(-sized.agg(size).first()["b"] // block_bytes))
    while parts > 1:
        by = sized.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))
        worst = by.groupBy("part").agg(size, F.count_distinct("text").alias("n")).where(f"b > {block_bytes} and n > 1").limit(1).count()
        if not worst:
            return [by.where(F.col("part") == p).select("id", "text") for p in range(parts)]
        parts *= 2
    return [sized]


def _marks(texts: at.Texts, words: at.Words, found: WindowSet) -> tuple[np.ndarray, list[set[str]]]:
    """Which words are hit, and each text's items."""
    turn = np.zeros(len(words) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(texts.n)]
    for first, n, item in found.hits(words):
        turn[first] += 1
        turn[first + n] -= 1
        items[words.owner[first]].add(found.ids[item])
    return np.cumsum(turn[:-1]) > 0, items


_REPORT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _digest(items: set[str] | list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _judged(rows: pa.RecordBatch, texts: at.Texts, words: at.Words, hit: np.ndarray, items: list, mode: str, share: int, text: str) -> pa.RecordBatch:
    """What the mode makes of rows: report columns beside theirs, rows that stay, or texts without their hit words."""
    total = np.concatenate(([0], np.cumsum(hit)))
    n_hit = total[words.bounds[1:]] - total[words.bounds[:-1]]
    bad = (n_hit > 0) & (share * n_hit >= words.count)
    if mode == "documents":
        return rows.filter(pa.array(~bad))
    if mode == "spans":
        out = rows.column(rows.schema.get_field_index(text)).to_pylist()
        for i in np.flatnonzero(n_hit).tolist():
            out[i] = _without(texts, words, i, hit[words.bounds[i] : words.bounds[i + 1]])
        return rows.set_column(rows.schema.get_field_index(text), text, pa.array(out, pa.string()))
    own = [rows.column(0), pa.array(words.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array([_digest(x) for x in items], pa.string()), pa.array(bad)]
    return pa.RecordBatch.from_arrays(own, names=[rows.schema.names[0], *_REPORT])


def _one_pass(batches: Iterator[pa.RecordBatch], text: str, windows, mode: str, share: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in at.slices(batch, text):
            words = at.Words(texts, at.ALNUM_LOWER)
            yield _judged(rows, texts, words, *_marks(texts, words, windows.value), mode, share, text)


def _hit_texts(batches: Iterator[pa.RecordBatch], windows) -> Iterator[pa.RecordBatch]:
    """Texts -> (digest, number of words, packed bits of hit words, items) of those that the block hits."""
    for batch in batches:
        for _, texts in at.slices(batch, "text"):
            words = at.Words(texts, at.ALNUM_LOWER)
            hit, items = _marks(texts, words, windows.value)
            out = [
                (hashlib.md5(texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()).hexdigest(), int(words.count[i]), np.packbits(hit[words.bounds[i] : words.bounds[i + 1]]).tobytes(), sorted(items[i]))
                for i in range(texts.n)
                if items[i]
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string())), strict=True)], names=[_KEY, "n", _BITS, _ITEMS])


def _any_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, n, list of bits, items) -> (digest, n, bits, n_hit, items)."""
    for batch in batches:
        bits = [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in own]) for own in batch.column(2).to_pylist()]
        n_hit = [int(np.bitwise_count(x).sum()) for x in bits]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(n_hit, pa.int64()), batch.column(3)], names=[_KEY, "n", _BITS, "n_hit", _ITEMS])


def _hit_by_any(docs: DataFrame, blocks: list, text: str) -> DataFrame:
    """A row for each different text that any block hits.  A text has a row a block at most."""
    items = T.ArrayType(T.StringType())
    schema = T.StructType().add(_KEY, "string").add("n", "long").add(_BITS, "binary").add(_ITEMS, items)
    found = None
    for windows in blocks:
        own = kept(docs.select(F.col(text).alias("text")).where("text is not null").mapInArrow(lambda it, w=windows: _hit_texts(it, w), schema), "hits")
        found = own if found is None else found.unionByName(own)
    whole = found.groupBy(_KEY).agg(F.min("n").alias("n"), F.collect_set(_BITS).alias("all"), F.array_distinct(F.flatten(F.collect_set(_ITEMS))).alias(_ITEMS))
    return kept(whole.select(_KEY, "n", "all", _ITEMS).mapInArrow(_any_of, T.StructType().add(_KEY, "string").add("n", "long").add(_BITS, "binary").add("n_hit", "long").add(_ITEMS, items)), "hits")


def _windows(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, width: int, block_bytes: int):
    """The broadcast windows of each block, one after the other."""
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        rows = block.collect()  # within block_bytes
        yield docs.sparkSession.sparkContext.broadcast(WindowSet([r["id"] for r in rows], [r["text"] for r in rows], width))


def _count_words(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in at.slices(batch, text):
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(at.Words(texts, at.ALNUM_LOWER).count, pa.int64())], names=[rows.schema.names[0], _KEY, "n_words"])


def _apply(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Rows with the bits of their hit words -> rows without these words."""
    for batch in batches:
        for rows, texts in at.slices(batch, text):
            words = at.Words(texts, at.ALNUM_LOWER)
            bits = rows.column(rows.schema.get_field_index(_BITS)).to_pylist()
            own = [np.unpackbits(np.frombuffer(b, np.uint8), count=int(n)).astype(bool) if b else np.zeros(int(n), bool) for b, n in zip(bits, words.count, strict=True)]
            plain = rows.select([n for n in rows.schema.names if n not in (_KEY, _BITS)])
            yield _judged(plain, texts, words, np.concatenate([np.zeros(0, bool), *own]), [], "spans", 1, text)


def _without(texts: at.Texts, words: at.Words, i: int, hit: np.ndarray) -> str:
    """The text without its hit words, each run of them cut from its first byte to its last."""
    at0, (a, b) = texts.offsets[i], words.bounds[i : i + 2]
    turn = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    starts, ends = words.start[a:b][np.flatnonzero(turn == 1)] - at0, words.end[a:b][np.flatnonzero(turn == -1) - 1] - at0
    raw, out, last = texts.data[at0 : texts.offsets[i + 1]].tobytes(), [], 0
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        out.append(raw[last:s])
        last = e
    return b"".join([*out, raw[last:]]).decode("utf-8", "replace")


def scan(docs: DataFrame, benchmark: DataFrame, *, share: int = 20, text: str = "text", id_column: str = "doc_id", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated (a share-th of its words or more is hit)."""
    schema = T.StructType([docs.schema[id_column]])
    for name, kind in zip(_REPORT, ("long", "long", "long", "string", "boolean"), strict=True):
        schema = schema.add(name, kind)
    blocks = list(_windows(docs, benchmark, item_id, item_text, width, block_bytes))
    rows = docs.select(id_column, text)
    if len(blocks) == 1:
        return rows.mapInArrow(lambda it: _one_pass(it, text, blocks[0], "report", share), schema)
    found = _hit_by_any(docs, blocks, text).select(_KEY, "n_hit", _ITEMS)
    counted = rows.withColumn(_KEY, F.md5(F.col(text).cast("binary"))).mapInArrow(lambda it: _count_words(it, text), T.StructType([docs.schema[id_column]]).add(_KEY, "string").add("n_words", "long"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.array_sort(F.coalesce(_ITEMS, F.array().cast("array<string>")))
    bad = (n_hit > 0) & (share * n_hit >= F.col("n_words"))
    return counted.join(found, _KEY, "left").select(id_column, "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), bad.alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, *, what: str = "documents", share: int = 20, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without the contaminated ones (what="documents"), or all of them without the hit words (what="spans")."""
    if what not in ("documents", "spans"):
        raise ValueError("what is 'documents' or 'spans'")
    blocks = list(_windows(docs, benchmark, item_id, item_text, width, block_bytes))
    if len(blocks) == 1:
        return docs.mapInArrow(lambda it: _one_pass(it, text, blocks[0], what, share), docs.schema)
    found = _hit_by_any(docs, blocks, text)
    keyed = docs.withColumn(_KEY, F.md5(F.col(text).cast("binary")))
    if what == "documents":
        return keyed.join(found.where((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n"))).select(_KEY), _KEY, "left_anti").select(*docs.columns)
    return keyed.join(found.select(_KEY, _BITS), _KEY, "left").select(*docs.columns, _KEY, _BITS).mapInArrow(lambda it: _apply(it, text), docs.schema)
