"""Phrase collocation mining: word sequences that occur together more than their parts would say.

Texts are cut into pieces and words.  All 1- to max_n-grams of the pieces become rows, which are
hash-aggregated per language; each frequent phrase is cut after each of its words and joined with the
counts of both parts; scores are whole numbers of exact decimals; phrases that mostly stand inside one
longer by a word are taken out by an anti-join; windows rank the rest.

Most n-grams are rare, and no phrase with a rare part can be frequent.  So hashes are counted first:
each task sends its distinct hashes, sorted and packed, in one row a range of hashes (about three bytes
an n-gram).  Ranges that reach the least count set a bit in a bitmap of fixed size (``BITMAP``, 2^26 bits)
that all tasks get; n-grams without a bit make no row.  Hashes that share a bit or are equal only add
rows: what counts is the words, which the aggregation compares as they are.  With so many frequent phrases
that the bitmap is full, every n-gram makes its row; nothing else changes.

Defined cases: a null or empty text has no words; a null language is 'und', together with those called so;
repeated rows count each; equal scores are ordered by count and then by phrase, so no ties are left; an empty
table has no phrases.  Only A-Z are lower-cased.  Of other columns, whatever their names, nothing is read.
Texts are cut at batch slices between texts only, so a phrase never spans two of them; a long text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrowtext as at
from .shared import kept

#: Bits of the hashes that are counted, and the logarithm of the bitmap's bits.
KEY_BITS, BITMAP = 40, 26
#: Bytes of text whose n-grams a range of hashes holds, about; ranges are 256 to 2^20.
RANGE_BYTES = 4 << 20
#: Parts that a language's phrases are ranked in before its first ones are.
SPREAD = 64
_SLICE = 1 << 20

_WORDS = at.byte_table(separators=b" \t.,;:!?\n\x0b\x0c\r", lower=True)
_WORDS[0] = 1  # NUL is a word character; the table's 0 means none.  Where words are spelled, the bytes themselves are
_BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_LOWER = at.byte_table(lower=True)


class _Grams:
    """The n-grams of a slice, n by n: places of their first words, and hashes that a language is part of."""

    def __init__(self, batch: pa.RecordBatch, texts: at.Texts, max_n: int):
        self.words, self.max_n = at.Words(texts, _WORDS), max_n
        self.data = _LOWER[texts.data]
        langs = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        self.names = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[self.words.owner] if len(self.words) else np.zeros(0, np.int64)
        seeds = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.names], np.uint64)
        breaks = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(_BREAKS[texts.data], out=breaks[1:])
        self.piece = breaks[self.words.start] + self.words.owner
        self.seed = seeds[self.lang] if len(self.words) else np.zeros(0, np.uint64)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        one = h = self.words.hash
        for n in range(1, self.max_n + 1):
            if n > 1:
                h = at.joined(h[:-1], one[n - 1 :])
            size = len(h)
            if not size:
                return
            inside = np.flatnonzero(self.piece[:size] == self.piece[n - 1 :])
            yield n, inside, at.mix(h[inside] ^ self.seed[inside] ^ np.uint64(n))

    def spelled(self, n: int, first: np.ndarray) -> list[str]:
        """The words of n-grams, with one blank between."""
        data = self.data.tobytes()
        start, end = self.words.start[first].tolist(), self.words.end[first + n - 1].tolist()
        return [b" ".join(data[s:e].split()).decode("utf-8", "replace") for s, e in zip(start, end, strict=True)]


def _slices(batches: Iterator[pa.RecordBatch], max_n: int) -> Iterator[_Grams]:
    for batch in batches:
        for part, texts in at.slices(batch, "text", _SLICE):
            yield _Grams(part, texts, max_n)


def _packed(key: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted keys of one range as their differences, a plane of bytes after the other, then the counts."""
    gaps = np.diff(key, prepend=key[:1] >> np.uint64(32) << np.uint64(32)).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + count.tobytes()


def _unpacked(blob: pa.Buffer, base: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 5
    gaps = np.frombuffer(blob, np.uint8, 4 * n).reshape(4, n).T.copy().view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(base), np.frombuffer(blob, np.uint8, n, 4 * n)


def _bitmap(docs: DataFrame, max_n: int, least: int) -> np.ndarray:
    """A bit for each range of hashes in which an n-gram may occur `least` times, as bytes."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << min(20, max(8, int(log2(total / RANGE_BYTES + 1)) + 1))
    shift, most = np.uint64(64 - KEY_BITS), min(least, 255)  # counts beyond what is asked for are of no use
    width = (1 << KEY_BITS) // ranges

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _slices(batches, max_n):
            keys = [h >> shift for _, _, h in grams]
            if not keys:
                continue
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            count = np.minimum(count, most).astype(np.uint8)
            cut = np.searchsorted(key, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(width))
            full = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([_packed(key[cut[r] : cut[r + 1]], count[cut[r] : cut[r + 1]]) for r in full.tolist()], pa.binary())], ["range", "hashes"])

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_range, parts, held = None, [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, count = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(key, kind="stable")
            key, new = key[order], np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            sums = np.add.reduceat(count[order].astype(np.int64), np.flatnonzero(new))
            return key[new], np.minimum(sums, most).astype(np.uint8)

        def bits() -> pa.RecordBatch:
            key, count = merged()
            dense = np.zeros(width >> (KEY_BITS - BITMAP), bool)
            dense[(key[count >= most] - np.uint64(at_range * width) >> np.uint64(KEY_BITS - BITMAP)).astype(np.int64)] = True
            return pa.RecordBatch.from_arrays([pa.array([at_range], pa.int32()), pa.array([np.packbits(dense, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

        for batch in batches:
            for r, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                blob = value.as_buffer()
                if r != at_range and parts:
                    yield bits()
                    parts, held = [], 0
                at_range = r
                # gaps are told from the last multiple of 2^32 before the range
                parts.append(_unpacked(blob, r * width >> 32 << 32))
                held += len(parts[-1][0])
                if held > 1_000_000 and len(parts) > 1:
                    parts = [merged()]
                    held = len(parts[0][0]) // 2
            at.return_memory()
        if parts:
            yield bits()

    packed = docs.mapInArrow(hashes, "range int, hashes binary").repartition("range").sortWithinPartitions("range")
    out = np.zeros(1 << BITMAP - 3, np.uint8)
    # each range's part of the bitmap: all together its size, whatever the input's
    for row in packed.mapInArrow(often, "range int, bits binary").collect():
        part = np.frombuffer(row.bits, np.uint8)
        out[row.range * len(part) : (row.range + 1) * len(part)] = part
    return out


def counted(docs: DataFrame, *, max_n: int = 4, least: int = 30, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, a) of every phrase of 1 to max_n words that occurs `least` times, and (lang, n) with the number of all words."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bitmap = rows.sparkSession.sparkContext.broadcast(_bitmap(rows, max_n, least))
    shift = np.uint64(64 - BITMAP)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for grams in _slices(batches, max_n):
            sums = np.bincount(grams.lang, minlength=len(grams.names)) if len(grams.words) else np.zeros(len(grams.names), np.int64)
            yield _rows(grams.names, np.arange(len(grams.names)), 0, [""] * len(grams.names), sums)
            for n, first, h in grams:
                place = h >> shift
                may = bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 != 0
                first, h = first[may], h[may]
                if len(first):
                    start, end = grams.words.start[first], grams.words.end[first + n - 1]
                    # equal bytes of one language are one; what differs in its blanks is brought together by the aggregation
                    one, back = at.distinct(grams.data, start, end, at.span_hash(grams.data, start, end) ^ grams.seed[first])
                    own = first[one]
                    keys = back.astype(np.int64) * len(grams.names) + grams.lang[first]
                    key, count = np.unique(keys, return_counts=True)
                    of = grams.spelled(n, own)
                    yield _rows(grams.names, key % len(grams.names), n, [of[i] for i in (key // len(grams.names)).tolist()], count)
        at.return_memory()

    parts = rows.mapInArrow(phrases, "lang string, n int, phrase string, a long")
    sums = kept(parts.groupBy("lang", "n", "phrase").agg(F.sum("a").alias("a")).where((F.col("n") == 0) | (F.col("a") >= least)), "phrases")
    return sums.where(F.col("n") > 0), sums.where(F.col("n") == 0).select("lang", F.col("a").alias("n"))


def _rows(names: list[str], lang: np.ndarray, n: int, phrase: list[str], count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([names[i] for i in lang.tolist()], pa.string()), pa.array(np.full(len(phrase), n), pa.int32()), pa.array(phrase, pa.string()), pa.array(count, pa.int64())], ["lang", "n", "phrase", "a"])


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, n, phrase, a, l, r, score) of the frequent phrases of two words and more, by their lowest-scoring cut."""
    cut = F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")
    cuts = frequent.where("n > 1").select("lang", "n", "phrase", "a", cut).withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    part = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("(2000000BD * CAST(a AS DECIMAL(20, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    least = both.groupBy("lang", "n", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return least.select("lang", "n", "phrase", "a", "c.l", "c.r", "c.score")


def extended(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longer): of what stands inside a frequent phrase longer by one word, the largest count of such.

    A phrase inside one longer by several words is inside one longer by a single word too, which occurs as often at least."""
    head = F.expr("substring_index(phrase, ' ', n - 1)")
    tail = F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    inner = frequent.where("n > 2").select("lang", F.explode(F.array(head, tail)).alias("phrase"), "a")
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def mine(docs: DataFrame, *, max_n: int = 4, least: int = 30, percent: int = 80, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to max_n words by score, count and spelling."""
    frequent, totals = counted(docs, max_n=max_n, least=least, text=text, lang=lang)
    longer = extended(frequent).withColumnRenamed("phrase", "inner").withColumnRenamed("lang", "in_lang")
    found = scored(frequent)
    inside = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")) & (100 * F.col("longer") >= percent * F.col("a"))
    left = found.join(longer, inside, "left_anti")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    some = left.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = totals.withColumnRenamed("lang", "of")  # a row a language
    return ranked.drop("n").join(words, F.col("lang") == F.col("of")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
