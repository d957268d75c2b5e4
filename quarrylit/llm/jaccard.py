"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word shingles as 64-bit hashes; their numeric order is the
global order.  It is cut into fragments, and a set into one segment for each fragment.

1. Sample.  Linked sets lack a bounded number of each other's shingles (Rule.spare), so the
   first ``sample * spare + 1`` shingles of both in the global order have a known number in
   common at least (Rule.least_met).  Only these samples move: to the tasks of their
   fragments, which count for each shingle the sets that have it.  Shingles of one set end
   there; of the others each set gets its own back, with the counts.
2. Candidates.  In the order of rising counts, the samples of linked sets meet among the first
   ``sample size - least_met + 1`` of each.  Most of a set's are met by nobody; a passage that
   many documents share is at the end of that order and brings sets together only where they
   hold little else.
3. Links first.  Of shingles in which the same sets meet one makes a group.  Each group has two
   hubs, its first and last set in a random order; each set is compared with the two that are
   hubs of most of its groups.  Sketches (bitmaps of a few bits a shingle) bound overlaps from
   above, and pairs that can't be linked go no further.  Verified links give components; ROUNDS
   of this, each with another order, leave few groups with sets of several components.
4. The rest.  Groups whose sets are still in several components are gone through pair by
   pair, in blocks of bounded size: a pair of one component needs no look, of others the
   sketches bound the overlap, and only pairs that may be linked go on to be verified.  A first
   pass verifies only the likeliest pair of each set in a block, so that few are
   left for the second, which takes them all, of the groups that had any in the first: components
   only grow, so the others have none later either.  No link is lost, and a group of near copies
   makes no square of rows.
5. Verification counts the overlap of each fragment separately and sums it per pair.
   Every set moves once for each pair it is in, cut into segments.

Hot shingles (in more than HOT_SHARE of a sample of documents, and so few in number) are
known to be shared, and don't go to a fragment's task at all; which shingles are taken for
hot changes the cost, never the links.

Equal sets are one node from the start, whatever their number.  What is kept between steps
is a table in the shared folder, so lost executors cost a step at most.

Ids of sets are 128-bit digests of their shingles: with n sets two different ones share an id
with a probability of about n**2 / 2**129.  Shingles are compared by 64 bits: a pair of sets
with m shingles is judged wrongly with a probability of about m**2 / 2**65.  Samples name shingles
and sets by 48 bits: two linked sets of one name may miss each other, 1 in 2**48 of such pairs.

Defined cases: a null, empty or word-less text has the empty set and is linked with
nothing; rows that repeat have the same component; a row with a null id is linked with
nothing and has a null component; fewer words than a shingle make one shingle of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .components import connected
from .shared import kept


@dataclass(frozen=True)
class Rule:
    """Linked: over * overlap >= share * union, of shingles of so many words (0.9 is 90 of 100)."""

    width: int = 3
    share: int = 90
    over: int = 100
    #: Fragments of a set that verification counts separately.
    fragments: int = 4
    #: Sets of a block, at most, when a group is gone through pair by pair; and their shingles, which bound a block's sketches.
    block: int = 4096
    block_shingles: int = 1 << 22

    #: Shingles of a sample for each one that a linked set may lack.
    sample: int = 2

    def spare(self, n):
        """The most of a set's n shingles that a linked one lacks: over * overlap >= share * n."""
        return n * (self.over - self.share) // self.over

    def sampled(self, n):
        """The number of shingles, the first of the global order, that stand for a set of n."""
        return np.minimum(n, self.sample * self.spare(n) + 1)

    def linked(self, overlap, a, b):
        return self.over * overlap >= self.share * (a + b - overlap)


@lru_cache(1 << 16)
def least_met(rule: Rule, n: int) -> int:
    """How many shingles the samples of a set of n and of any linked one have in common at least.

    Of the two samples take the one that ends first in the global order.  What the other set has of it, it
    has in its own sample; and it lacks at most what it lacks of the whole set, which the two sizes bound."""
    other = np.arange(-(-n * rule.share // rule.over), n * rule.over // rule.share + 1)
    overlap = -(-rule.share * (n + other) // (rule.over + rule.share))
    other, overlap = (x[overlap <= np.minimum(n, other)] for x in (other, overlap))
    return int(min((rule.sampled(n) - (n - overlap)).min(), (rule.sampled(other) - (other - overlap)).min()))


def sets_of(texts: at.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingle hashes, in order text by text, and the texts' bounds in them."""
    words = at.Words(texts, at.SPACED_LOWER)
    full = np.flatnonzero(at.ngram_starts(words, width))
    owner, shingle = [words.owner[full]], [at.ngrams(words.hash, width)[full]]
    for n in range(1, width):
        short = np.flatnonzero(words.count == n)
        first = words.bounds[short]
        h = at.mix(words.hash[first] + np.uint64(n))
        for k in range(1, n):
            h = at.joined(h, words.hash[first + k])
        owner.append(short)
        shingle.append(h)
    owner, shingle = np.concatenate(owner), np.concatenate(shingle)
    order = np.argsort(shingle, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    owner, shingle = owner[new], shingle[new]
    return shingle, np.searchsorted(owner, np.arange(texts.n + 1))


def set_ids(shingle: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A digest of 16 bytes of each set, as two numbers; both 0 for the empty set only."""
    size = np.diff(bounds)
    out = np.zeros((len(size), 2), np.uint64)
    for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
        total = np.zeros(len(shingle) + 1, np.uint64)
        np.cumsum(at.mix(shingle ^ np.uint64(salt)), out=total[1:])
        out[:, k] = at.mix(total[bounds[1:]] - total[bounds[:-1]] + size.astype(np.uint64) * np.uint64(salt))
    out[size == 0] = 0
    return out


def _binaries(rows: np.ndarray) -> pa.Array:
    """Rows of equal length as binary values."""
    width = rows.shape[1] * rows.dtype.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def fragment(shingle: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of the global order that a shingle is in: equal ranges of its upper 32 bits."""
    return ((shingle >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


def sketch(shingle: np.ndarray) -> bytes:
    """A bitmap of four to eight bits a shingle, by the shingles' upper bits; halves fold together pairwise."""
    bits = max(64, 1 << int(4 * len(shingle) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(shingle >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _fold(maps: np.ndarray, width: int) -> np.ndarray:
    """Rows of bitmaps (bytes) folded to a smaller width in bytes: neighbouring bits are or-ed."""
    while maps.shape[-1] > width:
        bits = np.unpackbits(maps, axis=-1)
        maps = np.packbits(bits[..., ::2] | bits[..., 1::2], axis=-1)
    return maps


def _bound(x: np.ndarray, nx: int, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """No set of y (rows of one width) has more in common with x than this: a bit that one lacks is a shingle that it lacks."""
    width = min(x.shape[-1], y.shape[-1])
    x, y = _fold(x, width), _fold(y, width)
    lacks = lambda a, b: np.bitwise_count((a & ~b).reshape(len(y), -1)).sum(1, dtype=np.int64)
    return np.minimum(nx - lacks(np.broadcast_to(x, y.shape), y), ny - lacks(y, x))


def document_sets(docs: DataFrame, rule: Rule, text: str, id_column: str) -> DataFrame:
    """Per row: doc_id, the size n of its set, the set's id sid (null for the empty set) and the id's first 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, "text"):
                shingle, bounds = sets_of(texts, rule.width)
                ids, n = set_ids(shingle, bounds), np.diff(bounds)
                met = np.array([least_met(rule, x) if x else 0 for x in n.tolist()], np.int64)
                sid = _binaries(ids).filter(pa.array(n > 0)) if not n.all() else _binaries(ids)
                if not n.all():
                    sid = sid.take(pa.array(np.cumsum(n > 0) - 1, mask=n == 0))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), sid, pa.array(ids[:, 0].view(np.int64)), pa.array(rule.sampled(n)), pa.array(met)], names=["doc_id", "n", "sid", "lo", "sampled", "met"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType)]).add("n", "long").add("sid", "binary").add("lo", "long").add("sampled", "long").add("met", "long")
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


class _Once:
    """Tells whether an id is met for the first time; forgets all at MOST ids, which only lets copies pass."""

    MOST = 500_000

    def __init__(self):
        self.seen: set[bytes] = set()

    def __call__(self, key: bytes) -> bool:
        if key in self.seen:
            return False
        if len(self.seen) >= self.MOST:
            self.seen.clear()
        self.seen.add(key)
        return True


#: First groups of a set that its rows tell of.
KNOWN = 16
#: Rounds of comparing sets with hubs.
ROUNDS = 2
#: Sampled shingles that a task holds before it hands them out, and about how many a fragment has.
HELD = 1 << 19
FRAGMENT = 1 << 19
#: A shingle is hot that more than this share of HOT_SAMPLE documents has.
HOT_SHARE = 0.01
HOT_SAMPLE = 8_000
_HOT_COUNT = (1 << 31) - 1


def _samples(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shingle, first 64 bits of the set's id) of the samples.  Copies within a task are left out."""
    once = _Once()
    for batch in batches:
        for _, texts in at.slices(batch, "text"):
            shingle, bounds = sets_of(texts, rule.width)
            ids, n = set_ids(shingle, bounds), np.diff(bounds)
            raw = ids.tobytes()
            new = np.fromiter((k > 0 and once(raw[16 * i : 16 * i + 16]) for i, k in enumerate(n.tolist())), bool, len(n))
            rank = np.arange(len(shingle)) - np.repeat(bounds[:-1], n)
            take = rank < np.repeat(np.where(new, rule.sampled(n), 0), n)
            yield shingle[take], np.repeat(ids[:, 0], n)[take]


def _hot(docs: DataFrame, rule: Rule, documents: int) -> np.ndarray:
    """Hot shingles, in order: at most 1 / HOT_SHARE times as many as a sample has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingle, lo in _samples(batches, rule):
            yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(lo.view(np.int64))], names=["shingle", "lo"])

    share = min(1.0, HOT_SAMPLE / max(1, documents))
    some = docs if share == 1 else docs.sample(share, seed=17)
    found = some.mapInArrow(run, "shingle long, lo long").distinct().groupBy("shingle").count().where(F.col("count") > max(80, HOT_SHARE * min(documents, HOT_SAMPLE)))
    return np.sort(found.select("shingle").toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def _hand_out(held: list[tuple[np.ndarray, np.ndarray]], fragments: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row (fragment, shingles, sets) for each fragment: upper 6 bytes of shingles, lower 6 of the first 8 of sets' ids.

    Hot shingles go by their sets, to fragments from `fragments` on, which only drop repeats."""
    shingle, lo = (np.concatenate(x) for x in zip(*held, strict=True))
    f = fragment(shingle, fragments)
    if len(hot):
        at_hot = np.minimum(np.searchsorted(hot, shingle), len(hot) - 1)
        f = np.where(hot[at_hot] == shingle, fragments + (lo % np.uint64(fragments)).astype(np.int64), f)
    order = np.lexsort((shingle, f))
    shingle, lo, f = shingle[order], lo[order], f[order]
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(f)) + 1, [len(f)]))
    upper = shingle.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    lo = lo.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    for some in np.array_split(np.arange(len(bounds) - 1), max(1, len(f) >> 18)):
        if len(some):
            cut = [(int(f[bounds[i]]), upper[bounds[i] : bounds[i + 1]].tobytes(), lo[bounds[i] : bounds[i + 1]].tobytes()) for i in some.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*cut, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["fragment", "shingles", "sets"])


def _wide(six: bytes) -> np.ndarray:
    """Numbers of six bytes each."""
    out = np.zeros((len(six) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
    return out.view("<i8").reshape(-1)


def _count_sets(batches: Iterator[pa.RecordBatch], fragments: int) -> Iterator[pa.RecordBatch]:
    """Rows of fragments in order -> (part, shingle, sets): the shingles that several sets have, with the number of these.

    A set is named by a part of its id, so that few may share a name."""

    def finish(f: int, held: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        shingle, lo = (_wide(b"".join(x[k] for x in held)) for k in (0, 1))
        order = np.lexsort((lo, shingle))
        shingle, lo = shingle[order], lo[order]
        new = np.ones(len(lo), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (lo[1:] != lo[:-1])
        shingle, lo = shingle[new], lo[new]
        first = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
        sets = np.diff(np.append(first, len(lo)))
        sets = np.repeat(sets, sets) if f < fragments else np.full(len(lo), _HOT_COUNT)
        shared = sets > 1
        yield pa.RecordBatch.from_arrays([pa.array(lo[shared]), pa.array(shingle[shared]), pa.array(sets[shared], pa.int64())], names=["part", "shingle", "sets"])

    now, held = None, []
    for batch in batches:
        for f, shingles, sets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if f != now and held:
                yield from finish(now, held)
                held = []
                at.return_memory()
            now = f
            held.append((shingles, sets))
    if held:
        yield from finish(now, held)


def candidate_keys(docs: DataFrame, sets: DataFrame, rule: Rule, text: str, id_column: str) -> DataFrame:
    """(key, sid, lo, n): the shingles in which each set may meet a linked one, without those that it alone has."""
    texts = docs.where(F.col(id_column).isNotNull()).select(F.col(text).alias("text"))
    size = sets.agg(F.count("*").alias("sets"), F.sum("sampled").alias("sampled")).first()
    fragments = (size["sampled"] or 0) // FRAGMENT + 1
    hot = docs.sparkSession.sparkContext.broadcast(_hot(texts, rule, size["sets"]))

    def hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for own in _samples(batches, rule):
            held.append(own)
            n += len(own[0])
            if n >= HELD:
                yield from _hand_out(held, fragments, hot.value)
                held, n = [], 0
                at.return_memory()
        if n:
            yield from _hand_out(held, fragments, hot.value)

    dealt = texts.mapInArrow(hand_out, "fragment long, shingles binary, sets binary").repartition("fragment").sortWithinPartitions("fragment")
    shared = dealt.mapInArrow(lambda it: _count_sets(it, fragments), "part long, shingle long, sets long")
    # should two sets have the same part, each has the other's shingles too, which only makes more keys
    own = Window.partitionBy("part", "sid")
    met = shared.join(sets.select(F.expr(f"lo & {(1 << 48) - 1}L").alias("part"), "lo", "sid", "n", "sampled", "met"), "part")
    met = met.select("*", F.row_number().over(own.orderBy("sets", "shingle")).alias("place"), F.count("*").over(own).alias("shared"))
    # the shingles that nobody else has come first in the order of counts
    return met.where("place <= sampled - met + 1 - (sampled - shared)").select(F.col("shingle").alias("key"), "sid", "lo", "n")


#: Bits of the filter that keeps sets which no later step asks for out of the shuffle: 8 MB at any size of input.
FILTER_BITS = 26


def _filter(wanted: DataFrame):
    """A broadcast bitmap over ids (a Bloom filter of one hash): sets outside it aren't wanted.

    Its words are or-ed together by Spark; what the driver gets is the bitmap, whatever the number of ids."""
    bits = wanted.select(F.expr(f"pmod(lo, {1 << FILTER_BITS})").alias("bit"))
    words = bits.selectExpr("cast(bit div 32 as int) as word", "shiftleft(1L, cast(bit % 32 as int)) as bits").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = words.toPandas()
    out = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    return wanted.sparkSession.sparkContext.broadcast(out)


def _maybe(words: np.ndarray, lo: np.ndarray) -> np.ndarray:
    bit = (lo % np.uint64(1 << FILTER_BITS)).astype(np.int64)
    return (words[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1


def _tokens(docs: DataFrame, wanted: DataFrame, rule: Rule, text: str, id_column: str) -> DataFrame:
    """The shingles of the wanted sets by fragment, and their sketch: (sid, fragment, n, shingles, sketch of fragment 0)."""
    needed = _filter(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            for _, texts in at.slices(batch, "text"):
                shingle, bounds = sets_of(texts, rule.width)
                ids = set_ids(shingle, bounds)
                raw, out = ids.tobytes(), []
                for i in np.flatnonzero(_maybe(needed.value, ids[:, 0]) & (np.diff(bounds) > 0)).tolist():
                    sid = raw[16 * i : 16 * i + 16]
                    if once(sid):
                        own = shingle[bounds[i] : bounds[i + 1]]
                        cut = np.searchsorted(fragment(own, rule.fragments), np.arange(rule.fragments + 1))
                        out += [(sid, f, len(own), own[cut[f] : cut[f + 1]].astype("<u8").tobytes(), None if f else sketch(own)) for f in range(rule.fragments)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["sid", "fragment", "n", "shingles", "sketch"])

    made = docs.where(F.col(id_column).isNotNull()).select(F.col(text).alias("text")).mapInArrow(run, "sid binary, fragment int, n long, shingles binary, sketch binary")
    return made.join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid", "fragment"])


def verified(pairs: DataFrame, tokens: DataFrame, rule: Rule) -> DataFrame:
    """Of the pairs (a, b) those that are linked: overlaps are counted fragment by fragment and summed per pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(4), batch.column(5)
            partial = np.fromiter((_common(np.frombuffer(left[i].as_buffer(), "<u8"), np.frombuffer(right[i].as_buffer(), "<u8")) for i in range(batch.num_rows)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(partial)], names=["a", "b", "na", "nb", "partial"])

    # only what pairs ask for is shuffled: a filter's false positives go with the join
    needed = _filter(pairs.select(F.explode(F.array("a", "b")).alias("sid")).select(F.xxhash64("sid").alias("lo")))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, lo = batch.columns
            keep = pa.array(_maybe(needed.value, lo.to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(keep)

    tokens = tokens.select("sid", "fragment", "n", "shingles", F.xxhash64("sid").alias("lo")).mapInArrow(asked, "sid binary, fragment int, n long, shingles binary")
    # a row for each pair and fragment meets both sets by the same columns, so that the sets move once for both
    one, two = (tokens.select(F.col("sid").alias(f"id{c}"), F.col("fragment").alias(f"f{c}"), F.col("n").alias(f"n{c}"), F.col("shingles").alias(f"s{c}")) for c in "ab")
    cut = pairs.select("a", "b", F.explode(F.array(*(F.lit(f) for f in range(rule.fragments)))).alias("fragment"))
    for c, side in (("a", one), ("b", two)):
        cut = cut.join(side, (F.col(c) == F.col(f"id{c}")) & (F.col("fragment") == F.col(f"f{c}"))).drop(f"id{c}", f"f{c}")
    met = cut.select("a", "b", "na", "nb", "sa", "sb")
    partial = met.mapInArrow(run, "a binary, b binary, na long, nb long, partial long")
    summed = partial.groupBy("a", "b").agg(F.sum("partial").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return summed.where(rule.linked(F.col("overlap"), F.col("na"), F.col("nb"))).select("a", "b")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _likely(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, sketch of a, sketch of b) -> the pairs that may be linked."""
    for batch in batches:
        na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        for i in np.flatnonzero(rule.over * np.minimum(na, nb) >= rule.share * np.maximum(na, nb)).tolist():
            x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint8) for k in (4, 5))
            keep[i] = rule.linked(_bound(x, na[i], y[None], nb[i : i + 1])[0], na[i], nb[i])
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])


def _rest_pairs(batches: Iterator[pa.RecordBatch], rule: Rule, likeliest: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, i, j, place, sid, n, component, sketch, earlier) of blocks -> (a, b, key) of pairs that may be linked.

    A pair comes out of no group if one of a lesser key is among the first ones of both sets, and out of few groups else."""
    held: list[tuple] = []
    key = None
    for batch in batches:
        for *now, place, sid, n, component, bits, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != key and held:
                yield from _block_pairs(key, held, rule, likeliest)
                held = []
            key = now
            held.append((place, sid, n, component, np.frombuffer(bits, np.uint8), frozenset(keys)))
    if held:
        yield from _block_pairs(key, held, rule, likeliest)


def _block_pairs(key: list, held: list[tuple], rule: Rule, likeliest: bool) -> Iterator[pa.RecordBatch]:
    group, i, j = key
    held.sort(key=lambda h: h[1])
    sid = [h[1] for h in held]
    own, n = (np.array([h[k] for h in held], np.int64) for k in (0, 2))
    component = np.unique([h[3] for h in held], return_inverse=True)[1]
    widths = np.array([len(h[4]) for h in held])
    maps = {w: np.stack([h[4] for h in held if len(h[4]) == w]) for w in np.unique(widths).tolist()}
    place = np.zeros(len(held), np.int64)  # of a row among those of its width
    for w in maps:
        place[widths == w] = np.arange(len(maps[w]))
    out = []
    for x in np.flatnonzero(own == i).tolist():
        may = (own == j) & (component != component[x]) & (rule.over * np.minimum(n, n[x]) >= rule.share * np.maximum(n, n[x]))
        if i == j:
            may[: x + 1] = False
        near: dict[int, tuple[float, int]] = {}
        for w in maps:
            y = np.flatnonzero(may & (widths == w))
            if len(y):
                bound = _bound(held[x][4], n[x], maps[w][place[y]], n[y])
                fit = rule.linked(bound, n[x], n[y])
                for z, o in zip(y[fit].tolist(), bound[fit].tolist(), strict=True):
                    if held[x][5].isdisjoint(held[z][5]):
                        share = o / (n[x] + n[z] - o)
                        to = -1 if likeliest else z
                        near[to] = max(near.get(to, (0.0, 0)), (share, z))
        out += [(sid[min(x, z)], sid[max(x, z)]) for _, z in near.values()]
    if out:
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in zip(*out, strict=True)), pa.array([group] * len(out), pa.int64())], names=["a", "b", "key"])


def _with_components(groups: DataFrame, components: DataFrame) -> DataFrame:
    return groups.join(components.withColumnRenamed("node", "sid"), "sid", "left").select("key", "sid", "n", F.coalesce("component", "sid").alias("component"))


def _stars(groups: DataFrame, components: DataFrame, salt: int) -> DataFrame:
    """Pairs of sets with two hubs of other components: those of most of the set's groups."""
    rows = _with_components(groups, components)
    one = F.struct(F.xxhash64("sid", F.lit(salt)), "sid", "component")
    # rows of a group are combined before they move, and then met by one row: the join's skew is Spark's to split
    hubs = rows.groupBy("key").agg(F.min(one).alias("first"), F.max(one).alias("last"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    met = rows.join(hubs.select("key", "first", "last"), "key").select("sid", "component", F.explode(F.array("first", "last")).alias("hub")).where("component <> hub.component")
    best = Window.partitionBy("sid").orderBy(F.desc("count"), "hub")
    few = met.groupBy("sid", F.col("hub.sid").alias("hub")).count().withColumn("place", F.row_number().over(best)).where("place <= 2")
    return few.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()


def _rest(groups: DataFrame, sketches: DataFrame, components: DataFrame, rule: Rule, likeliest: bool) -> DataFrame:
    """(a, b, key): pairs of different components that share the group and may be linked, all or a block's likeliest one of each set."""
    rows = _with_components(groups, components)
    open_ = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"), F.sum("n").alias("shingles")).where("lo <> hi")
    open_ = open_.select("key", F.ceil(F.greatest(F.col("members") / F.lit(rule.block), F.col("shingles") / F.lit(rule.block_shingles))).cast("int").alias("blocks"))
    rows = kept(rows.join(open_, "key"), "open")
    keys = rows.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list("key")), 1, KNOWN).alias("keys"))  # a set has no more of them than shingles in its sample
    rows = rows.join(keys, "sid").join(sketches.select("sid", "sketch"), "sid")
    place = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    rows = rows.select("key", "sid", "n", "component", "sketch", "keys", "blocks", place.alias("place"))
    # a block meets itself and every other one: each pair of blocks is a unit of work of two blocks at most
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("place", "other").alias("i"), F.greatest("place", "other").alias("j"), "place", "sid", "n", "component", "sketch", F.filter("keys", lambda k: k < F.col("key")).alias("earlier"))
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(lambda it: _rest_pairs(it, rule, likeliest), "a binary, b binary, key long")


def components(docs: DataFrame, rule: Rule = Rule(), *, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id that links lead to, its own included)."""
    own = kept(document_sets(docs, rule, text, id_column), "sets")
    sets = own.where("sid is not null and doc_id is not null").groupBy("sid")
    sets = kept(sets.agg(F.min("doc_id").alias("least"), *(F.min(c).alias(c) for c in ("lo", "n", "sampled", "met"))), "distinct")
    found = _set_components(docs, sets, rule, text, id_column)
    whole = sets.select("sid", "least").join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    whole = kept(whole, "components")
    whole = whole.join(whole.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("sid", "component_id")
    # equal sets are as many rows as there are copies of them: the join's skew is Spark's to split
    out = own.select("doc_id", "n", "sid").join(whole, "sid", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), component.cast(docs.schema[id_column].dataType).alias("component_id"))


def _set_components(docs: DataFrame, sets: DataFrame, rule: Rule, text: str, id_column: str) -> DataFrame:
    """(node, component) of every set that is linked with another one."""
    keys = kept(candidate_keys(docs, sets, rule, text, id_column), "keys")
    every = (F.min("sid").alias("first"), F.max("sid").alias("last"), F.count("*").alias("members"), F.bit_xor("lo").alias("all"))
    # a hot key's rows are combined before they move, and met by one row: the join's skew is Spark's to split
    met = keys.groupBy("key").agg(*every).where("members > 1").groupBy("first", "last", "members", "all").agg(F.min("key").alias("key"))
    groups = kept(keys.join(met.select("key"), "key", "left_semi"), "groups")
    wanted = kept(groups.groupBy("sid").agg(F.min("lo").alias("lo")), "wanted")
    groups = groups.select("key", "sid", "n")
    tokens = kept(_tokens(docs, wanted, rule, text, id_column), "tokens")
    sketches = tokens.where("fragment = 0").select("sid", "n", "sketch")
    one, two = (sketches.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    found = docs.sparkSession.createDataFrame([], "node binary, component binary")
    for salt in range(ROUNDS):
        both = _stars(groups, found, salt).join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")
        stars = kept(both.mapInArrow(lambda it: _likely(it, rule), "a binary, b binary"), "stars")
        found = _merged(found, verified(stars, tokens, rule))
    for likeliest in (True, False):
        pairs = kept(_rest(groups, sketches, found, rule, likeliest), "pairs")
        found = _merged(found, verified(pairs.select("a", "b").distinct(), tokens, rule))
        groups = groups.join(pairs.select("key").distinct(), "key", "left_semi")  # without a pair now, without one later
    return found


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components that these have with more links."""
    return connected(components.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def one_of_each(docs: DataFrame, rule: Rule = Rule(), *, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents without those linked, directly or over others, with one of a smaller id.

    Rows with a null id stay.  Of rows that share the smallest id of their component one stays for each text.

    Whole rows move only where a bitmap of the ids that go, or have several rows, can't rule theirs out: those ids'
    own and the bitmap's false positives, which a join tells apart.  The others stay where they are."""
    found = components(docs, rule, text=text, id_column=id_column).select(F.col(id_column).alias("__id"), "component_id").where("__id is not null")
    fate = found.groupBy("__id").agg(F.count("*").alias("__n"), F.count_if(F.col("__id") == F.col("component_id")).alias("__rows"))
    unsure = kept(fate.where("__n > 1 or __rows = 0").select("__id", "__rows"), "unsure")
    listed = _filter(unsure.select(F.xxhash64("__id").alias("lo")))

    @F.arrow_udf("boolean")
    def maybe(lo: pa.Array) -> pa.Array:
        return pa.array(_maybe(listed.value, lo.to_numpy().view(np.uint64)))

    moves = F.col(id_column).isNotNull() & maybe(F.xxhash64(id_column))
    met = docs.where(moves).join(unsure, F.col(id_column) == F.col("__id"), "left")
    known = met.where("__rows is null or __rows = 1")
    if unsure.where("__rows > 1").limit(1).count():
        known = known.unionByName(met.where("__rows > 1").dropDuplicates([id_column, text]))
    return docs.where(~moves).unionByName(known.drop("__id", "__rows"))
