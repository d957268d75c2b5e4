"""Vectorised text kernels over Arrow buffers.

A batch of texts is one flat byte buffer with document offsets.  Words, word
hashes and n-gram hashes are computed with whole-buffer numpy operations, so a
Python worker never loops over words.  Hashes are 64 bits wide and mixed at every
step (no sums of powers, under which arrangements of equal parts can cancel out);
``distinct`` verifies equal hashes against the bytes, for callers that need certainty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Text bytes that a kernel handles at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library: nothing to ask
    _LIBC = None

def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Steps of eight bytes that spans go through together; what is left of longer ones is hashed by itself.
_STEPS = 32
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_TURN = np.uint64(0x9FB21C651E98DF25)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as numbers."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; spans of one length up to eight bytes never share one."""
    size = end - start
    h = mix(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D))
    eight = _eights(data)
    active = np.flatnonzero(size)
    for k in range(_STEPS):
        if k:
            active = active[size[active] > 8 * k]
        if not len(active):
            return h
        block = eight[start[active] + 8 * k] & _MASK[np.minimum(size[active] - 8 * k, 8)]
        h[active] = mix(h[active] * _TURN ^ block)
    for i in active[size[active] > 8 * _STEPS].tolist():
        h[i] ^= np.uint64(xxhash.xxh3_64_intdigest(data[start[i] + 8 * _STEPS : end[i]].tobytes(), int(h[i])))
    return h


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each class of equal spans, and every span's class.  Equal hashes are verified by the bytes."""
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    first, back = order[new], np.empty(len(h), np.int64)
    back[order] = np.cumsum(new) - 1
    like, size = first[back], end - start
    wrong = size != size[like]
    eight = _eights(data)
    active = np.flatnonzero((like != np.arange(len(h))) & ~wrong)
    for k in range(_STEPS):
        active = active[size[active] > 8 * k]
        if not len(active):
            break
        mask = _MASK[np.minimum(size[active] - 8 * k, 8)]
        wrong[active] |= (eight[start[active] + 8 * k] ^ eight[start[like[active]] + 8 * k]) & mask != 0
    for i in active[size[active] > 8 * _STEPS].tolist():
        wrong[i] |= data[start[i] : end[i]].tobytes() != data[start[like[i]] : end[like[i]]].tobytes()
    if wrong.any():
        own: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(wrong).tolist():
            key = data[start[i] : end[i]].tobytes()
            if key not in own:
                own[key] = len(first) + len(more)
                more.append(i)
            back[i] = own[key]
        first = np.concatenate((first, more))
    return first, back


def byte_table(kept: str | bytes | None = None, *, separators: bytes = b"", lower: bool = False) -> np.ndarray:
    """256 entries: 0 for a separator, else the (lower-cased) byte."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM_LOWER = byte_table(separators=bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)
#: Words of `[^\x20\x09-\x0D]+`, as written and with A-Z lower-cased.  NUL is a word
#: character there, so the tables send it to 0x20, which no word holds.
SPACED = byte_table(separators=b" \t\n\x0b\x0c\r")
SPACED[0] = 32
SPACED_LOWER = byte_table(separators=b" \t\n\x0b\x0c\r", lower=True)
SPACED_LOWER[0] = 32


class Texts:
    """Some texts as one byte buffer; text i is data[offsets[i]:offsets[i + 1]], empty for null."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, null: np.ndarray):
        self.data, self.offsets, self.null = data, offsets, null
        self.n = len(offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        if not pa.types.is_string(column.type):
            column = column.cast(pa.large_string())
        null = np.asarray(column.is_null())
        if null.any():
            column = column.fill_null("")
        _, offs, data = column.buffers()
        kind = np.int32 if pa.types.is_string(column.type) else np.int64
        offsets = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(data[offsets[0] : offsets[-1]], offsets - offsets[0], null)

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")

    def per_text(self, byte_mask: np.ndarray) -> np.ndarray:
        """The number of set bytes of each text."""
        total = np.zeros(len(byte_mask) + 1, np.int64)
        np.cumsum(byte_mask, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


class Words:
    """The words of some texts: byte spans, owner text, and 64-bit hashes of the folded bytes."""

    def __init__(self, texts: Texts, table: np.ndarray):
        folded = table[texts.data]
        inside = folded != 0
        n = len(folded)
        opens, closes = inside.copy(), inside.copy()
        if n:
            opens[1:] &= ~inside[:-1]
            closes[:-1] &= ~inside[1:]
            edges = np.unique(texts.offsets[(texts.offsets > 0) & (texts.offsets < n)])
            opens[edges] = inside[edges]
            closes[edges - 1] = inside[edges - 1]
        self.inside, self.folded = inside, folded
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.bounds = np.searchsorted(self.start, texts.offsets)
        self.count = np.diff(self.bounds)
        self.owner = np.repeat(np.arange(texts.n), self.count)
        self.hash = span_hash(folded, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of what a and b are the hashes of, one after the other."""
    return mix(a * _TURN + (b ^ (b >> np.uint64(32))))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive entries (those past a text's end are the caller's to drop)."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out, width, part, done = None, 1, h, 0
    while True:
        if n & width:
            own = part[done : done + size]
            out = own if out is None else joined(out, own)
            done += width
        if done == n:
            return mix(out)
        part = joined(part[:-width], part[width:])
        width *= 2


def ngram_starts(words: Words, n: int) -> np.ndarray:
    """Of each position with n words before the batch's end, whether they lie in one text."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, bool)
    return words.owner[:size] == words.owner[n - 1 :]


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in a span."""
    turn = np.zeros(n + 1, np.int64)
    np.add.at(turn, starts, 1)
    np.add.at(turn, starts + lengths, -1)
    return np.cumsum(turn[:-1]) > 0


def return_memory() -> None:
    """Gives freed memory back to the system: workers live on, and an executor has several beside its heap."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in runs of rows whose texts have about `limit` bytes at most."""
    texts = Texts.of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < texts.n:
        to = max(at + 1, int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1)
        offs = texts.offsets[at : to + 1]
        yield batch.slice(at, to - at), Texts(texts.data[offs[0] : offs[-1]], offs - offs[0], texts.null[at:to])
        at = to
    del texts
    return_memory()
