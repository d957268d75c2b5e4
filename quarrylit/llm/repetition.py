"""Quality rules: repetition inside a text, found with a suffix array over its words.

For all texts of a slice at once, the suffixes that share their first ``min_repeat`` words
with another suffix of the same text are sorted by prefix doubling.  Neighbours in that
order give longest common prefixes, whose intervals are the maximal repeated substrings;
the spans of their occurrences are united.  A text fails when the united spans hold too
large a share of its words, or when one repeat is too long: longer than a number of words,
as any share of the text that the base rule doesn't reach grows with the text.

Row by row, no shuffle; memory follows the slice (about 100 bytes a word, and 4 more for each
doubling).  Hashes only find what may be equal: words, lines and repeats are verified.

Defined cases: a null or empty text has no words and fails for having too few; ties and
repeated rows and rows without id are judged alike, each on its own; other columns, whatever their names,
pass through ``keep``; very long texts are judged whole; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import arrowtext as at


@dataclass(frozen=True)
class Limits:
    """min_words, and window_percent of words in repeated windows, make the base rule; the rest is the suffix array's."""

    min_words: int = 20
    window: int = 8
    window_percent: int = 30
    min_repeat: int = 4
    covered_percent: int = 40
    longest_words: int = 60


def repeats(words: at.Words, least: int) -> np.ndarray:
    """Of each word, the length of the longest prefix of the suffix that starts there which the same text
    holds at another place too; 0 where that has fewer than `least` words."""
    n = len(words)
    out = np.zeros(n, np.int64)
    h = at.ngrams(words.hash, least)
    inside = np.flatnonzero(at.ngram_starts(words, least))
    key = h[inside] ^ at.mix(words.owner[inside].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    if not same.any():
        return out
    member = np.zeros(len(key), bool)
    member[1:] |= same
    member[:-1] |= same
    suffix = inside[order[member]]
    # equal hashes are verified by the words themselves
    word = at.distinct(words.folded, words.start, words.end, words.hash)[1]
    parts = [words.owner[suffix], *(word[suffix + k] for k in range(least))]
    by = np.lexsort((*reversed(parts), key[member]))
    suffix = suffix[by]
    new = np.ones(len(suffix), bool)
    new[1:] = np.logical_or.reduce([x[by][1:] != x[by][:-1] for x in parts])
    rank_of = lambda new: np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    group = rank_of(new)
    first_group = group.copy()
    rank = np.arange(n, 2 * n, dtype=np.int32 if n < 1 << 30 else np.int64)  # unlike any group's
    rank[suffix] = group
    text_end = words.bounds[1:][words.owner]
    step, active, levels = least, np.arange(len(suffix)), []
    while len(active):
        levels.append((step, rank.copy()))
        p = suffix[active]
        to = p + step
        follow = np.where(to < text_end[p], rank[np.minimum(to, n - 1)], -1 - p)
        by = np.lexsort((follow, group[active]))
        suffix[active], follow = p[by], follow[by]
        was = group[active]
        new = np.concatenate(([True], (was[1:] != was[:-1]) | (follow[1:] != follow[:-1])))
        group[active] = active[rank_of(new)]
        rank[suffix[active]] = group[active]
        _, back, size = np.unique(group[active], return_inverse=True, return_counts=True)
        active = active[size[back] > 1]
        step *= 2
    # longest common prefixes of neighbours, from the longest step that both share down to single words
    pairs = np.flatnonzero(first_group[1:] == first_group[:-1])
    a, b = suffix[pairs], suffix[pairs + 1]
    length = np.zeros(len(a), np.int64)
    left = lambda k: np.maximum(a, b) + k < text_end[a]
    for step, rank in reversed(levels):
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        length += np.where(left(length) & (rank[x] == rank[y]), step, 0)
    going = np.ones(len(a), bool)
    for _ in range(least - 1):
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        going &= left(length) & (word[x] == word[y])
        length += going
    np.maximum.at(out, a, length)
    np.maximum.at(out, b, length)
    return out


def _sum(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicate_lines(texts: at.Texts, inside: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    n = len(texts.data)
    breaks = np.flatnonzero(texts.data == 10)
    start = np.unique(np.concatenate((breaks + 1, texts.offsets[:-1])))
    start = start[start < n]
    owner = np.searchsorted(texts.offsets, start, "right") - 1
    end = np.minimum(texts.offsets[owner + 1], np.append(breaks, n)[np.searchsorted(breaks, start)])
    words = np.zeros(n + 1, np.int64)
    np.cumsum(inside, out=words[1:])
    full = words[end] > words[start]
    start, end, owner = start[full], end[full], owner[full]
    first, line = at.distinct(texts.data, start, end, at.span_hash(texts.data, start, end))
    own, size = np.unique(owner * max(1, len(first)) + line, return_counts=True)
    return np.bincount(own // max(1, len(first)), size - 1, texts.n).astype(np.int64)


def measure(texts: at.Texts, limits: Limits) -> dict[str, np.ndarray]:
    words = at.Words(texts, at.SPACED)
    length = repeats(words, min(limits.min_repeat, limits.window))
    place = np.flatnonzero(length >= limits.window)
    window = at.covered(place, length[place], len(words))
    place = np.flatnonzero(length >= limits.min_repeat)
    span = at.covered(place, length[place], len(words))
    longest = np.zeros(texts.n, np.int64)
    np.maximum.at(longest, words.owner, length)
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    n = words.count
    out = {
        "n_words": n,
        "word_chars": texts.per_text(words.inside & ((texts.data & 0xC0) != 0x80)),
        "n_symbols": texts.per_text(symbol[texts.data]),
        "n_dup_lines": _duplicate_lines(texts, words.inside),
        "n_repeat_words": _sum(window, words.bounds),
        "n_covered_words": _sum(span, words.bounds),
        "longest_repeat": longest,
    }
    out["base_failed"] = (n < limits.min_words) | (100 * out["n_repeat_words"] > limits.window_percent * n)
    out["kept"] = ~out["base_failed"] & (100 * out["n_covered_words"] <= limits.covered_percent * n) & (longest <= limits.longest_words)
    return out


_KINDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "n_covered_words": "long", "longest_repeat": "long", "base_failed": "boolean", "kept": "boolean"}


def score(docs: DataFrame, limits: Limits = Limits(), *, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, the counts, base_failed and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, text):
                got = measure(texts, limits)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(got[k]) for k in _KINDS)], names=[id_column, *_KINDS])

    schema = T.StructType([docs.schema[id_column]])
    for name, kind in _KINDS.items():
        schema = schema.add(name, kind)
    return docs.select(id_column, text).mapInArrow(run, schema)


def keep(docs: DataFrame, limits: Limits = Limits(), *, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, text):
                yield rows.filter(pa.array(measure(texts, limits)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def spans(text: str, limits: Limits = Limits()) -> list[tuple[int, int]]:
    """The united word spans of one text's maximal repeats."""
    words = at.Words(at.Texts.of(pa.array([text], pa.large_string())), at.SPACED)
    length = repeats(words, limits.min_repeat)
    place = np.flatnonzero(length)
    turn = np.diff(np.concatenate(([0], at.covered(place, length[place], len(words)).astype(np.int8), [0])))
    return list(zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True))
