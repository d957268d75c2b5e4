"""Mixture-controlled packing: deficit round-robin over source queues.

1. Texts become token ids (a white-space separated piece of text is encoded once per worker
   and remembered), kept as a table in the shared folder with each document's place in its
   own partition's part of its source's queue.
2. Sums of these parts over partitions give every document its place in the whole queue.
3. Round-robin service: each round credits every queue that still has tokens with its
   target share of a window; whole tokens are served, and what is left of the credit is
   carried to the next round.  The rounds, one after the other, are cut into windows, so all of
   these are full but the last, and a window has each queue's service of one round.
4. A queue that runs out leaves its share to the rest: rounds are shorter then, and a window
   has more of them.

Credits are whole numbers of 1/2^SCALE of a token, so what a queue has been served after any number
of rounds is a product, and where a token stands a sum of such products over the queues: every task
computes the pieces of its own documents from the queues' lengths and credits alone, however
many sources there are and wherever its documents stand.  Credits thus carry over windows and
partitions without a sequential pass.  A source with a third of all rows is one queue, read by as
many tasks as its rows have.

Memory: the driver and each task hold two numbers a source; a task goes through the rounds that its
documents are served in, a bounded number of (round, source) cells at a time.

Defined cases: a null or empty text is just the end token; a null source is a queue of its
own, which targets name None; a target of a source that no document has is an error, and so are targets
below 0 or beyond 1 together; documents that repeat are packed each for itself, and so are those without id;
no documents give no pieces.  Columns beside the three that are named don't matter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .fst import byte_symbols
from .shared import kept

WINDOW = 4096
#: Credits are in parts of 2^SCALE of a token.
SCALE = 16
#: (round, source) cells, and tokens of documents, that a task goes through at once.
CELLS = TOKENS = 1 << 20
END_ID = 2


class Encoder:
    """Token ids of texts, by way of the ids of their white-space separated pieces.

    The tokenizer drops white space and never joins across it, so a text's ids are its pieces' ids.
    Pieces of ASCII and Latin-1 letters go straight to its BPE model; others to the whole tokenizer.
    At most MOST pieces are remembered, by their bytes; that bounds memory and changes no result."""

    MOST = 300_000
    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    #: Fixed: the tokenizer file's splitting pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: Fixed: how the tokenizer file splits a lower-cased piece, for the characters of _PLAIN.
    _SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)["pre_tokenizer"].get("pretokenizers", [])
        # of another file every piece goes to the whole tokenizer
        self.known = bool(parts) and parts[0].get("pattern") == {"Regex": self.PATTERN}
        self.tokenize = self.tokenizer.model.tokenize
        self.symbol = {b: c for c, b in byte_symbols().items()}
        self.wide = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.end_id = end_id
        self.reset()

    def reset(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.met = np.zeros(1 << 23, bool)
        self.start, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)  # slot 0: the end of a document
        self.flat = np.array([self.end_id], self.wide)
        self.split: dict[str, list[int]] = {}

    def _piece(self, raw: bytes) -> list[int]:
        text = raw.decode("utf-8")
        plain = text.isascii() and text.isprintable()  # stands for itself in the vocabulary, but for case
        if not self.known or "<|" in text or not (plain or self._PLAIN.fullmatch(text)):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        low, out = text.lower(), None
        for part in (low,) if plain and low.isalpha() else self._SPLIT.findall(low):
            got = self.split.get(part)
            if got is None:
                got = [t.id for t in self.tokenize(part if plain else "".join([self.symbol[b] for b in part.encode()]))]
                if len(part) < 8 and len(self.split) < 50_000:
                    self.split[part] = got
            out = got if out is None else out + got
        return out or []

    def _with(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and ids of the remembered pieces and of some more."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        more = np.fromiter(chain.from_iterable(ids), self.wide, int(size.sum()))
        return np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size)), np.concatenate((self.size, size)), np.concatenate((self.flat, more))

    def encode(self, texts: at.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the texts' bounds in them."""
        words = at.Words(texts, at.SPACED)
        where, back = at.distinct(words.folded, words.start, words.end, words.hash)
        if len(self.slot) + len(where) > self.MOST:
            self.reset()
        raw = texts.data.tobytes()
        pieces = [raw[s:e] for s, e in zip(words.start[where].tolist(), words.end[where].tolist(), strict=True)]
        known = self.slot.get
        own = np.array([known(x, -1) for x in pieces], np.int64)
        new = np.flatnonzero(own < 0)
        ids = [self._piece(pieces[i]) for i in new.tolist()]
        own[new] = len(self.start) + np.arange(len(new))
        start, size, flat = self._with(ids)
        # most pieces never come again: one is remembered the second time it is new
        bit = (words.hash[where[new]] % np.uint64(len(self.met))).astype(np.int64)
        again = np.flatnonzero(self.met[bit]).tolist()
        self.met[bit] = True
        if again:
            self.slot.update(zip((pieces[i] for i in new[again].tolist()), range(len(self.start), len(self.start) + len(again)), strict=True))
            self.start, self.size, self.flat = self._with([ids[i] for i in again])
        own = own[back]
        own = np.insert(own, words.bounds[1:], 0)
        size = size[own]
        upto = np.concatenate(([0], np.cumsum(size)))
        flat = flat[np.repeat(start[own] - upto[:-1], size) + np.arange(upto[-1])]
        bounds = upto[np.concatenate(([0], words.bounds[1:] + np.arange(1, texts.n + 1)))]
        return flat, bounds


_encoders: dict[str, Encoder] = {}


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(id, text, queue) -> (id, part, queue, before, n, ids)."""
    encoder = _encoders.setdefault(path, Encoder(path, end_id)) if path not in _encoders else _encoders[path]
    part = TaskContext.get().partitionId()
    before: dict[str, int] = {}
    for batch in batches:
        for rows, texts in at.slices(batch, "text"):
            flat, bounds = encoder.encode(texts)
            flat = flat.astype("<u4") if flat.dtype != np.uint16 else flat.astype("<u2")
            raw, width = flat.tobytes(), flat.dtype.itemsize
            n = np.diff(bounds)
            queues, at_queue = rows.column(2).to_pylist(), np.zeros(texts.n, np.int64)
            for i, q in enumerate(queues):
                at_queue[i] = before.get(q, 0)
                before[q] = int(at_queue[i] + n[i])
            ids = pa.Array.from_buffers(pa.large_binary(), texts.n, [None, pa.py_buffer((bounds * width).astype(np.int64).tobytes()), pa.py_buffer(raw)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(texts.n, part, np.int32)), rows.column(2), pa.array(at_queue), pa.array(n), ids], names=["id", "part", "queue", "before", "n", "ids"])


@dataclass
class Service:
    """The whole service of queues with so many tokens, by their credits a round."""

    tokens: np.ndarray
    credit: np.ndarray
    window: int

    @classmethod
    def of(cls, tokens: list[int], weights: list[float], window: int = WINDOW) -> Service:
        weight = np.maximum(np.array(weights, float), 1e-300)
        credit = np.ceil(weight / weight.sum() * window * (1 << SCALE)) if len(weight) else weight
        return cls(np.array(tokens, np.int64), np.maximum(1, credit).astype(np.int64), window)

    def __post_init__(self):
        # parts of a token that queues begin with, so that those of less than a token a round don't all get theirs in one
        self.phase = np.cumsum(self.credit) - self.credit & (1 << SCALE) - 1
        self.rounds = -((self.phase - (self.tokens << SCALE)) // self.credit)  # until each queue has run out

    def served(self, queue: np.ndarray | slice, rounds: np.ndarray) -> np.ndarray:
        """Tokens of queues that so many rounds have served."""
        return np.minimum(self.tokens[queue], np.minimum(rounds, self.rounds[queue]) * self.credit[queue] + self.phase[queue] >> SCALE)

    def round_of(self, queue: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The round, from 0, that serves a token of a queue."""
        return -((self.phase[queue] - ((token + 1) << SCALE)) // self.credit[queue]) - 1

    def begins(self, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """Where in all of the service a queue's part of a round begins."""
        out = np.empty(len(queue), np.int64)
        order = np.argsort(rounds, kind="stable")
        own, first = np.unique(rounds[order], return_index=True)
        bounds = np.append(first, len(order))
        step = max(1, CELLS // max(1, len(self.tokens)))
        for i in range(0, len(own), step):
            some = own[i : i + step, None]
            before, after = self.served(slice(None), some), self.served(slice(None), some + 1)
            # the queues before it have had this round, the others have not
            upto = np.cumsum(after - before, axis=1) - (after - before) + before.sum(1)[:, None]
            at_ = order[bounds[i] : bounds[min(i + step, len(own))]]
            out[at_] = upto[np.searchsorted(own[i : i + step], rounds[at_]), queue[at_]]
        return out

    def pieces(self, queue: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, length, window, offset) of documents, by their queues, places in them and sizes."""
        credit = self.credit[queue]
        first, last = self.round_of(queue, low), self.round_of(queue, low + size - 1)
        slow = credit < 1 << SCALE  # a queue of less than a token a round: each token has a round of its own
        count = np.where(slow, size, last - first + 1)
        row = np.repeat(np.arange(len(queue)), count)
        k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        q = queue[row]
        turn = np.where(slow[row], self.round_of(q, low[row] + k), first[row] + k)
        begin = self.served(q, turn)
        start = np.maximum(low[row], begin)
        end = np.append(start[1:], 0)
        end = np.where(np.append(row[1:] != row[:-1], True), (low + size)[row], end)
        at_ = self.begins(q, turn) + start - begin
        # services that follow each other without another queue's between are one
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (at_[1:] != at_[:-1] + end[:-1] - start[:-1])
        head = np.flatnonzero(new)
        row, start, at_, end = row[head], start[head], at_[head], end[np.append(head[1:] - 1, len(end) - 1)] if len(head) else end
        windows = (at_ + end - start - 1) // self.window - at_ // self.window + 1
        of = np.repeat(np.arange(len(row)), windows)
        window = at_[of] // self.window + np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.maximum(at_[of], window * self.window)
        length = np.minimum((at_ + end - start)[of], (window + 1) * self.window) - begin
        return row[of], (start - low[row])[of] + begin - at_[of], length, window, begin - window * self.window


_PIECES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _pieces(batches: Iterator[pa.RecordBatch], plan, wide: int, id_column: str) -> Iterator[pa.RecordBatch]:
    """(id, queue, at, n, ids) -> pieces."""
    names, service = plan.value
    for whole in batches:
        upto = np.cumsum(whole.column(3).to_numpy())
        at_row = 0
        while at_row < whole.num_rows:
            to = max(at_row + 1, int(np.searchsorted(upto, (upto[at_row - 1] if at_row else 0) + TOKENS, "right")))
            batch, at_row = whole.slice(at_row, to - at_row), to
            queue = np.array([names[q] for q in batch.column(1).to_pylist()], np.int64)
            size = batch.column(3).to_numpy()
            row, start, length, window, offset = service.pieces(queue, batch.column(2).to_numpy(), size)
            ids, crc, held, held_of = batch.column(4), np.zeros(len(row), np.int64), None, -1
            for i, (d, s, k) in enumerate(zip(row.tolist(), start.tolist(), length.tolist(), strict=True)):
                if d != held_of:
                    held, held_of = np.frombuffer(ids[d].as_buffer(), f"<u{wide}").astype("<u4"), d
                crc[i] = zlib.crc32(held[s : s + k])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *(pa.array(x) for x in (start, length, crc, size[row], window, offset))], names=[id_column, *_PIECES])


def _named(key: str | None) -> str:
    return "null" if key is None else f"s:{key}"


def _rest_share(target: float) -> float:
    """What targets leave to the sources that have none; where they leave nothing, so little that these follow at the end."""
    return 1 - target if target < 1 else 1e-6


def _weights(totals: list[tuple[str, int]], targets: dict[str | None, float] | None) -> list[float]:
    """Shares of the queues: those with a target have it, the rest share what is left in proportion to their tokens."""
    wanted = {_named(k): float(v) for k, v in (targets or {}).items()}
    there = {q for q, _ in totals}
    if there and (unknown := [k for k in targets or {} if _named(k) not in there]):
        raise ValueError(f"no document has the source {', '.join(map(repr, unknown))}")
    if min(wanted.values(), default=0) < 0 or sum(wanted.values()) > 1 + 1e-9:
        raise ValueError(f"targets {targets} are not shares")
    others = sum(n for q, n in totals if q not in wanted)
    rest = _rest_share(sum(wanted[q] for q, _ in totals if q in wanted))
    return [wanted[q] if q in wanted else (n * rest / others if wanted else float(n)) for q, n in totals]


def pack(docs: DataFrame, path: str, *, targets: dict[str | None, float] | None = None, window: int = WINDOW, end_id: int = END_ID, text: str = "text", id_column: str = "doc_id", source: str = "source") -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    targets: the share of each source (None names the null source; others share what is left in
    proportion to what they bring); by default every window has the whole input's mixture."""
    spark = docs.sparkSession
    name: Column = F.coalesce(F.concat(F.lit("s:"), F.col(source).cast("string")), F.lit("null"))
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("id", id_type)]).add("part", "integer").add("queue", "string").add("before", "long").add("n", "long").add("ids", "binary")
    encoded = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), name.alias("queue")).mapInArrow(lambda it: _encode(it, path, end_id), schema)
    encoded = kept(encoded, "tokens")
    parts = encoded.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = kept(parts.select("queue", "part", "n", earlier.alias("base")), "parts")
    wide = 2 if _vocabulary(path) <= 1 << 16 else 4
    out = T.StructType([T.StructField(id_column, id_type)])
    for c in _PIECES:
        out = out.add(c, "long")
    totals = sorted((r["queue"], r["n"]) for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).collect())  # a row a source
    names = {q: i for i, (q, _) in enumerate(totals)}
    plan = spark.sparkContext.broadcast((names, Service.of([n for _, n in totals], _weights(totals, targets), window)))
    placed = encoded.join(parts.select("queue", "part", "base"), ["queue", "part"]).select("id", "queue", (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    return placed.mapInArrow(lambda it: _pieces(it, plan, wide, id_column), out)


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
