"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

Subwords are the 3- and 4-byte pieces of lower-cased words, word boundaries included,
hashed to BUCKETS rows of an embedding table.  A text is the average of its subwords'
embeddings; a linear softmax over languages follows.  Table and softmax are trained
together by stochastic gradient descent; on rows held back from that, a temperature
calibrates probabilities and a threshold for rejection is set, so that a share TRUSTED of
what is not rejected is right.  Scoring reads whole texts row by row.

Fitted on a bounded sample of every value: about SAMPLE rows in all, PER_LANGUAGE of each at
most and LEAST at least, so that no value is left out.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected;
without any labelled row every prediction is `und`; rows that repeat are judged alike; a null
id is never learned from and not held out; columns beside text, lang and id, whatever their names, don't
matter; very long texts are read whole; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .learn import chosen, fold, held_out

BUCKETS = 4096
WIDTH = 16
PER_LANGUAGE = 800
SAMPLE = 40_000
LEAST = 10
TRUSTED = 0.99
EPOCHS = 40
#: Rows counted at once: bounds the count matrix.
ROWS = 256

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[: ord("A")] = 0
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("Z") + 1 : ord("a")] = 0
_FOLD[ord("z") + 1 : 128] = 0


def subwords(texts: at.Texts) -> np.ndarray:
    """Counts of each text's subwords by bucket, as shares of their number."""
    n = len(texts.data)
    # a zero after each text keeps texts apart and closes words; one before the first opens it
    size = np.diff(texts.offsets)
    owner = np.repeat(np.arange(texts.n), size + 1)
    folded = np.zeros(n + texts.n + 4, np.uint8)
    folded[1 + np.arange(n) + np.repeat(np.arange(texts.n), size)] = _FOLD[texts.data]
    b = folded.astype(np.uint32)
    out = np.zeros(texts.n * BUCKETS)
    m = n + texts.n
    for width in (3, 4):
        value, inside = b[:m].copy(), folded[1 : 1 + m] != 0
        for k in range(1, width):
            value |= b[k : k + m] << np.uint32(8 * k)
            if k + 1 < width:
                inside = inside & (folded[k : k + m] != 0)
        at_ = np.flatnonzero(inside)
        bucket = (value[at_] * np.uint32(0x9E3779B1 if width == 3 else 0x85EBCA6B)) >> np.uint32(20)
        out += np.bincount(owner[at_] * BUCKETS + bucket, minlength=texts.n * BUCKETS)
    out = out.reshape(texts.n, BUCKETS)
    return out / np.maximum(1, out.sum(1, keepdims=True))


def has_letter(texts: at.Texts) -> np.ndarray:
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    out = texts.per_text(ascii_letter[texts.data]) > 0
    for i in np.flatnonzero(~out & (np.diff(texts.offsets) > 0)):
        out[i] = any(c.isalpha() for c in texts.text(int(i)))
    return out


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, softmax: np.ndarray, bias: np.ndarray):
        self.languages, self.table, self.softmax, self.bias = languages, table, softmax, bias
        self.heat, self.least = 1.0, 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.table) @ self.softmax + self.bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x) / self.heat)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


class Rows:
    """Shares of subwords, row by row: what is there, and dense for a few rows at a time."""

    def __init__(self, at_: list[bytes], share: list[bytes]):
        self.start = np.concatenate(([0], np.cumsum([len(x) // 2 for x in at_]))).astype(np.int64)
        self.at, self.share = np.frombuffer(b"".join(at_), "<u2"), np.frombuffer(b"".join(share), "<f4")

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows.tolist()):
            own = slice(self.start[r], self.start[r + 1])
            out[i, self.at[own]] = self.share[own]
        return out


def train(x: Rows, y: np.ndarray, languages: list[str], *, seed: int = 5, epochs: int = EPOCHS, rate: float = 30.0) -> Model:
    """SGD over all but every fifth row; these calibrate."""
    rng = np.random.default_rng(seed)
    model = Model(languages, rng.normal(0, 0.5, (BUCKETS, WIDTH)), np.zeros((WIDTH, len(languages))), np.zeros(len(languages)))
    order = rng.permutation(len(y))
    back, own = order[::5], np.delete(order, np.s_[::5])
    if not len(own):
        own = order
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(own), max(1, len(own) // 32)):
            xs = x[rows]
            hidden = xs @ model.table
            error = softmax(hidden @ model.softmax + model.bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            into = error @ model.softmax.T
            model.softmax -= step * 0.1 * (hidden.T @ error)
            model.bias -= step * 0.01 * error.sum(0)
            model.table -= step * (xs.T @ into)
    if len(back):
        z = np.concatenate([model.logits(x[part]) for part in np.array_split(back, -(-len(back) // ROWS))])
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 50))
        loss = [-np.log(softmax(z / t)[np.arange(len(back)), y[back]] + 1e-12).mean() for t in grid]
        model.heat = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.heat)
        top, right = p.max(1), p.argmax(1) == y[back]
        order = np.argsort(-top, kind="stable")
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= TRUSTED)
        model.least = float(top[order[good[-1]]]) if len(good) else 1.0
    return model


def _groups(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, at.Texts]]:
    for first in range(0, batch.num_rows, ROWS):
        yield from at.slices(batch.slice(first, ROWS), text)


def fit(docs: DataFrame, *, modulus: int = 5, remainder: int = 0, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, text: str = "text", lang: str = "lang", id_column: str = "doc_id") -> Model | None:
    rows = docs.select(id_column, F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(id_column, modulus) != remainder))
    some = chosen(rows, "lang", id_column, F.greatest(F.lit(LEAST), F.least(F.lit(per_language), F.lit(sample) / F.col("labels"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _groups(batch, "text"):
                x = subwords(texts)
                held = [(np.flatnonzero(r).astype("<u2"), r[r > 0].astype("<f4")) for r in x]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([i.tobytes() for i, _ in held], pa.binary()), pa.array([v.tobytes() for _, v in held], pa.binary())], names=["lang", "at", "share"])

    got = some.select("text", "lang").mapInArrow(run, "lang string, at binary, share binary").toPandas()  # the bounded sample
    if not len(got):
        return None
    got = got.sort_values(["lang", "share", "at"], kind="stable", ignore_index=True)  # the same order whatever the partitions
    names = sorted(got["lang"].unique())
    return train(Rows(got["at"].tolist(), got["share"].tolist()), got["lang"].map({k: i for i, k in enumerate(names)}).to_numpy(), names)


def predict(docs: DataFrame, model: Model | None, *, modulus: int = 5, remainder: int = 0, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, held_out, lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for rows, texts in _groups(batch, text):
                known = has_letter(texts) & (own is not None)
                p = own.probabilities(subwords(texts)) if own is not None else np.zeros((texts.n, 1))
                top = np.where(known, p.max(1), 0.0)
                names = [own.languages[k] if ok else "und" for k, ok in zip(p.argmax(1), known, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names, pa.string()), pa.array(top), pa.array(top < own.least if own is not None else ~known)], names=[id_column, "lang_pred", "score", "rejected"])

    schema = T.StructType([docs.schema[id_column]]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.select(id_column, text).mapInArrow(run, schema).select(id_column, held_out(id_column, modulus, remainder), "lang_pred", "score", "rejected")
