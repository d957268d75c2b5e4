"""Quality: random-indexing word vectors pooled per document, and a two-layer network.

Each white-space separated piece of a text is two words: its folded letters, and its shape
(case, symbols at its end, length, whether it repeats the piece before).  Words hash to
rows.  Every word has a fixed sparse random index vector; a word's vector is the sum of
the index vectors around it over all documents (a pass over the whole corpus whose partial
sums, one matrix a task, are added up FAN_IN at a time), scaled by its count, next to its own
index vector.  A document is the mean of its words' vectors and of their squares, with its
length.  A network of two layers follows, trained in numpy; rows held back from that set
a temperature for its probabilities.

The word vectors cover all documents; the network is fitted on a bounded sample of
labelled rows (PER_LABEL of each label, in learn.py).

Defined cases: a null or empty text is the zero vector; without labels of both kinds every
score is the share of label 1 (0.5 without any label); rows that repeat are scored alike; a null
id is never learned from and not held out; columns beside the text and id, whatever their names, aren't
read; very long texts are scored whole; an empty table has no rows.  Rows of words are told by hashes that
words may share, as the table of vectors is of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .learn import PER_LABEL, adam, held_out, labelled, sigmoid, temperature

ROWS = 8192
WIDTH = 32
NONZERO = 4
REACH = 2
BLOCKS = 16
#: Matrices that one task adds up.
FAN_IN = 256
HIDDEN = 32

#: Codes of bytes and powers for sums over the letters of a piece; rows are so few that words share them anyway.
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**k modulo 2**64 for k below n."""
    if len(_powers.get(base, ())) < n:
        out = np.full(max(n, at.SLICE_BYTES + 4096), base, np.uint64)
        out[0] = 1
        out = np.multiply.accumulate(out)
        if n > 4 * at.SLICE_BYTES:
            return out
        _powers[base] = out
    return _powers[base][:n]


_rng = np.random.default_rng(31)
_PLACE = np.argsort(_rng.random((ROWS, WIDTH)), 1)[:, :NONZERO]
_SIGN = _rng.choice((-1, 1), (ROWS, NONZERO))


def index_vectors() -> np.ndarray:
    out = np.zeros((ROWS, WIDTH))
    np.put_along_axis(out, _PLACE, _SIGN, 1)
    return out


_UPPER, _LOWER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_LOWER[128:] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


def words_of(texts: at.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters' row, shape's row, owner, bounds) of each piece; shapes have the first 2048 rows."""
    pieces = at.Words(texts, at.SPACED)
    count = lambda mask: np.add.reduceat(np.append(mask[texts.data], False).astype(np.int32), np.stack((pieces.start, pieces.end), 1).ravel())[::2] if len(pieces) else np.zeros(0, np.int32)
    size = pieces.end - pieces.start
    upper, lower, digit, mark = (count(m) for m in (_UPPER, _LOWER, _DIGIT, _MARK))
    last = texts.data[pieces.end - 1] if len(pieces) else np.zeros(0, np.uint8)
    again = np.zeros(len(pieces), bool)
    again[1:] = (pieces.hash[1:] == pieces.hash[:-1]) & (pieces.owner[1:] == pieces.owner[:-1])
    case = np.where(upper + lower == 0, 0, np.where((upper > 1) & (upper * 2 > upper + lower), 1, np.where(upper > 0, 2, 3)))
    shape = (case * 4 + np.minimum(mark, 3)) * 4 + np.minimum(digit, 3)
    shape = (shape * 8 + np.minimum(np.log2(size + 1).astype(np.int64), 7)) * 2 + again
    shape = at.mix(shape.astype(np.uint64) * np.uint64(128) + np.where(_MARK[last], last, 0).astype(np.uint64)) % np.uint64(2048)
    folded = np.where(_UPPER | _LOWER, np.where(_UPPER, np.arange(256) + 32, np.arange(256)), 0).astype(np.uint8)
    n = len(texts.data)
    codes = np.where(folded[texts.data] > 0, _BYTE_CODE[folded[texts.data]] * powers(n, _BASE), np.uint64(0))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes, out=total[1:])
    core = at.mix((total[pieces.end] - total[pieces.start]) * powers(n + 1, pow(_BASE, -1, 1 << 64))[pieces.start])
    return (2048 + core % np.uint64(ROWS - 2048)).astype(np.int64), shape.astype(np.int64), pieces.owner, pieces.bounds


def contexts(texts: at.Texts, out: np.ndarray, seen: np.ndarray) -> None:
    """Adds to out[word] the index vectors of the words up to REACH pieces away, and to seen[word] its count."""
    core, shape, owner, _ = words_of(texts)
    flat = out.reshape(-1)
    for word in (core, shape):
        seen += np.bincount(word, minlength=ROWS)
    for gap in range(1, REACH + 1):
        same = owner[gap:] == owner[:-gap]
        for word in (core, shape):
            for near in (core, shape):
                for here, there in ((word[gap:][same], near[:-gap][same]), (word[:-gap][same], near[gap:][same])):
                    for k in range(NONZERO):
                        flat += np.bincount(here * WIDTH + _PLACE[there, k], _SIGN[there, k], ROWS * WIDTH)


def _sum_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, seen = np.zeros((ROWS, WIDTH)), np.zeros(ROWS, np.int64)
    for batch in batches:
        for _, texts in at.slices(batch):
            contexts(texts, out, seen)
    own = np.concatenate((out, seen[:, None]), 1)
    if seen.any():
        blocks = np.split(own, BLOCKS)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(BLOCKS, TaskContext.get().partitionId())), pa.array(np.arange(BLOCKS)), pa.array([b.astype("<f8").tobytes() for b in blocks], pa.binary())], names=["part", "block", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (part, block) -> one a (part, block): added up one by one, a block of a matrix at a time."""
    now, total = None, None
    made = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([total.tobytes()], pa.binary())], names=["part", "block", "sums"])
    for batch in batches:
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            own = np.frombuffer(batch.column(2)[i].as_buffer(), "<f8")
            if key != now and now is not None:
                yield made()
            now, total = key, own.copy() if key != now else total + own
    if now is not None:
        yield made()


def word_vectors(docs: DataFrame, *, text: str = "text") -> np.ndarray:
    """ROWS vectors of 2 * WIDTH: the mean surroundings of a word over all documents, and its own index vector."""
    schema = "part long, block long, sums binary"
    sums = docs.select(F.col(text).alias("text")).mapInArrow(_sum_matrices, schema)
    parts = max(1, docs.rdd.getNumPartitions())
    while True:  # FAN_IN matrices at most are one task's, whatever the number of tasks
        parts = -(-parts // FAN_IN)
        near = sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).repartition("part", "block").sortWithinPartitions("part", "block")
        sums = near.mapInArrow(_add, schema)
        if parts == 1:
            break
    got = sorted((r["block"], r["sums"]) for r in sums.collect())  # BLOCKS rows, one matrix in all
    out = np.zeros((ROWS, WIDTH + 1))
    for block, raw in got:
        out[block * ROWS // BLOCKS : (block + 1) * ROWS // BLOCKS] = np.frombuffer(raw, "<f8").reshape(-1, WIDTH + 1)
    near = out[:, :WIDTH] / np.maximum(1, out[:, WIDTH:])
    near /= np.maximum(1e-9, np.linalg.norm(near, axis=1, keepdims=True))
    return np.concatenate((near, index_vectors() / np.sqrt(NONZERO)), 1).astype(np.float32)


def _summed(owner: np.ndarray, row: np.ndarray, n: int, tables: list[np.ndarray]) -> list[np.ndarray]:
    """Of n texts the sums of their words' rows in each table; a row that a text has several times is taken once, times its count."""
    key, count = np.unique(owner * ROWS + row, return_counts=True)
    own, row = key // ROWS, key % ROWS
    out = [np.zeros((n, t.shape[1])) for t in tables]
    start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else own
    for total, table in zip(out, tables, strict=True):
        if len(own):
            total[own[start]] = np.add.reduceat(table[row] * count[:, None].astype(float), start)
    return out


def pool(texts: at.Texts, vectors: np.ndarray) -> np.ndarray:
    """Per text: the mean of its words' vectors, of their squares, and its length's logarithm."""
    core, shape, owner, bounds = words_of(texts)
    size = np.maximum(1, np.diff(bounds))[:, None]
    out = np.zeros((texts.n, 6 * WIDTH + 1))
    out[:, : 2 * WIDTH] = _summed(owner, core, texts.n, [vectors])[0]
    out[:, 2 * WIDTH : 4 * WIDTH], out[:, 4 * WIDTH : 6 * WIDTH] = _summed(owner, shape, texts.n, [vectors, vectors * vectors])
    out[:, :-1] /= size
    out[:, -1] = np.log1p(np.diff(bounds)) / 10
    return out


class Network:
    def __init__(self, vectors: np.ndarray, bias: float, inputs: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.vectors, self.heat = vectors, 1.0
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.w1, self.b1 = rng.normal(0, 1 / np.sqrt(inputs), (inputs, HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = np.zeros(HIDDEN), np.array([bias])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def score(self, texts: at.Texts) -> np.ndarray:
        return sigmoid(self.logits(pool(texts, self.vectors)) / self.heat)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, vectors: np.ndarray, *, epochs: int = 60) -> Network:
    prior = float(np.average(y, weights=weight)) if len(y) else 0.5
    net = Network(vectors, float(np.log((prior + 1e-3) / (1 - prior + 1e-3))), x.shape[1])
    if not len(y) or y.min() == y.max():
        return net
    weight = weight / weight.mean()
    order = np.random.default_rng(9).permutation(len(y))
    back, own = order[::5], np.delete(order, np.s_[::5])
    net.mean, net.scale = x[own].mean(0), x[own].std(0) + 1e-3
    z = (x - net.mean) / net.scale

    def gradients(rows: np.ndarray) -> list[np.ndarray]:
        rows = own[rows]
        hidden = np.tanh(z[rows] @ net.w1 + net.b1)
        error = (sigmoid(hidden @ net.w2 + net.b2[0]) - y[rows]) * weight[rows] / len(rows)
        into = error[:, None] * net.w2 * (1 - hidden**2)
        return [z[rows].T @ into + 1e-3 * net.w1, into.sum(0), hidden.T @ error + 1e-4 * net.w2, np.array([error.sum()])]

    adam([net.w1, net.b1, net.w2, net.b2], gradients, len(own), epochs=epochs, batch=64, rate=0.005)
    net.heat = temperature(net.logits(x[back]), y[back], weight[back])
    return net


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", modulus: int = 5, remainder: int = 0, per_label: int = PER_LABEL, text: str = "text", id_column: str = "doc_id") -> Network:
    vectors = word_vectors(docs, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = labelled(docs, labels, label, modulus, remainder, per_label, text, id_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in at.slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([r.tobytes() for r in pool(texts, shared.value)], pa.binary())], names=["label", "weight", "x"])

    got = rows.mapInArrow(run, "label int, weight double, x binary").toPandas().sort_values(["label", "x"], kind="stable")  # the bounded sample, one vector a row
    y = got["label"].to_numpy(float)
    x = np.array([np.frombuffer(r, float) for r in got["x"]]).reshape(len(y), -1) if len(y) else np.zeros((0, 6 * WIDTH + 1))
    return train(x, y, got["weight"].to_numpy(float), vectors)


def score(docs: DataFrame, net: Network, *, threshold: float = 0.3, modulus: int = 5, remainder: int = 0, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, text):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(texts))], names=[id_column, "score"])

    out = docs.select(id_column, text).mapInArrow(run, T.StructType([docs.schema[id_column]]).add("score", "double"))
    return out.select(id_column, held_out(id_column, modulus, remainder), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
