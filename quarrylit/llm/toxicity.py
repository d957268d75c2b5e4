"""Toxicity: a factorization machine over hashed terms.

Terms are the text's lower-cased words and the words' beginnings of 4 to 6 bytes, hashed into
2^ROW_BITS rows.  The machine's terms are those of the sample that tell something: by themselves
(a chi-square beyond what chance gives the best of so many terms), or in a pair whose share of
label 1 is not what its two terms add up to, however rare they are and however little each
says alone: pairs are looked for among all terms that enough documents of label 1 have for any pair of
theirs to get beyond chance.  A task looks for the partners of some terms, in the documents that
have them; no table of all pairs is made.  The machine learns a weight for each term
and, through factors, one for each pair of them, so that two terms can mean together what neither
does alone.  Scoring reads whole texts row by row; the model is a table of at most TERMS rows,
the most telling ones.

Fitted on a bounded sample of labelled rows (SAMPLE of each label).  Terms are counted by
Spark; the driver and the tasks get the sample's rows as numbers of terms that may tell something.

Defined cases: a null or empty text has no terms and gets the base rate's score; without
labels of both kinds every score is the share of label 1 (0.5 without any label); rows that
repeat are scored alike; a null id is never learned from and not held out; columns beside the
text and id don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .learn import adam, held_out, labelled, sigmoid
from .shared import kept

TERMS = 4096
FACTORS = 8
#: Rows of each label to fit on.
SAMPLE = 4000
#: A term of fewer documents of the sample tells nothing that lasts.
LEAST_DOCUMENTS = 2
PREFIXES = (4, 5, 6)
#: A chi-square counts that is over CHANCE times the logarithm of how many there are.
CHANCE = 2.0
#: The share of either label that two terms add up to is taken to be this part of that label's base rate at least.
LEAST_SHARE = 0.5
#: Terms are hashed into so many rows.
ROW_BITS = 22
#: So many of the best terms are taken in any case: a small sample has none beyond chance.
BEST = 32
#: Decay of weights and of factors, and passes over the sample.
W_DECAY, V_DECAY, EPOCHS = 1e-4, 2e-2, 30


def terms(texts: at.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, row of the term) of every distinct pair, by text."""
    words = at.Words(texts, at.ALNUM_LOWER)
    eight = at._eights(words.folded)
    owner, term = [words.owner], [words.hash]
    size = words.end - words.start
    for k in PREFIXES:
        long = size >= k
        owner.append(words.owner[long])
        term.append(at.mix(eight[words.start[long]] & at._MASK[k] ^ np.uint64(0xA0761D6478BD642F + (k << 56))))
    owner, term = np.concatenate(owner), (np.concatenate(term) >> np.uint64(64 - ROW_BITS)).astype(np.uint32)
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    return owner[new], term[new]


class Machine:
    """Known terms (sorted), their weights w and factors v, and the bias."""

    def __init__(self, known: np.ndarray, w: np.ndarray, v: np.ndarray, bias: float):
        self.known, self.w, self.v, self.bias = known, w, v, bias

    def index(self, term: np.ndarray) -> np.ndarray:
        """The row of each term, -1 if it isn't known."""
        if not len(self.known):
            return np.full(len(term), -1)
        i = np.minimum(np.searchsorted(self.known, term), len(self.known) - 1)
        return np.where(self.known[i] == term, i, -1)

    def logits(self, owner: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias) + np.bincount(owner, self.w[row], n)
        for f in self.v.T:
            s = np.bincount(owner, f[row], n)
            out += (s * s - np.bincount(owner, f[row] ** 2, n)) / 2
        return out

    def score(self, texts: at.Texts) -> np.ndarray:
        owner, term = terms(texts)
        row = self.index(term)
        return sigmoid(self.logits(owner[row >= 0], row[row >= 0], texts.n))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label, weight) -> (term, documents, those of label 1), added up in the task's slices."""
    for batch in batches:
        for rows, texts in at.slices(batch):
            owner, term = terms(texts)
            y = rows.column(1).to_numpy()[owner]
            known, back, df = np.unique(term, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(known.astype(np.int64)), pa.array(df, pa.int64()), pa.array(np.bincount(back, y, len(known)).astype(np.int64))], names=["term", "df", "positive"])


def candidate_terms(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """In order, terms that the machine may know, and whether each tells something by itself."""
    none = np.zeros(0, np.uint32), np.zeros(0, bool)
    n, p = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < p < n:
        return none
    counts = rows.mapInArrow(_count_terms, "term long, df long, positive long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("positive").alias("positive"))
    expected = F.col("df") * F.lit(p / n)
    chi = F.pow(F.col("positive") - expected, 2) / F.greatest(expected * F.lit(1 - p / n) * (1 - F.col("df") / F.lit(n + 1)), F.lit(1e-9))
    counts = kept(counts.where(F.col("df") >= LEAST_DOCUMENTS).select("term", "positive", chi.alias("chi")), "terms")
    total, positive = counts.agg(F.count("*"), F.count_if(F.col("positive") >= LEAST_DOCUMENTS)).first()
    best = counts.orderBy(F.desc("chi"), "term")
    telling = best.where(F.col("chi") > float(CHANCE * np.log(max(2, total)))).limit(most).union(best.limit(BEST)).select("term", F.lit(True).alias("telling"))
    share = max(0.02, LEAST_SHARE * p / n)
    least = max(LEAST_DOCUMENTS, int(np.ceil(chance_of_pairs(positive) * share / (1 - share))))
    paired = counts.where(F.col("positive") >= least).select("term", F.lit(False).alias("telling"))
    # terms of so many documents of the bounded sample
    got = telling.union(paired).groupBy("term").agg(F.max("telling").alias("telling")).toPandas()
    term = got["term"].to_numpy(np.uint32)
    order = np.argsort(term)
    return term[order], got["telling"].to_numpy(bool)[order]


def chance_of_pairs(terms: int) -> float:
    """What the best chi-square of so many terms' pairs may be by chance."""
    return CHANCE * float(np.log(max(2.0, terms**2 / 2)))


class Postings:
    """The sample as terms of each row and rows of each term."""

    def __init__(self, y: np.ndarray, per_row: list[np.ndarray], n: int):
        self.y, self.n = y, n
        self.start = np.concatenate(([0], np.cumsum([len(x) for x in per_row]))).astype(np.int64)
        self.term = np.concatenate(per_row).astype(np.int32) if per_row else np.zeros(0, np.int32)
        owner = np.repeat(np.arange(len(per_row), dtype=np.int32), np.diff(self.start))
        order = np.argsort(self.term, kind="stable")
        self.row = owner[order]
        self.bounds = np.searchsorted(self.term[order], np.arange(n + 1))
        self.df = np.diff(self.bounds)
        self.share = (np.bincount(self.term, y[owner], n) + y.mean()) / (self.df + 1) if len(y) else np.zeros(n)

    def best(self, t: int) -> float:
        """The largest chi-square of a pair of the term with any other, by documents of label 1 against what both add up to."""
        docs = self.row[self.bounds[t] : self.bounds[t + 1]]
        size = self.start[docs + 1] - self.start[docs]
        at_ = np.repeat(self.start[docs] - np.cumsum(size) + size, size) + np.arange(size.sum())
        other = self.term[at_]
        both = np.bincount(other, minlength=self.n)
        bad = np.bincount(other, np.repeat(self.y[docs], size), self.n)
        met = np.flatnonzero(both >= LEAST_DOCUMENTS)
        met = met[met != t]
        if not len(met):
            return 0.0
        base, both, bad = self.y.mean(), both[met], bad[met]
        added = self.share[t] + self.share[met] - base

        def beyond(low: float, high: float, sign: int) -> np.ndarray:
            share = np.clip(added, low, high)
            return np.maximum(0, sign * (bad - both * share)) ** 2 / (both * share * (1 - share))

        # what is expected is drawn to the base rate on the side where few documents would do
        more = beyond(max(0.02, LEAST_SHARE * base), 0.98, 1)
        less = beyond(0.02, min(0.98, 1 - LEAST_SHARE * (1 - base)), -1)
        return float(np.maximum(more, less).max())


def in_pairs(spark: SparkSession, y: np.ndarray, per_row: list[np.ndarray], n: int) -> np.ndarray:
    """Of n terms, the best chi-square of each in a pair; 0 where it isn't beyond chance."""
    shared = spark.sparkContext.broadcast(Postings(y, per_row, n))
    least = chance_of_pairs(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([shared.value.best(t) for t in ids.tolist()], pa.float64())], names=["id", "chi"])

    out = np.zeros(n)
    parts = max(1, min(n, 4 * spark.sparkContext.defaultParallelism))
    for r in spark.range(0, n, 1, parts).mapInArrow(run, "id long, chi double").where(F.col("chi") > least).collect():  # numbers of the bounded sample's terms
        out[r.id] = r.chi
    return out


def fit_rows(y: np.ndarray, per_row: list[np.ndarray], weight: np.ndarray, known: np.ndarray, keep: np.ndarray, *, factors: int = FACTORS, seed: int = 11) -> Machine:
    """The machine of the terms to keep, of rows with labels y, weights, and the numbers of the known terms that each has."""
    prior = float(np.average(y, weights=weight)) if len(y) else 0.5
    bias = float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
    if not len(known) or not len(y) or y.min() == y.max():
        return Machine(np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, factors)), bias)
    place = np.where(keep, np.cumsum(keep) - 1, -1)
    known, per_row = known[keep], [own[own >= 0] for own in (place[x] for x in per_row)]
    if not len(known):
        return Machine(np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, factors)), bias)
    machine = Machine(known, np.zeros(len(known)), np.random.default_rng(seed).normal(0, 0.01, (len(known), factors)), bias)
    row = np.concatenate(per_row).astype(np.int64)
    start = np.concatenate(([0], np.cumsum([len(x) for x in per_row])))
    constant = np.array([bias])
    weight = weight / weight.mean()

    def gradients(rows: np.ndarray) -> list[np.ndarray]:
        size = start[rows + 1] - start[rows]
        own = np.repeat(np.arange(len(rows)), size)
        r = row[np.repeat(start[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        machine.bias = float(constant[0])
        error = (sigmoid(machine.logits(own, r, len(rows))) - y[rows]) * weight[rows] / len(rows)
        gw = np.bincount(r, error[own], len(machine.w)) + W_DECAY * machine.w
        gv = np.empty_like(machine.v)
        for k, f in enumerate(machine.v.T):
            s = np.bincount(own, f[r], len(rows))
            gv[:, k] = np.bincount(r, error[own] * (s[own] - f[r]), len(machine.w)) + V_DECAY * f
        return [gw, gv, np.array([error.sum()])]

    adam([machine.w, machine.v, constant], gradients, len(y), epochs=EPOCHS, batch=64, rate=0.05)
    machine.bias = float(constant[0])
    return machine


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", modulus: int = 3, remainder: int = 1, per_label: int = SAMPLE, most: int = TERMS, text: str = "text", id_column: str = "doc_id") -> Machine:
    rows = labelled(docs, labels, label, modulus, remainder, per_label, text, id_column)
    known, telling = candidate_terms(rows, most)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in at.slices(batch):
                owner, term = terms(texts)
                i = np.minimum(np.searchsorted(shared.value, term), max(0, len(shared.value) - 1))
                there = shared.value[i] == term if len(shared.value) else np.zeros(len(term), bool)
                owner, i = owner[there], i[there].astype("<u4")
                bounds = np.searchsorted(owner, np.arange(texts.n + 1))
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([i[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["label", "weight", "terms"])

    got = rows.mapInArrow(run, "label int, weight double, terms binary").toPandas()  # the bounded sample, 4 bytes a term of a row
    got = got.sort_values(["label", "terms"], kind="stable")
    y, per_row = got["label"].to_numpy(float), [np.frombuffer(x, "<u4") for x in got["terms"]]
    rank = in_pairs(docs.sparkSession, y, per_row, len(known)) if len(known) else np.zeros(0)
    keep = telling | (rank > 0)
    if keep.sum() > most:
        rank[telling] = np.inf
        keep[np.argsort(-rank, kind="stable")[most:]] = False
    return fit_rows(y, per_row, got["weight"].to_numpy(float), known, keep)


def score(docs: DataFrame, model: Machine, *, threshold: float = 0.7, modulus: int = 3, remainder: int = 1, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per document: its id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in at.slices(batch, text):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(texts))], names=[id_column, "score"])

    out = docs.select(id_column, text).mapInArrow(run, T.StructType([docs.schema[id_column]]).add("score", "double"))
    return out.select(id_column, held_out(id_column, modulus, remainder), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
