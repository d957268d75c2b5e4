"""What the trained operators share: folds, bounded labelled samples, and an optimiser in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept

#: Rows of each label that a classifier is fitted on, at most about; chosen by a hash of the id over all labelled rows.
PER_LABEL = 4000


def fold(id_column: str, modulus: int) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether the row's label must not be learned from; false for a null id, which no label has."""
    return F.coalesce(fold(id_column, modulus) == remainder, F.lit(False)).alias("held_out")


def chosen(rows: DataFrame, label: str, id_column: str, per_label: Column | int) -> DataFrame:
    """About per_label rows of each label, with how many rows one stands for.  A row a label is what is broadcast.

    per_label may name ``labels``, the number of labels there are."""
    counts = rows.groupBy(label).agg(F.count("*").alias("__rows"))
    counts = counts.crossJoin(F.broadcast(counts.agg(F.count("*").alias("labels")))).select(F.col(label).alias("__label"), "__rows", "labels")  # one row on the right
    wanted = F.greatest(F.lit(1.0), F.col("__rows") / per_label)
    some = rows.join(F.broadcast(counts), F.col(label) == F.col("__label")).withColumn("weight", wanted)
    place = F.pmod(F.xxhash64(F.lit("sample"), id_column), F.lit(1 << 30))
    return some.where(place < F.lit(1 << 30) / F.col("weight")).drop("__label", "__rows", "labels")


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, per_label: int, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(text, label, weight) of a bounded sample of the rows that may be learned from, kept as a table.

    The sample's ids, two labels of about per_label rows each, are what is broadcast."""
    rows = labels.select(id_column, F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (fold(id_column, modulus) != remainder))
    some = chosen(rows, "label", id_column, F.lit(per_label))
    return kept(docs.select(id_column, F.col(text).alias("text")).join(F.broadcast(some), id_column).select("text", "label", "weight"), "sample")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def adam(parameters: list[np.ndarray], gradients: Callable[[np.ndarray], list[np.ndarray]], n: int, *, epochs: int, batch: int, rate: float, seed: int = 7) -> None:
    """Changes the parameters in place; gradients(rows) are those of a batch."""
    rng = np.random.default_rng(seed)
    first, second, t = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        step = rate * (1 - epoch / epochs)
        for i in range(0, n, batch):
            t += 1
            for p, m, v, g in zip(parameters, first, second, gradients(order[i : i + batch]), strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def temperature(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of binary logits that makes held-back labels likeliest."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [float((weight * np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t)).sum()) for t in grid]
    return float(grid[int(np.argmin(loss))]) if len(y) else 1.0
