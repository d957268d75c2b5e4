"""From raw documents to packed training sequences: quality rules, near duplicates, benchmark
decontamination, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs.  All but the last return the columns of documents.

Defined cases: each stage takes what its operator's module states.  In short: a null text is empty, which the
quality rules reject for having too few words; ties and repeated rows are judged alike, of near duplicates the
row of the smallest id stays; columns of documents pass through whatever their names; of an empty table
every stage makes an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylit.llm import decontaminate, jaccard, packing, repetition, secrets
from quarrylit.llm.queries import tokenizer
from quarrylit.llm.shared import documents, kept

#: Near duplicates here are of five-word shingles and a similarity of 0.8 or more.
NEAR = jaccard.Rule(width=5, share=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the repetition rules reject."""
    return repetition.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return jaccard.one_of_each(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which a twentieth of the words or more are inside benchmark windows."""
    return decontaminate.remove(docs, documents(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text."""
    out = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", n).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, in the mixture of the sources that are left."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret redaction", redaction),
    ("packing", pack),
]

#: Suffix arrays, components and tokenizers are beyond SQL: tests hold the run against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = kept(docs, f"stage{i}")
    return docs
