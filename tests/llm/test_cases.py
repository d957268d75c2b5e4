"""Rows that every operator must bear: null ids, repeated rows, null, empty and very long texts, columns of clashing names, no rows."""

import pytest
from pyspark.sql import functions as F

from quarrylit.llm import decontaminate, fingerprints, fst, jaccard, langid, packing, phrases, quality, repetition, secrets, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = "the quick brown fox jumps, over 12 lazy dogs. " * 9000 + "x" * 100_000
ROWS = [(1, "a b c password = abcdefgh12"), (1, "a b c password = abcdefgh12"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, LONG), (None, "a b c"), (None, "a b c"), (None, None), (-7, "É 語 \x00 z")]
CLASH = ("score", "predicted", "held_out", "rejected", "n_words", "kept", "start", "length", "n_bytes", "n_tokens", "spans", "fingerprint", "component_id", "rank", "label", "weight", "n_hit", "mask")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if i % 2 else None, "s", *(["7"] * len(CLASH))) for i, (k, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", *(f"{c} string" for c in CLASH)])).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(-8, 8)] + [(None, 1, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "decontaminate": lambda d, labels: decontaminate.scan(d, d.sparkSession.createDataFrame([(1, "a b c"), (None, "quick brown fox"), (2, None)], "item_id long, text string")),
    "secrets": lambda d, labels: secrets.scan(d),
    "quality": lambda d, labels: quality.score(d, quality.fit(d, labels)),
    "langid": lambda d, labels: langid.predict(d, langid.fit(d)),
    "toxicity": lambda d, labels: toxicity.score(d, toxicity.fit(d, labels)),
    "repetition": lambda d, labels: repetition.score(d),
    "token counts": lambda d, labels: fst.counts(d, public_tokenizers.path("byte_bpe_50k.json")),
    "fingerprints": lambda d, labels: fingerprints.neighbours(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(docs, labels, name):
    got = OPERATORS[name](docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(k) for k, _ in ROWS)
    if name != "fingerprints":  # whose neighbours differ
        assert len({str(r) for r in got if r.doc_id == 1}) == 1
        five, six = ({k: v for k, v in r.asDict().items() if k not in ("doc_id", "held_out")} for r in got if r.doc_id in (5, 6))
        assert five == six
    assert OPERATORS[name](docs.limit(0), labels).count() == 0
    assert OPERATORS[name](docs, labels.limit(0)).count() == len(ROWS)


def test_components(docs):
    some = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r.doc_id: r.component_id for r in jaccard.components(some).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, -7: -7}
    assert jaccard.components(docs.limit(0)).count() == 0


def test_packing(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path)
    whole = got.groupBy(F.col("doc_id").isNull().alias("nameless")).agg(F.sum("length").alias("n")).collect()
    plain = {r.doc_id: r.n for r in packing.pack(docs.where("doc_id IS NOT NULL"), path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.nameless for r in whole} == {True, False} and sum(r.n for r in whole if not r.nameless) == sum(plain.values())
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_collocations(docs):
    got = phrases.mine(docs, least=1000).collect()
    assert {r.lang for r in got} <= {"en", "und"} and any(r.phrase == "over 12 lazy dogs" for r in got)
