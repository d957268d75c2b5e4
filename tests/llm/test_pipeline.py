"""The pipeline's stages on a small table, each against what its input says it must do."""

import corpus_pipeline
import pandas as pd

from .test_operators import brute_components, contamination, repetition_of
from quarrylit.llm import repetition


def test_stages(spark, tmp_path):
    prose = [" ".join(f"word{(i * 37 + k * k * (i + 3)) % 997}" for k in range(80)) for i in range(20)]
    item = " ".join(f"bench{k}" for k in range(20))
    texts = [*prose, prose[3] + " tail", prose[3], "same " * 50, None, prose[5] + " " + item, prose[6] + " token=abcdefgh12345", "short"]
    rows = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": [f"s{i % 3}" for i in range(len(texts))], "n_chars": [len(t or "") for t in texts]})
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs.toPandas())
        if i < 4:
            assert docs.columns == list(rows.columns)
    limits = repetition.Limits()
    good = [i for i, t in enumerate(texts) if (m := repetition_of(t, limits))["n_words"] >= 20 and 100 * m["n_repeat_words"] <= 30 * m["n_words"]]
    assert sorted(seen[0].doc_id) == good
    label, _ = brute_components([texts[i] for i in good], 5, 80)
    first = [good[i] for i in sorted(set(label))]
    assert sorted(seen[1].doc_id) == first
    clean = [i for i in first if not contamination(texts[i], [(7, item)])[4]]
    assert sorted(seen[2].doc_id) == clean and 24 not in clean
    redacted = seen[3].set_index("doc_id")
    assert sorted(redacted.index) == clean and (redacted.text.str.len() == redacted.n_chars).all() and not redacted.text.str.contains("abcdefgh12345").any()
    assert set(seen[4].doc_id) == set(clean) and seen[4].groupby("doc_id").length.sum().eq(seen[4].groupby("doc_id").doc_tokens.first()).all()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen[4])


def test_stages_bear_awkward_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, columns of clashing names; and no rows at all."""
    prose = " ".join(f"word{k * k % 997}" for k in range(90))
    rows = [(1, prose), (1, prose), (None, prose + " other tail"), (None, None), (3, ""), (4, " ".join(f"other{k * k % 887}" for k in range(70)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, spans string, kept string"
    frame = spark.createDataFrame([(k, t, None, None, len(t or ""), "7", "7", "7") for k, t in rows], schema)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, docs in (("some", frame), ("none", frame.limit(0))):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, str(tmp_path))
            made.write.parquet(f"{tmp_path}/{name}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{i}")
            if i < 4:
                assert docs.columns == frame.columns
        got = docs.toPandas()
        assert (4 in set(got.doc_id) and got.length.sum() > 0) if name == "some" else got.empty
