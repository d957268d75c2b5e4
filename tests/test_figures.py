from pyspark.sql import functions as F

from quarrylit.operators import figures


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def score(spark, kind, share, size, near, page=""):
    return value(spark, figures.candidate_score(*(F.lit(x) for x in (kind, share, size, near, page))))


def test_candidate_scores(spark):
    got = score(spark, "vector", 0.05, 5000, "Figure 1 XRD")
    assert got["score"] == 1.0 and got["call"] and got["reasons"] == ["vector_or_mixed_candidate", "reasonable_area", "nontrivial_crop", "nearby_text_support"]
    got = score(spark, "vector", 0.05, 5000, " ", "Rietveld")
    assert got["score"] == 0.8 and not got["call"] and got["reasons"][-1] == "skip_textless_vector_candidate"
    got = score(spark, "raster", 0.01, 100, "", "")
    assert got["score"] == 0.0 and got["reasons"] == ["skip_tiny_render", "below_agent_score_threshold"]


def test_text_near(spark):
    word = lambda x, y, t: F.struct(*(F.lit(v).alias(k) for k, v in (("x0", x), ("y0", y), ("x1", x + 5), ("y1", y + 5), ("text", t))))
    box = F.struct(*(F.lit(float(v)).alias(k) for k, v in (("x0", 100), ("y0", 100), ("x1", 200), ("y1", 200))))
    words = F.array(word(120.0, 330.0, "below"), word(110.0, 20.0, "above"), word(110.0, 400.0, "far"), word(10.0, 150.0, "left"))
    assert value(spark, figures.text_near(words, box)) == "above below"


def test_records(spark):
    got = value(spark, figures.provenance(F.lit(True), F.lit(False), F.lit("supported")))
    assert (got["sources"], got["verified_status"]) == (["global_regex", "llm_verification"], "supported")
    assert value(spark, figures.provenance(F.lit(False), F.lit(False), F.lit("")))["verified_status"] == "not_verified"
    got = value(spark, figures.provenance(F.lit(False), F.lit(True), F.lit(None).cast("string"), F.lit("Fig. 1"), "reported_phases"))
    assert (got["sources"], got["verified_status"]) == (["figure_vision_phase1", "caption"], "not_verified")
    assert value(spark, figures.figure_id(F.lit("p"), F.lit(2), F.lit(7))) == "p__fig2_p7"
    names = {"iron": "Fe"}
    assert [value(spark, figures.formula_like(F.lit(x), names)) for x in ("Iron", "Ti O2", "the NiFe2O4 phase", "123", None)] == ["Fe", "TiO2", "NiFe2O4", "", ""]
    assert value(spark, figures.figure_candidate(F.array(F.lit("a")), F.array().cast("array<string>"))) == ["a"]


def test_patches_the_first_figure_only(spark):
    rows = spark.createDataFrame([("p", [(1, "old"), (2, None), (2, None)])], "stem string, figures array<struct<figure_number:int, curves:string>>")
    curves = spark.createDataFrame([("p", 2, "new"), ("p", 2, "newer"), ("p", None, "lost")], "stem string, figure_number int, curves string")
    assert [tuple(f) for f in figures.patched(rows, curves).first().figures] == [(1, "old"), (2, "new"), (2, None)]
    files = spark.createDataFrame([("p", "b", "2"), ("p", "a", "1"), ("p", "z", "3")], "stem string, tag string, path string")
    assert [tuple(v) for v in figures.variants(files, ["a", "b"]).first().variants] == [("a", "1"), ("b", "2")]
    papers = spark.createDataFrame([("p", [("Fe",), (" ",), ("Fe",), ("Ni",)], {"x": "1"})], "stem string, figures array<struct<material:string>>, methods map<string,string>")
    assert tuple(figures.summary(papers).first()) == ("p", 4, "Fe, Ni", "x")
