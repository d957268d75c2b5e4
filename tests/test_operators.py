import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrylit import model
from quarrylit.operators import geometry, jsons, layout, linkage, screening, usage, validate
from quarrylit.plans import report
from quarrylit.sources import stages
from quarrylit.streaming import logs


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_every_group_has_one_system(spark):
    rows = spark.range(-1, 233).select("id", validate.system_of_number(F.col("id")).alias("s")).collect()
    assert [r.s == "" for r in rows] == [not 1 <= r.id <= 230 for r in rows]
    assert {r.s for r in rows} == {"", *validate.SYSTEM_LAST}


@pytest.mark.parametrize(
    ("system", "cell", "issues"),
    [
        ("cubic", {"a": "5", "b": "5.1"}, ["a=b"]),
        ("tetragonal", {"gamma": "91"}, ["gamma=90"]),
        ("hexagonal", {"a": "3", "b": "3", "gamma": "119"}, ["gamma=120"]),
        ("trigonal", {"a": "3", "b": "3", "c": "3", "alpha": "60", "beta": "60", "gamma": "60"}, []),
        ("trigonal", {"a": "3", "b": "4", "gamma": "90"}, ["either trigonal setting"]),
        ("rhombohedral", {"a": "3", "b": "4"}, ["a=b=c"]),
        ("monoclinic", {"alpha": "92", "beta": "110"}, ["alpha=90"]),
        ("triclinic", {"a": "8168"}, ["a non-physical"]),
        ("orthorhombic", {"a": "5.02 Å", "beta": "90.4"}, []),
    ],
)
def test_cells(spark, system, cell, issues):
    assert value(spark, validate.lattice_issues(F.lit(system), {k: F.lit(v) for k, v in cell.items()})) == issues


@pytest.mark.parametrize(("label", "wave", "want"), [("Cu Kα", "1.5437 Å", "consistent"), ("Cu Kα", "1.5460", "MISLABELED"), ("Cu Kα", "0.15418 nm", "UNIT_ERROR"), ("Mo Kα", "1.5418", "MISMATCH"), ("Cu Kα", "", "no_wavelength"), ("synchrotr.", "1.0", "unknown_source"), ("Cu Kβ", "1.3922", "consistent")])
def test_wavelengths(spark, label, wave, want):
    assert value(spark, validate.wavelength_check(F.lit(label), F.lit(wave))["status"]) == want


def test_lines_within_tolerance(spark):
    for k, w in zip(validate.LINES, validate.WAVELENGTHS["mo"], strict=True):
        for by, ok in ((0.0019, True), (-0.0019, True), (0.0121, False)):
            assert (value(spark, validate.wavelength_check(F.lit(f"Mo {k}"), F.lit(f"{w + by:.4f}"))["status"]) == "consistent") == ok


def test_records(spark):
    xs = F.array(*(F.lit(x) for x in ("Iron  oxide", "iron oxide", "", "Zinc")))
    assert value(spark, screening.ordered_distinct(xs)) == ["Iron oxide", "Zinc"]
    assert value(spark, screening.ordered_distinct(screening.ordered_distinct(xs))) == ["Iron oxide", "Zinc"]
    assert value(spark, screening.first_filled(F.lit(None).cast("string"), F.lit(" "), F.lit(" x "))) == "x"
    assert value(spark, screening.final_value(F.lit("c"), F.lit(""))) == "c"
    gate = value(spark, screening.verify_gate(F.lit(1), 2, no_text=F.lit(True), cached=F.lit(False)))
    assert not gate["run"] and gate["reasons"] == ["few_signals", "no_text"]
    block = F.create_map(F.lit("a"), F.struct(F.lit("v").alias("value")))
    assert value(spark, screening.flatten_verified(block)) == {"a": "v"}


def test_prices(spark):
    got = value(spark, usage.price(F.lit("gpt-4o-mini-2024")))
    assert (got["input"], got["output"], got["matched"]) == (0.15, 0.60, "gpt-4o-mini")
    assert value(spark, usage.price(F.lit("nothing")))["input"] == 2.0


def test_symbols(spark):
    table = spark.createDataFrame([("P2_1/c", 14, 0), ("P 21/c", 99, 1)], "symbol string, number int, seq int")
    rows = spark.createDataFrame([("P2_1/c",), ("p 21/C",), ("q",)], "symbol string")
    assert [r.space_group_number for r in validate.number_of_symbol(rows, table).orderBy("symbol").collect()] == [14, 14, None]


def test_linkage_prefers_the_earlier(spark):
    records = spark.createDataFrame([(1, "On iron", "Doe", "b")], "id int, title string, authors string, block string")
    other = spark.createDataFrame([(7, 2, "On iron!", "Doe", "b"), (8, 1, "on iron", "Doe", "b"), (9, 0, "Else", "Doe", "b")], "candidate_id int, seq int, candidate_title string, candidate_authors string, block string")
    assert [(r.id, r.candidate_id, r.score) for r in linkage.link(records, other).collect()] == [(1, 8, 1.0)]
    hits = spark.createDataFrame([("TiO2", 136, "Tetragonal", True, 0.0), ("tio2", 1, "cubic", False, 0.5)], "formula string, group_number int, system string, is_stable boolean, above_hull double")
    assert sorted(r.score for r in linkage.structure_scores(hits, "TiO2", 136, "tetragonal").collect()) == [90.0, 180.0]


def test_equal_titles_are_compared_once(spark, monkeypatch):
    compared = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        compared.add(len(a))
        return (a == b).astype(float)

    monkeypatch.setattr(linkage, "similarity", counted)
    records = spark.range(50).selectExpr("id", "concat('On iron ', id % 2) AS title", "'Doe' AS authors", "'b' AS block")
    other = spark.range(60).selectExpr("id AS candidate_id", "id AS seq", "concat('on iron ', id % 3) AS candidate_title", "'Doe' AS candidate_authors", "'b' AS block")
    assert sorted((r.id, r.candidate_id, r.score) for r in linkage.link(records, other).collect()) == [(i, i % 2, 1.0) for i in range(50)]
    assert compared.value <= 2 * 2 * 3  # a pair that passes may be asked for twice


def test_json_leaves_below_eight_levels(spark):
    deep = '{"a":' * 12 + "[7]" + "}" * 12
    a = spark.createDataFrame([(1, deep), (2, '{"b": 1}'), (3, "{"), (4, None)], "k int, j string")
    assert sorted(tuple(r) for r in jsons.leaves(a, "k", "j").collect()) == [(1, ".".join("a" * 12) + "[0]", "7"), (2, "b", "1")]
    assert jsons.leaves(a.limit(0), "k", "j").count() == 0


def test_json_documents_are_parsed_once(spark):
    a = spark.createDataFrame([(1, '{"a}": {"b": ["]]]", {}, [[true]]]}, "c\\"[": 1}'), (2, "[" * 50), (3, "5")], "k int, j string")
    got = jsons.leaves(a, "k", "j")
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Union" not in plan and plan.count("try_parse_json") + plan.count("parse_json(") <= 2 and plan.count("Generate") == 5
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a}.b[0]", "]]]"), (1, "a}.b[2][0][0]", "true"), (1, 'c"[', "1"), (3, "", "5")]


def test_json(spark):
    a = spark.createDataFrame([(1, '{"x": {"y": [1, 2]}, "z": null}'), (2, "broken")], "k int, j string")
    got = {(r.k, r.path): r.value for r in jsons.leaves(a, "k", "j").collect()}
    assert got[1, "x.y[0]"] == "1" and got[1, "x.y[1]"] == "2" and all(k == 1 for k, _ in got)


def test_boxes():
    rng = np.random.default_rng(3)
    for _ in range(50):
        p = rng.uniform(0, 50, (8, 2))
        boxes = np.concatenate((p, p + rng.uniform(0.1, 20, (8, 2))), 1)
        out = geometry.merged(boxes)
        assert all((geometry._iou(b, np.delete(out, i, 0)) <= geometry.LEAST_IOU).all() for i, b in enumerate(out))
        grid = rng.random((12, 12)) < 0.5
        label = geometry.grid_components(grid)
        assert ((label > 0) == grid).all()
        assert (label[:, 1:][grid[:, 1:] & grid[:, :-1]] == label[:, :-1][grid[:, 1:] & grid[:, :-1]]).all()
    assert geometry.regions(np.zeros((0, 4)), 10, 10).shape == (0, 4)


def test_regions_of_pages_are_those_of_each():
    rng = np.random.default_rng(4)
    for least in (1, 4, 60, 300):
        sizes = [3, 1, 8, 199, 30, 201, 2]
        p = rng.uniform(-5, 75, (sum(sizes), 2))
        shapes = np.concatenate((p, p + rng.uniform(-1, 9, p.shape)), 1)
        begins = np.cumsum([0, *sizes[:-1]])
        limits = {"cells": 90, "least": least, "pad": 1.0, "most": 0.9}
        got, of = geometry.regions_of_pages(shapes, begins, 70.0, 90.0, **limits)
        for i, page in enumerate(np.split(shapes, begins[1:])):
            assert (got[of == i] == geometry.regions(page, 70.0, 90.0, **limits)).all()


def test_pages_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        rows = [(p, float(i * 9), 0.0, float(i * 9 + 5), 5.0) for p, n in (("a", 1), ("b", 7), ("c", 2), (None, 3)) for i in range(n)]
        boxes = spark.createDataFrame(rows, "page string, x0 double, y0 double, x1 double, y1 double")
        got = geometry.vector_regions(boxes, width=70.0, height=90.0, cells=90, least=4, pad=0.0, most=0.9).groupBy("page").agg(F.sort_array(F.collect_list("region")).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.page: r.n for r in got} == {"a": [0], "b": list(range(7)), "c": [0, 1], None: [0, 1, 2]}


def test_overlap_is_symmetric(spark):
    a, b = (F.struct(*(F.lit(float(v)).alias(k) for k, v in zip(("x0", "y0", "x1", "y1"), box, strict=True))) for box in ((0, 0, 4, 4), (2, 2, 6, 6)))
    assert value(spark, geometry.iou(a, b)) == value(spark, geometry.iou(b, a)) == 4 / 28
    assert value(spark, geometry.box_kind(F.array(a), F.array(b), a)) == "mixed"


def test_captions(spark):
    block = lambda y, t, x=50.0: F.struct(F.lit(y).alias("y0"), F.lit(x).alias("x0"), F.lit(y + 10).alias("y1"), F.lit(t).alias("text"))
    blocks = F.array(block(10.0, "Figure 1: patterns of"), block(22.0, "all samples."), block(34.0, "Figure 2: other"))
    assert value(spark, layout.assemble_caption(blocks, F.lit(1), F.lit(800.0))) == "Figure 1: patterns of all samples."
    assert value(spark, layout.nearby_text(blocks, F.lit(1), F.lit(800.0))) == "all samples."
    footer = lambda y, t: value(spark, layout.is_footer(F.lit(y), F.lit(800.0), F.lit(t)))
    assert [footer(790.0, t) for t in ("12", "Page 12", "x" * 200 + " ISSN 1", "in 1999", "in 1999 " + "x" * 120)] == [False, True, True, True, False]
    assert not footer(600.0, "Copyright")
    score = lambda t, y, n=1: value(spark, layout.caption_score(F.lit(t), F.lit(y), F.lit(n)))
    assert [score("Figure 1: x", 49.9), score("Figure 1: x", 130.0), score("see fig. 1", 0.0), score("Figure 2, see Figure 1", 0.0), score("none", 0.0)] == [60, 58, 46, None, None]
    far = F.array(block(10.0, "Figure 1: " + "x" * 60), block(40.0, "too far"))
    assert value(spark, layout.assemble_caption(far, F.lit(1), F.lit(800.0))) == "Figure 1: " + "x" * 60
    jump = F.array(block(10.0, "Figure 1:"), block(21.0, "beside", 300.0), block(40.0, "column", 300.0))
    assert value(spark, layout.assemble_caption(jump, F.lit(1), F.lit(800.0))) == "Figure 1: beside"
    full = F.array(block(10.0, "Figure 1: " + "x" * 690), block(21.0, "y"))
    assert value(spark, layout.assemble_caption(full, F.lit(1), F.lit(800.0))) == "Figure 1: " + "x" * 690
    after = F.array(block(10.0, "Figure 1"), block(790.0, "doi 10"), block(22.0, "a"), block(34.0, "Table 1 b"), block(46.0, "out"))
    assert value(spark, layout.nearby_text(after, F.lit(1), F.lit(800.0), 3)) == "a\nTable 1 b"
    assert value(spark, layout.figure_window(F.lit("Fig. 1. A b."), F.lit("C d.  E"), F.lit("t"))) == "Fig. 1. A b. C d. E\n\n[TABLES NEAR FIGURE]\nt"
    assert value(spark, layout.figure_context(blocks, F.lit(2), F.lit("c"), F.lit("p"), 100)) == "all samples. Figure 2: other"
    assert value(spark, layout.figure_context(blocks, F.lit(None).cast("int"), F.lit("c"), F.lit("page"), 3)) == "c p"
    assert value(spark, layout.paragraphs(F.lit("a\n b\n \nc"))) == ["a b", "c"]
    pages = spark.createDataFrame([(1, 2, "x peak"), (1, 1, "Peak peak"), (2, 1, "none")], "doc_id int, page int, text string")
    got = [(r.page, r.start, r.snippet) for r in layout.snippets(pages, "(?i)peak", most=2).orderBy("rank").collect()]
    assert got == [(1, 0, "Peak peak"), (1, 5, "Peak peak")]


def test_report_joins(spark):
    timing = spark.createDataFrame([("n" * 40 + "z", 1, 5.0), ("n" * 40 + "a", 0, 7.0)], "pdf_name string, seq int, wall double")
    rows = spark.createDataFrame([("n" * 40 + "z",), ("n" * 40 + "q",), ("m",)], "stem string")
    assert sorted((r.stem[-1], r.wall) for r in report.with_timing(rows, timing).collect()) == [("m", None), ("q", 7.0), ("z", 5.0)]
    assert report.header(spark.createDataFrame([], "decision string, cost double")).first().avg_cost == 0.0


def test_run_folder(spark, tmp_path):
    for run in ("a", "b"):
        (tmp_path / run / "results").mkdir(parents=True)
        (tmp_path / run / "results" / f"p{run}__phase0.json").write_text('{"decision": "keep"}' if run == "a" else "{broken")
    rows = {r.stem: r for r in stages.stage(spark, str(tmp_path), "__phase0.json", "decision string").collect()}
    assert rows["pa"].decision == "keep" and rows["pb"]._corrupt_record
    assert stages.runs(spark, str(tmp_path)).count() == 2 and stages.latest_run(spark, str(tmp_path)).endswith(("/a", "/b"))
    (tmp_path / "x.pdf").write_bytes(b"one\ftwo")
    got = stages.pages(stages.pdfs(spark, str(tmp_path)), lambda raw: raw.decode().split("\f")).collect()
    assert [(r.page, r.text) for r in got] == [(1, "one"), (2, "two")]
    assert stages.pages(stages.pdfs(spark, str(tmp_path)), lambda raw: 1 / 0).first().page == 0


def test_model_calls(spark):
    requests = spark.createDataFrame([("xrd of lattice",), ("cooking",), ("cooking",)], "prompt string")
    replies = model.ask(requests, model.RuleClient(["xrd", "lattice"]))
    assert sorted(r.decision for r in model.decisions(replies).collect()) == ["keep", "reject"]
    cache = replies.drop("error")
    assert model.ask(requests, model.RuleClient([]), cache.limit(1)).count() == 2


def test_log_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("[10:00:00] phase0: running\n[10:00:01] phase0: done\n[10:00:02] phase1: running\nnoise\n")
    stream = logs.watch(logs.tail(spark, str(tmp_path / "in")), "status", str(tmp_path / "check"))
    stream.processAllAvailable()
    stream.stop()
    assert {r.phase: r.status for r in spark.table("status").collect()} == {"phase0": "done", "phase1": "running"}
    assert value(spark, logs.failure_count(F.lit("Error: it failed; errors"))) == 2
