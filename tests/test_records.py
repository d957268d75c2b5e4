"""Titles, materials and coercions by cases that each follow one rule."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from quarrylit.operators import linkage, records
from quarrylit.plans import html
from quarrylit.sources import stages


def each(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_titles_of_texts(spark):
    texts = {
        None: "",
        "too short\nstill short": "",
        "arXiv:2401.00001 something long here\nA long enough title of the paper 1": "A long enough title of the paper 1",
        "Anna Bell and Carl Dorn\nStructure of NiO at 300 K, revisited": "Structure of NiO at 300 K, revisited",
        "Structural study of Fe2O3 with\nsmall  grains\nnot this": "Structural study of Fe2O3 with small grains",
        "Structural study of Fe2O3 with\nAbstract\nmore": "Structural study of Fe2O3 with",
        "Structural study of Fe2O3 with\na, b, c, d": "Structural study of Fe2O3 with",
        "Structural study of Fe2O3 with\nme@x.org": "Structural study of Fe2O3 with",
        "Structural study of Fe2O3 with\nUniversity of X": "Structural study of Fe2O3 with",
        "Structural study of Fe2O3 and\nof the\nother oxides of\nnickel in 2 samples": "Structural study of Fe2O3 and of the other oxides of nickel in 2 samples",
        "\n".join(["short 1"] * 20 + ["A long enough title of the paper 1"]): "",
    }
    assert each(spark, records.text_title, list(texts)) == list(texts.values())
    assert each(spark, lambda c: records.longer_title(c, F.lit("abc")), ["abcd", "ab", None]) == ["abcd", "abc", "abc"]


def test_materials(spark):
    texts = {None: "", "nothing here": "", "We study NiFe2O4 nanoparticles by XRD": "NiFe2O4", "On Fe-Cr alloys": "Fe-Cr", "XRD of TiO2": "TiO2", "PXRD": ""}
    got = each(spark, lambda c: records.guessed_material(F.lit(""), c), list(texts))
    assert got[0] == got[1] == got[5] == "" and got[2] == "NiFe2O4" and got[4] == "TiO2"
    lists = lambda *x: F.array(*(F.lit(v) for v in x)).cast("array<string>")
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(records.uniq_clean(lists(" a  b", "A B", "", None, "c"))) == ["a b", "c"]
    assert [one(records.figure_material(*x)) for x in ((lists(), lists("x"), lists("y")), (lists("s"), lists("x"), lists()), (lists(" "), lists(), lists()))] == ["x", "s", ""]


def test_coercions(spark):
    assert each(spark, records.group_number, ["No. 225", "0", "231", "x", None, "62 or 63"]) == [225, 0, 0, 0, 0, 62]
    assert each(spark, records.symbol_text, ["Pm−3m", " P6₃/mmc ", None, "R–3c"]) == ["Pm-3m", "P63/mmc", "", "R-3c"]
    assert each(spark, records.wavelength_of, ["Cu-Kα (λ = 1.5406 Å)", "Kα1 1", "0.05 then 1.54", "LAMBDA 0.71", "= =2.5", None]) == ["1.5406", "", "1.54", "0.71", "2.5", ""]
    assert each(spark, records.evidence_tag, ["x", " ", None]) == ["phase 2 addition", "", ""]
    assert each(spark, lambda c: records.nested(c, "a", "b", default="-"), ['{"a":{"b":"1"}}', '{"a":2}', None]) == ["1", "-", "-"]
    assert each(spark, lambda c: records.keyword_query(c, F.lit("'XRD' OR \"neutron\"")), ["Fe OR Ni"]) == ['(keyword:"Fe" OR keyword:"Ni") AND (keyword:"XRD" OR keyword:"neutron")']
    assert each(spark, lambda c: records.first_text(F.array(c, F.lit(" b "))), [" ", "a"]) == ["b", "a"]


def test_identifiers_count_in_links(spark):
    papers = spark.createDataFrame([("p", "on the structure of iron oxide", "A. Bell", "k", "arXiv:2401.00001")], "id string, title string, authors string, block string, arxiv_id string")
    found = spark.createDataFrame([("c", 1, "on the structure of iron oxides", "C. Dorn", "k", "2401.00001v2"), ("d", 2, "on the structure of iron oxides", "C. Dorn", "k", "2402.00001v2")], "candidate_id string, seq int, candidate_title string, candidate_authors string, block string, candidate_arxiv_id string")
    got = linkage.link(papers, found, weights=linkage.ARXIV).collect()
    assert [r.candidate_id for r in got] == ["c"] and 0.75 < got[0].score < 0.80
    assert linkage.link(papers.drop("arxiv_id"), found, weights=linkage.ARXIV).count() == 0


def test_credentials(spark):
    stages = spark.createDataFrame([("b", 2, "K", True), ("a", 1, "K", True), ("c", 3, "L", False), ("d", 4, "M", True)], "stage string, seq int, credential string, enabled boolean")
    have = spark.createDataFrame([("M", "x"), ("K", " ")], "credential string, value string")
    assert [tuple(r) for r in records.missing_credentials(stages, have).collect()] == [("K", ["a", "b"])]


def test_html_report(spark, tmp_path):
    papers = spark.createDataFrame([("p", "a </script> b", "x.png")], "stem string, title string, image string")
    html.write({"papers": 1}, papers, f"file://{tmp_path}/report.html")
    page = (tmp_path / "report.html").read_text()
    data = page.split('type="application/json">')[1].split("</script>")[0]
    assert json.loads(data)["papers"][0]["title"] == "a </script> b"
    assert "data:image/png;base64,eA==" in html.render({}, [{"image": "x"}], image=lambda p: b"x")


def test_manifest_and_archive(spark, tmp_path):
    path = stages.manifest(spark, f"file://{tmp_path}/run", sources=["arxiv"], n=1)
    assert json.loads((tmp_path / "run" / "run.json").read_text()) == {"sources": ["arxiv"], "n": 1} and path.endswith("/run.json")
    files = spark.createDataFrame([("/r/b/2.txt", b"two"), ("/r/a.txt", b"one")], "path string, content binary")
    with zipfile.ZipFile(io.BytesIO(stages.zipped(files, "/r"))) as z:
        assert z.namelist() == ["a.txt", "b/2.txt"] and z.read("b/2.txt") == b"two"


def test_blocks_and_lists_are_made_once(spark):
    rows = spark.createDataFrame([(["B  x", "b x", "a", "B x", " "], '{"fwhm":{"value":1}}', '{"fwhm":[2],"cell_volume":"3","other":4}')], "items array<string>, own string, found string")
    got = rows.select(records.uniq_clean(F.col("items")).alias("items"), records.paper_fields(F.col("own"), F.col("found")).alias("fields"))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert plan.count("coalesce(items#") == 1 and plan.count("(own#") == 1
    assert got.first() == (["B x", "a"], {"fwhm": "1", "cell_volume": '"3"'})
