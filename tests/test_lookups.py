"""References, pictures, links without a block, hints and differences against plain versions."""

import difflib
import json
import random

from pyspark.sql import functions as F

from quarrylit.operators import crops, hints, linkage, records, references


def test_merged_types(spark):
    rows = [
        (1, 2, {"title": "c", "n": 2, "tags": ["x"], "map": {"k": "v"}, "ok": True}), (1, 0, {"title": " ", "n": 0, "tags": [], "map": {}, "ok": False}), (1, 1, {"title": " b ", "tags": None, "n": "no number"}),
        (2, 0, {}), (3, 0, None), (4, 1, {"tags": ["late"]}), (4, 0, {"tags": [""]}),
    ]
    frame = spark.createDataFrame([(k, p, json.dumps(r) if r is not None else "broken") for k, p, r in rows], "k long, p int, r string")
    kinds = {"title": references.Field("$.title"), "n": references.Field("$.n", "int", F.lit(-1)), "tags": references.Field("$.tags", "array<string>"), "map": references.Field("$.map", "map<string,string>"), "ok": references.Field("$.ok", "boolean")}
    got = {r.k: tuple(r)[1:] for r in references.merged(frame, "k", "p", "r", kinds).collect()}
    assert got == {1: ("b", 2, ["x"], {"k": "v"}, True), 2: ("", -1, [], {}, False), 3: ("", -1, [], {}, False), 4: ("", -1, [""], {}, False)}


def test_reference(spark):
    def first(rows):
        frame = spark.createDataFrame([(1, i, json.dumps(r)) for i, r in enumerate(rows)], "k long, p int, r string")
        return references.reference(frame, "k", "p", "r", F.lit("x.json")).first().asDict()

    got = first([{"methods": {"title": "M", "author": "A"}, "global": {"title": "G", "doi": "d1"}}, {"title": "late", "doi": "d2", "pdf": "/a/Springer/b.pdf"}])
    assert (got["title"], got["doi"], got["author"], got["pdf_name"], got["source_type"], got["arxiv_id"]) == ("M", "d1", "A", "b.pdf", "springer", "")
    got = first([{"title": "own", "global": {"doi": "not asked"}}])
    assert (got["title"], got["doi"], got["pdf_name"], got["source_type"]) == ("own", "", "x.json", "unknown")
    got = first([{"pdf": "/arxiv/1.pdf", "title": "arXiv: cond-mat/0101001v1"}, {"source_type": "ArXiv"}])
    assert (got["doi"], got["doi_source"], got["arxiv_id"], got["source_type"]) == ("10.48550/arXiv.cond-mat/0101001", "arxiv", "cond-mat/0101001v1", "arxiv")


def test_references_keep_whole_arxiv_numbers(spark):
    rows = spark.createDataFrame([(1, 0, '{"pdf":"/arxiv/arXiv 2401.100087v2/2401.100087v2.pdf"}')], "k int, p int, record string")
    got = references.reference(rows, "k", "p", "record", F.lit("x.json")).first()
    assert (got.arxiv_id, got.doi, got.pdf_name) == ("2401.100087v2", "10.48550/arXiv.2401.100087", "2401.100087v2.pdf")


def test_assembled(spark):
    text = "A rather long title of a paper on NiFe2O4\nJ. Doe, University of X\nAbstract\nWe made NiFe2O4.\nIntroduction\nSee 10.1000/ab.c). And arXiv:2401.12345v2"
    none = (None,) * 5
    rows = [("/a.pdf", "short", " Doe ", [text], *none), ("/b.pdf", "", "", [text.replace("arXiv:2401.12345v2", "")], "Given", "A found title that is longer than every other title there is", "10.2/f", "crossref", "Found"), ("/c.pdf", None, None, None, *none), ("/d.pdf", "T", "", ["no identifiers"], None, "t", "10.3/f", "crossref", None)]
    frame = spark.createDataFrame(rows, "path string, meta_title string, meta_author string, pages array<string>, material string, found_title string, found_doi string, found_doi_source string, found_author string")
    a, b, c, d = references.assembled(frame).orderBy("path").collect()
    assert (a.title, a.doi, a.author, a.source_type, a.arxiv_id, a.doi_source, a.published_doi) == ("A rather long title of a paper on NiFe2O4", "10.48550/arXiv.2401.12345", "Doe", "arxiv", "2401.12345v2", "arxiv", "10.1000/ab.c")
    assert "NiFe2O4" in a.abstract and a.main_material
    assert (b.doi, b.doi_source, b.author, b.main_material, b.title[:7]) == ("10.1000/ab.c", "", "Found", "Given", "A found")
    assert (c.title, c.doi, c.abstract, c.author, c.source_type) == ("", "", "", "", "")
    assert (d.title, d.doi, d.doi_source) == ("T", "10.3/f", "crossref")


def test_slim_keeps_verified_values(spark):
    """What was verified in one stage is there for the next, whatever its type; odd blocks don't fail."""
    record = {"title": "", "abstract": " A  b ", "global_xrd_text": {"verified": {"a": {"value": None}, "b": {"value": {"x": 1}}, "c": 5, "fwhm": {"value": ""}}, "regex_candidate": {"fwhm": ["1"], "cell_volume": "9", "database_refs": [], "software": "not carried"}}, "xrd_figures": [{"phase2_xrd_text": {"verified": {"z": {"value": True}}}}, {"phase2_xrd_text": None}, {"phase2_xrd_text": {"verified": [1]}}]}
    rows = spark.createDataFrame([(1, json.dumps(record)), (2, "broken"), (3, "{}")], "k int, record string")
    got = {r.k: r for r in records.slim(rows).collect()}
    assert got[1]["global"] == {"a": "null", "b": '{"x":1}', "fwhm": '""', "cell_volume": '"9"'} and got[1].main_material == "A b"
    assert [f.xrd_metadata for f in got[1].figures] == [{"z": "true"}, {}, {}]
    assert got[1].figures[1].plot_info.legend_entries == [] and got[1].figures[1].plot_info.lattice_parameters == {}
    assert got[2]["global"] == {} and got[3].figures == []


def test_pictures(spark):
    fig = lambda *paths: [(p, 3, None, "c") for p in paths]
    recs = [("/o/a__final.json", "/x/A.pdf", fig("/p1.png", "/gone.png")), ("/o/a__phase1_raw.json", "/x/A.pdf", fig("/p2.png", "/p1.png")), ("/o/a__phase2_enriched.json", "/x/A.pdf", fig("/p3.png")), ("/o/z__phase2_enriched.json", "/y/a.PDF", fig("/p4.png")), ("/o/y__phase1_raw.json", "/y/b.pdf", fig("/p5.png")), ("/o/n__phase1_raw.json", "", fig("/p6.png"))]
    files = [f"/p{i}.png" for i in range(1, 7)] + ["/o/a__XRD_ONLY/2.png", "/o/a__XRD_ONLY/1.png", "/o/y__XRD_ONLY/1.png", "/o/a__XRD_ONLY/no.txt"]
    wanted = [(1, "/o/a__final.json", "a", "/x/A.pdf"), (2, "/o/q__final.json", "q", "/else/A.pdf"), (3, "/o/w__final.json", "w", "/z/B.pdf"), (4, "/o/e__final.json", "e", ""), (5, "/o/c__final.json", "y", None)]
    schema = "json_path string, pdf string, figures array<struct<path: string, number: int, page: int, caption: string>>"
    got = crops.pictures(spark.createDataFrame(wanted, "id long, json_path string, base string, pdf string"), spark.createDataFrame(recs, schema), spark.createDataFrame([(f,) for f in files], "path string")).orderBy("id", "place").collect()
    by = {i: [(r.path, r.level) for r in got if r.id == i] for i in range(1, 6)}
    assert by[1] == [("/p1.png", 1), ("/p2.png", 2), ("/p3.png", 2), ("/o/a__XRD_ONLY/1.png", 4), ("/o/a__XRD_ONLY/2.png", 4)]
    assert by[2] == [("/p2.png", 3), ("/p1.png", 3), ("/p3.png", 3), ("/p4.png", 3)]
    assert by[3] == [("/p5.png", 3)] and by[4] == [] and by[5] == [("/p5.png", 2), ("/o/y__XRD_ONLY/1.png", 4)]
    assert got[0].caption == "Figure 3 • c"


def test_links_without_a_block(spark):
    """Every pair of all that reaches the score is found, and few pairs are compared."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(300)] + ["of", "the", "in"] * 20
    titles = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 9))) for _ in range(150)]
    typo = lambda t: "".join(rng.choice("xyz") if rng.random() < 0.03 else c for c in t)
    candidates = [(i, i, typo(t) if i % 2 else t.upper(), rng.choice(["J. Doe", "A. Roe; B. Poe", None])) for i, t in enumerate(titles + titles[:20])]
    recs = [(i, t, rng.choice(["Doe, J.", "Roe, A.", ""])) for i, t in enumerate(titles)] + [(999, None, "x"), (998, "", "")]
    r = spark.createDataFrame(recs, "id long, title string, authors string")
    c = spark.createDataFrame(candidates, "candidate_id long, seq long, candidate_title string, candidate_authors string")
    every = linkage.link(r.withColumn("block", F.lit(1)), c.withColumn("block", F.lit(1)).fillna("", ["candidate_authors"]))
    want = {x.id: (x.candidate_id, round(x.score, 9)) for x in every.where("id < 900").collect()}
    got = {x.id: (x.candidate_id, round(x.score, 9)) for x in linkage.linked(r, c).where("id < 900").collect()}
    assert want and got == want
    key = lambda df, col, name: df.select(linkage.match_key(F.col(col)).alias(name)).where(f"{name} IS NOT NULL").distinct()
    compared = linkage.title_pairs(key(r, "title", "title"), key(c, "candidate_title", "other"), 0.75).count()
    assert len(want) <= compared <= 4 * len(candidates)  # of 150 x 170


def walked(record):
    """All leaves first, then the three lists."""
    rows, found = [], ([], [], [])

    def walk(node, path):
        if isinstance(node, dict):
            for k, x in node.items():
                walk(x, f"{path}.{k}")
        elif isinstance(node, list):
            for i, x in enumerate(node):
                walk(x, f"{path}[{i}]")
        elif node is not None and str(node).strip():
            rows.append((path.lower().split(".")[-1], str(node).strip()))

    walk(record, "root")
    add = lambda to, x: x and x not in to and to.append(x)
    for key, text in rows:
        if any(k in key for k in hints.FORMULA_KEYS):
            add(found[0], hints.formula(text, {"iron": "Fe"}))
        for g in hints.GROUP.findall(text):
            add(found[2], " ".join(g.split()))
        for t in hints.PHASES:
            if f" {t} " in f" {text.lower()} ":
                add(found[1], t)
    if not found[0]:
        for _, text in rows:
            add(found[0], hints.formula(text, {"iron": "Fe"}))
    return tuple(x[:8] for x in found)


def test_hints(spark):
    rng = random.Random(9)
    texts = ["NiFe2O4", "Iron", "the Fe2O3 of x", "P 63/mmc", "fm 3", "cubic", "a hexagonal fcc", "TiO2", "plain", "", None, 7, 2.5, True, *(f"A{i}B" for i in range(9)), *(f"P {i}" for i in range(9)), *hints.PHASES]

    def node(depth):
        kind = rng.random()
        if depth and kind < 0.4:
            return {rng.choice(["material", "x", "phase_name", "note", "a.b"]) + str(i): node(depth - 1) for i in range(rng.randint(0, 5))}
        return [node(depth - 1) for _ in range(rng.randint(0, 5))] if depth and kind < 0.7 else rng.choice(texts)

    records_ = [node(5) for _ in range(200)] + [{"a": list(texts) * 3}, {"material": list(texts) * 3}]
    deep = "x"
    for _ in range(300):
        deep = {"k": [deep]}
    rows = [(i, json.dumps(r)) for i, r in enumerate(records_)] + [(1000, "broken"), (1001, None), (1002, json.dumps(deep))]
    got = {r.id: (r.formulas, r.phases, r.groups) for r in hints.hints(spark.createDataFrame(rows, "id long, record string"), "record", {"iron": "Fe"}).collect()}
    assert {i: tuple(got[i]) for i in range(len(records_))} == {i: walked(r) for i, r in enumerate(records_)}
    assert got[1000] == got[1001] == ([], [], []) and got[1002] == ([], [], [])


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        was = row[:]
        for j, y in enumerate(b, 1):
            row[j] = was[j - 1] + 1 if x == y else max(was[j], row[j - 1])
    return row[-1]


def test_differences(spark):
    rng = random.Random(10)
    sides = [("", ""), ("a", ""), (None, "b"), ("a\nb", "a\nb"), ("\n", "x"), ("a\n" * 400 + "x", "a\n" * 400 + "y")]
    for _ in range(120):
        a = [rng.choice("abcdefg") for _ in range(rng.randint(0, 40))]
        b = [x for x in a if rng.random() < 0.85] if rng.random() < 0.7 else [rng.choice("abcdefg") for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.choice("abcxyz"))
        sides.append(("\n".join(a), "\n".join(b)))
    got = {}
    for r in hints.differences(spark.createDataFrame([(i, *s) for i, s in enumerate(sides)], "id long, old string, new string"), "id", "old", "new").orderBy("id", "hunk").collect():
        got.setdefault(r.id, []).append(r)
    for i, (old, new) in enumerate(sides):
        a, b = (x.split("\n") if x else [] for x in (old, new))
        out, at = [], 0
        for h in got.get(i, []):
            own = [x[1:] for x in h.lines if x[0] != "+"]
            assert a[h.left_start - 1 : h.left_start - 1 + h.left_lines] == own and b[h.right_start - 1 : h.right_start - 1 + h.right_lines] == [x[1:] for x in h.lines if x[0] != "-"]
            out += a[at : h.left_start - 1] + [x[1:] for x in h.lines if x[0] != "-"]
            at = h.left_start - 1 + h.left_lines
            marks = "".join(x[0] for x in h.lines)
            assert marks.strip(" ") and len(marks) - len(marks.lstrip(" ")) <= 3 and len(marks) - len(marks.rstrip(" ")) <= 3 and " " * 7 not in marks
        assert out + a[at:] == b  # the hunks turn one into the other
        removed = sum(x[0] == "-" for h in got.get(i, []) for x in h.lines)
        assert len(a) - removed == subsequence(a, b)  # and leave as much as can be left
    plain = list(difflib.unified_diff(["a", "b", "c", "d", "e", "f", "g", "h"], ["a", "b", "c", "d", "x", "f", "g", "h"], lineterm="", n=3))[3:]
    assert hints.hunks(list("abcdefgh"), list("abcdxfgh"))[0][4] == plain


def test_a_missing_path_that_many_name_is_not_one_task(spark):
    figures = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN '/gone.png' WHEN id % 3 = 1 THEN '/all.png' ELSE concat('/', id, '.png') END AS path")
    files = spark.createDataFrame([("/all.png",), ("/2.png",)], "path string")
    got = crops._existing(figures.where("id < 3000").unionByName(figures), files)
    assert sorted((r.path, r["count"]) for r in got.groupBy("path").count().collect()) == [("/2.png", 2), ("/all.png", 2000)]
