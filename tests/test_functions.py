import re

import pytest
from pyspark.sql import functions as F

from quarrylit.functions import fields, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("field", "sample", "want"),
    [
        ("scan_range_2theta", "2θ from 10 to 80°", "10–80° 2θ"),
        ("scan_range_2theta", "scanned widely", ""),
        ("step_size", "step size of 0.02°", ""),
        ("step_size", "step size: 0.02°", "0.02°"),
        ("radiation", "with Cu Kα radiation", "Cu-Kα"),
        ("radiation", "cu K a, λ = 1.5406 Å", "cu-Kα (λ=1.5406 Å)"),
        ("radiation_wavelength", "λ = 1.5406 Å", "1.5406 Å"),
        ("software", "GSAS-II, FullProf and GSAS-II", ["FullProf", "GSAS-II"]),
        ("context_temperature", "at 300 °C and 25 C", ["25 °C", "300 °C"]),
        ("crystal_structure", "FCC then Cubic", ["cubic", "fcc"]),
        ("space_group", "Fm-3m", []),
        ("space_group_number", "Space group No. 225", "225"),
        ("space_group_number", "space group Pnma (62)", "62"),
        ("space_group_number", "space group No. 231", ""),
        ("reported_phases", "JCPDS 21-1272 anatase, α-Fe2O3", ["ICDD 21-1272", "anatase", "α-Fe2O3"]),
        ("profile_function", "a pseudo-Voigt shape", "pseudo-Voigt"),
        ("peak_positions_2theta", "2θ = 30.1°, peak at 25°, 2θ = 3°", ["25.0°", "30.1°"]),
        ("fwhm", "FWHM = 0.2° and FWHM: 0.10°", ["0.10°", "0.2°"]),
        ("formula_units_Z", "Z = 4, z = 5", "4"),
        ("chemical_formula", "TiO2 and NiFe2O4 and NiFe2O4", "NiFe2O4"),
        ("chemical_formula", "TiO2 and SiO2", "TiO2"),
        ("database_refs", "ICSD 12345, mp-22, COD #1234567", ["COD 1234567", "ICSD 12345", "mp-22"]),
        ("xray_density", "X-ray density = 5.36 g/cm³", "5.36 g/cm³"),
        ("cell_volume", "V = 588.97(8) Å3", "588.97 ų"),
        ("formula_weight", "molecular weight = 159.69 g/mol", "159.69 g/mol"),
        ("wyckoff_positions", "Wyckoff position 4e, 8c sites", ["4e", "8c"]),
        ("miller_indices", "(111), (2 2 0), (1993)", ["(111)", "(220)"]),
        ("lattice_parameters", "a = 5.43(2) Å, c = 3 A, a = 5.5 Å", {"a": "5.5 Å", "c": "3 Å"}),
        ("lattice_parameters", "β = 90.5 deg rest", {"β": "90.5°"}),
        ("lattice_parameters", "β = 90°, rest", {}),
    ],
)
def test_fields(spark, field, sample, want):
    assert one(spark, fields.extractors(F.col("t"))[field], t=sample) == want


def passes(spark, field):
    """How often a field's expression goes through the text."""
    plan = spark.createDataFrame([("",)], "t string").select(fields.extractors(F.col("t"))[field])._jdf.queryExecution().analyzed().toString()
    return plan.count("regexp_extract_all(t#")


def test_cells_go_through_a_text_once_a_pattern(spark):
    assert passes(spark, "lattice_parameters") == 2
    many = "".join(f"{'abc'[i % 3]} = {i}.5({i % 9 + 1}) A, α = {i % 180} deg. " for i in range(3000))
    assert one(spark, fields.extractors(F.col("t"))["lattice_parameters"], t=many) == {"a": "2997.5(1) Å", "b": "2998.5(2) Å", "c": "2999.5(3) Å", "α": "119°"}


def test_formulas_are_counted_in_one_pass(spark):
    assert passes(spark, "chemical_formula") == 1
    many = " and ".join([f"Fe{i}O{i}" for i in range(2000)] + ["Ni2O3", "Al2O3", "Al2O3", "Ni2O3"])
    assert one(spark, fields.extractors(F.col("t"))["chemical_formula"], t=many) == "Ni2O3"
    assert one(spark, fields.formula_mode(F.col("t")), t=None) == ""


def test_list_fields_go_through_a_text_once(spark):
    assert [passes(spark, f) for f in ("miller_indices", "wyckoff_positions", "reported_phases", "database_refs")] == [1, 1, 2, 3]
    assert one(spark, fields.extractors(F.col("t"))["wyckoff_positions"], t="4a site, Wyckoff site 12B and 8c positions") == ["12B", "4a", "8c"]


def test_costly_rows_of_a_small_file_are_spread(spark, tmp_path):
    from quarrylit.plans.corpus import corpus

    spark.range(100).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size", "1.5D AS p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert corpus(spark, str(tmp_path)).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert corpus(spark, str(tmp_path)).count() == 100


def test_fields_of_nothing(spark):
    rows = fields.extract(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")).collect()
    assert all(not r[f] for r in rows for f in fields.extractors(F.lit("")))


@pytest.mark.parametrize(("name", "want"), [("a/b: c?", "a_b_ c"), (None, "paper"), ("con", "file_con"), ("  ..__ ", "paper"), ("<b>T</b> $x^2$ (1)", "T_ _ _1")])
def test_stems(spark, name, want):
    assert one(spark, text.safe_stem(F.col("t")), t=name) == want


def test_stems_with_reserved_names(spark, tmp_path):
    from quarrylit import catalogue

    spark.createDataFrame([(1, "con.\nmore"), (2, "LPT1")], "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in catalogue.queries()["safe_stem"](spark, str(tmp_path)).collect()) == [(1, "con"), (2, "LPT1")]
    assert one(spark, text.safe_stem(F.col("t")), t="LPT1") == "file_LPT1"


def test_long_stems_keep_a_digest(spark):
    import hashlib

    name = "long name " * 12
    got = one(spark, text.safe_stem(F.col("t")), t=name)
    assert len(got) <= 60 and got.endswith("_" + hashlib.sha1(name.strip().encode()).hexdigest()[:10])


def test_titles(spark):
    assert one(spark, text.safe_title(F.col("t"), F.lit("f"), F.col("u")), t="A: B", u="10.1/x(y)") == "A_ B__10.1_x_y"
    assert one(spark, text.safe_title(F.col("t"), F.lit("f")), t="") == "f"
    assert one(spark, text.similarity(text.match_key(F.col("a")), text.match_key(F.col("b"))), a="On Räts!", b="on r ts") == 1.0
    assert one(spark, text.surnames(F.col("t")), t="J. Doe; Ann Lee and K. Doe") == ["doe", "lee"]


def test_identifiers(spark):
    t = F.col("t")
    assert one(spark, text.arxiv_id(t, F.lit("x/2101.00001v2.pdf")), t="none") == "2101.00001v2"
    assert one(spark, text.arxiv_doi(text.arxiv_id(t)), t="arXiv:2101.12345v3") == "10.48550/arXiv.2101.12345"
    assert one(spark, text.arxiv_id(t, old_style=True), t="arXiv:cond-mat/0101001") == "cond-mat/0101001"
    assert one(spark, text.doi(t), t="see 10.1000/abc.1).") == "10.1000/abc.1"
    assert one(spark, text.source_type(t), t="/d/ScienceDirect/x.pdf") == "elsevier"


def test_arxiv_numbers_are_whole(spark):
    t = F.col("t")
    assert one(spark, text.arxiv_id(t), t="arXiv 2401.100000 and") == "2401.100000"
    assert one(spark, text.arxiv_doi(text.arxiv_id(t)), t="arXiv:2401.129999v2") == "10.48550/arXiv.2401.129999"
    assert one(spark, text.arxiv_id(t, F.lit("x/2401.100000v2.pdf")), t="none") == "2401.100000v2"


@pytest.mark.parametrize(("message", "want"), [("model_not_available", "dedicated endpoint"), ("image input is not supported: not support", "vision"), ("Error 401", "key"), ("HTTP 429", "rate limit"), ("Timed out", "timeout"), ("else", "else")])
def test_errors(spark, message, want):
    assert one(spark, text.error_class(F.col("t")), t=message) == want


@pytest.mark.parametrize(("reply", "want"), [('x {"a": "}"} y', '{"a": "}"}'), ('{"a":1} {"b":2}', '{"a":1} {"b":2}'), ("none", ""), (r'r {"a": "\"}"} {', r'{"a": "\"}"}'), (None, "")])
def test_first_json(spark, reply, want):
    assert one(spark, text.first_json(F.col("t")), t=reply) == want


def test_unify(spark):
    assert one(spark, text.unify(text.nfkc(F.col("t"))), t="ﬁ­ne  −1 – 2") == "fine -1 - 2"
    assert one(spark, text.abstract(F.col("t")), t="Title\nAbstract: We measure.\nKeywords: x") == "We measure."
    assert one(spark, text.inferred_confidence(F.lit(None).cast("double"), F.col("t")), t="confidence of 0.4") == 0.4
    assert one(spark, text.redact(F.col("t"), {"KEY": "secret-value", "S": "short"}), t="a secret-value short") == "a <KEY redacted> short"


@pytest.mark.parametrize("name", ["SOFTWARE", "STRUCTURE", "ICDD", "PHASE", "WYCKOFF", "PEAK", "FWHM"])
def test_first_characters_leave_every_match(spark, name):
    """The look at the first character is there, and takes no match away: not of other cases, nor of letters that only fold to one of it."""
    pattern = getattr(fields, name)
    plain = re.sub(r"\(\?=\[?[^)]*\)", "", pattern, count=1)
    assert plain != pattern
    odd = "JANA2006 gsas-II fullprof suite, topas-academic xMAUD HighScore Plus ſpinel SPINEL quartZ α-fe2o3 Β-SIC γ-phase xrutile hcp FCC trigonal-cubic pdf 21-1276 JCPDS-21-1276 wyckoff Site: 4a, ٣a site 12j positions, 2THETA = 25 deg PEAK at 3.5° 2θ 7 deg fwhm 0.1 Full Width At Half Maximum = 2"
    both = [F.regexp_extract_all(F.lit(odd), F.lit(fields.either_case(p)), 0) for p in (pattern, plain)]
    got, want = spark.range(1).select(*(c.alias(n) for c, n in zip(both, "ab", strict=True))).first()
    assert got == want and got
