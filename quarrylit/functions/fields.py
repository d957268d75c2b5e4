"""Extractors of diffraction metadata: a registry of patterns and policies, compiled to one projection.

Every field is a native expression over the unified full text; a document costs one pass a
pattern and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import first_group

# The patterns that define the fields (case-insensitive unless the name ends in _CASED).  Those of several alternatives look
# at the first character before anything else: most places of a text end there, and matches stay the same.
TWO_THETA = r"(?:2θ|2theta|two\s*theta)\s*(?:=|from)?\s*(\d+(?:\.\d+)?)\s*(?:°|deg)?\s*(?:-|to)\s*(\d+(?:\.\d+)?)\s*(?:°|deg)?"
STEP = r"(?:step\s*(?:size|width)?|increment)\s*(?:=|:)?\s*(\d+(?:\.\d+)?)\s*(?:°|deg)"
RADIATION = r"\b(Cu|Mo|Co|Fe)\s*[- ]?\s*K\s*(?:α|a)\b"
WAVELENGTH = r"(?:λ|lambda)\s*(?:=|:)?\s*(\d+(?:\.\d+)?)\s*(?:Å|A)\b"
SOFTWARE = r"(?=[FGTMJH])\b(FullProf(?:\s*Suite)?|GSAS-?II|TOPAS(?:-Academic)?|MAUD|JANA2006|HighScore(?:\s*Plus)?)\b"
TEMPERATURE = r"\b(\d+(?:\.\d+)?)\s*(?:°C|C)\b"
STRUCTURE = r"(?=[bcfhmort])\b(fcc|bcc|hcp|cubic|tetragonal|orthorhombic|monoclinic|triclinic|trigonal|rhombohedral|hexagonal)\b"
SPACE_GROUP = r"\b(?:space\s*group\s*[:=]?\s*)?([PIFRCA]\s*[0-9]{1,3}(?:/[a-zA-Z0-9\-]+)?)\b"
EDGE = r"\b([abc])\s*=\s*(\d+(?:\.\d+)?)\s*(?:\((\d+)\))?\s*(?:Å|A|angstrom)\b"
ANGLE = r"\b(α|β|γ|alpha|beta|gamma)\s*=\s*(\d+(?:\.\d+)?)\s*(?:\((\d+)\))?\s*(?:°|deg)\b"
ICDD = r"(?=[IJP])\b(?:ICDD|JCPDS|PDF)[- #]*(\d{2}[-–]\d{3,4})\b"
PHASE = (
    r"\b(?=[abcdfghmpqrsvwzαβγ])(anatase|rutile|brookite|calcite|aragonite|vaterite|quartz|corundum|hematite|magnetite|goethite|wustite|ferrite|perovskite|spinel"
    r"|wurtzite|zincblende|halite|fluorite|pyrite|austenite|martensite|bainite|cementite|graphite|diamond"
    r"|α-Fe2O3|γ-Fe2O3|α-Al2O3|γ-Al2O3|β-SiC|α-SiC|α-phase|β-phase|γ-phase)\b"
)
PROFILE = r"\b(pseudo[- ]?Voigt|Voigt|Gaussian|Lorentzian|Pearson\s*VII|Thompson[- ]Cox[- ]Hastings|TCH|split[- ]?Pearson)\b"
UNITS_CASED = r"\bZ\s*=\s*(\d{1,3})\b"
FORMULA_CASED = r"\b([A-Z][a-z]?(?:\d*(?:\.\d+)?)(?:[A-Z][a-z]?(?:\d*(?:\.\d+)?)){1,8})\b"
ICSD = r"\bICSD\s*[#:\-]?\s*(\d{4,7})\b"
COD = r"\bCOD\s*[#:\-]?\s*(\d{5,7})\b"
MP = r"\b(mp-\d{1,7})\b"
DENSITY = r"(?:x[- ]?ray\s+density|ρ_?x|d_?x)\s*(?:=|:)\s*(\d+(?:\.\d+)?)\s*(?:g\s*/?\s*cm|Mg\s*/?\s*m)"
VOLUME = r"\b(?:V|V_?0|cell\s*volume|unit\s*cell\s*volume)\s*(?:=|:)\s*(\d+(?:\.\d+)?)\s*(?:\(\d+\))?\s*(?:Å3|Å³|A3|angstrom3|angstroms3|nm3)"
GROUP_NUMBER = r"(?:(?:space\s*group|SG)\s*(?:No\.?|number|#)\s*(\d{1,3})|(?:space\s*group\s*[:=]?\s*\S+)\s*\((\d{1,3})\))"
WEIGHT = r"(?:M(?:_?w)?|molecular\s*weight|formula\s*weight|molar\s*mass)\s*(?:=|:)\s*(\d+(?:\.\d+)?)\s*(?:g\s*/?\s*mol|g\s*mol|amu)?"
WYCKOFF = r"(?=[W\d])(?:Wyckoff\s+(?:position|site|symbol|notation|letter)s?\s*[:=]?\s*(\d{1,3}[a-zA-Z])|\b(\d{1,3}[a-j])\s+(?:site|position)s?\b)"
MILLER_CASED = r"\((?<!\d\()(?:\s*(\d)\s+(\d)\s+(\d)\s*\)|([0-9])([0-9])([0-9])\)(?!\d))"
PEAK = r"(?=[2p])(?:2θ|2theta|peak)\s*(?:=|at|:)?\s*(\d{1,3}(?:\.\d+)?)\s*(?:°|deg)"
FWHM = r"(?=F)(?:FWHM|full\s*width\s*at\s*half\s*max(?:imum)?)\s*(?:=|:)?\s*(\d+(?:\.\d+)?)\s*(?:°|deg)?"
FIGURE = r"(fig\.|figure)\s*(\d+)\s*[:.\-]?\s*"
SI_HEADING = r"(?:^|\n)\s*(?:S(?:upporting|upplementary)\s+(?:Information|Materials?|Data|Figures?|Tables?)|(?:Appendix|ESI|SI)\b|S\d+\.\s)[^\n]{0,120}"
SI_FIGURE = r"\b(?:(?:Fig(?:ure)?|Table)\s*S\d+|(?:S(?:upplementary|upporting)\s+(?:Fig|Table))\s*\d+)"
#: The unit that cell volumes are given, as it is written.
VOLUME_UNIT = " ų"


def either_case(pattern: str) -> str:
    return "(?U)(?i)" + pattern


def cased(pattern: str) -> str:
    return "(?U)" + pattern


def _all(t: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(t, F.lit(pattern), group)


def _once(value: Column, made: Callable[[Column], Column]) -> Column:
    """made(value), with the value made once however often it is asked for: an array of one."""
    return F.transform(F.array(value), made)[0]


def _matches(t: Column, pattern: str, made: Callable[[Column], Column]) -> Column:
    """made(match) of every match: the text is gone through once, whatever is then taken from a match."""
    return F.transform(_all(t, pattern, 0), made)


def _either(match: Column, pattern: str, *groups: int) -> Column:
    """The first of the groups that took part in a match."""
    return F.coalesce(*(first_group(match, pattern, g) for g in groups), F.lit(""))


def _sorted(values: Column, most: int | None = None) -> Column:
    out = F.array_sort(F.array_distinct(values))
    return F.slice(out, 1, most) if most else out


def _with_unit(value: Column, unit: str) -> Column:
    return F.coalesce(F.concat(value, F.lit(unit)), F.lit(""))


def float_text(x: Column) -> Column:
    """A double as the shortest decimal text, with a fraction always."""
    return x.cast("double").cast("string")


def last_per_key(pairs: Column) -> Column:
    """A map of each key's last value, of an array of (k, v)."""

    def made(back: Column) -> Column:
        keys = F.array_distinct(back["k"])
        return F.map_from_entries(F.reverse(F.transform(keys, lambda k: F.struct(k, F.element_at(back["v"], F.array_position(back["k"], k).cast("int"))))))

    return _once(F.reverse(pairs), made)


def formula_mode(t: Column) -> Column:
    """The most frequent formula of 4 characters or more with a digit, the first seen of equally frequent ones."""
    found = F.filter(_all(t, cased(FORMULA_CASED)), lambda x: (F.length(x) >= 4) & x.rlike("[0-9]"))
    seen = F.array_sort(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("at"))))  # equal ones together, the first seen first
    mode = lambda n, at, x: F.struct(n.alias("n"), at.alias("at"), x.alias("x"))

    def count(run: Column, one: Column) -> Column:
        same = run["now"]["x"] == one["x"]
        now = mode(F.when(same, run["now"]["n"] - 1).otherwise(-1), F.when(same, run["now"]["at"]).otherwise(one["at"]), one["x"])
        return _once(now, lambda r: F.struct(r.alias("now"), F.least(run["best"], r).alias("best")))

    none = mode(F.lit(0), F.lit(0), F.lit(""))
    return F.coalesce(F.aggregate(seen, F.struct(none.alias("now"), none.alias("best")), count)["best"]["x"], F.lit(""))


def extractors(t: Column) -> dict[str, Column]:
    """The 22 fields of a unified text; absence is an empty string, list or map."""
    ci = either_case
    element = first_group(t, ci(RADIATION))
    wave = first_group(t, ci(WAVELENGTH))
    step = first_group(t, ci(STEP))
    number = F.coalesce(first_group(t, ci(GROUP_NUMBER), 1), first_group(t, ci(GROUP_NUMBER), 2))
    said = lambda m, p, unit: F.concat(F.regexp_extract(m, p, 2), F.coalesce(F.concat(F.lit("("), first_group(m, p, 3), F.lit(")")), F.lit("")), F.lit(unit)).alias("v")
    edges = _matches(t, ci(EDGE), lambda m: F.struct(F.lower(F.regexp_extract(m, ci(EDGE), 1)).alias("k"), said(m, ci(EDGE), " Å")))
    greek = F.create_map(*(F.lit(x) for kv in (("alpha", "α"), ("beta", "β"), ("gamma", "γ")) for x in kv))
    named = lambda m: F.lower(F.regexp_extract(m, ci(ANGLE), 1))
    angles = _matches(t, ci(ANGLE), lambda m: F.struct(F.coalesce(greek[named(m)], named(m)).alias("k"), said(m, ci(ANGLE), "°")))
    peaks = F.filter(F.transform(_all(t, ci(PEAK)), lambda x: x.cast("double")), lambda x: x.between(5, 120))
    hkl = _matches(t, MILLER_CASED, lambda m: F.concat(F.lit("("), F.regexp_replace(m, "[^0-9]", ""), F.lit(")")))
    return {
        "scan_range_2theta": F.coalesce(F.concat(first_group(t, ci(TWO_THETA), 1), F.lit("–"), first_group(t, ci(TWO_THETA), 2), F.lit("° 2θ")), F.lit("")),
        "step_size": _with_unit(step, "°"),
        "radiation": F.when(element.isNull(), "").otherwise(F.concat(element, F.lit("-Kα"), F.coalesce(F.concat(F.lit(" (λ="), wave, F.lit(" Å)")), F.lit("")))),
        "radiation_wavelength": _with_unit(wave, " Å"),
        "software": _sorted(_all(t, ci(SOFTWARE))),
        "context_temperature": F.transform(_sorted(_all(t, ci(TEMPERATURE))), lambda x: F.concat(x, F.lit(" °C"))),
        "crystal_structure": _sorted(F.transform(_all(t, ci(STRUCTURE)), lambda x: F.lower(x))),
        "space_group": _sorted(F.transform(_all(t, ci(SPACE_GROUP)), lambda x: F.trim(x))),
        "space_group_number": F.when(number.try_cast("int").between(1, 230), number).otherwise(""),
        "lattice_parameters": F.map_concat(last_per_key(edges), last_per_key(angles)),
        "reported_phases": _sorted(F.concat(F.transform(_all(t, ci(ICDD)), lambda x: F.concat(F.lit("ICDD "), x)), _all(t, ci(PHASE)))),
        "profile_function": F.coalesce(first_group(t, ci(PROFILE)), F.lit("")),
        "peak_positions_2theta": F.transform(_sorted(peaks, 30), lambda x: F.concat(float_text(x), F.lit("°"))),
        "fwhm": F.transform(_sorted(_all(t, ci(FWHM)), 10), lambda x: F.concat(x, F.lit("°"))),
        "formula_units_Z": F.coalesce(first_group(t, cased(UNITS_CASED)), F.lit("")),
        "chemical_formula": formula_mode(t),
        "database_refs": _sorted(F.concat(F.transform(_all(t, ci(ICSD)), lambda x: F.concat(F.lit("ICSD "), x)), F.transform(_all(t, ci(COD)), lambda x: F.concat(F.lit("COD "), x)), _all(t, ci(MP)))),
        "xray_density": _with_unit(first_group(t, ci(DENSITY)), " g/cm³"),
        "cell_volume": _with_unit(first_group(t, ci(VOLUME)), VOLUME_UNIT),
        "formula_weight": _with_unit(first_group(t, ci(WEIGHT)), " g/mol"),
        "wyckoff_positions": _sorted(_matches(t, ci(WYCKOFF), lambda m: _either(m, ci(WYCKOFF), 1, 2)), 20),
        "miller_indices": _sorted(hkl, 30),
    }


def extract(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the 22 fields."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select("*", *(c.alias(k) for k, c in extractors(t).items()))


def supporting_pages(pages: DataFrame) -> DataFrame:
    """Per document: pages of supporting information, and up to 20 references to its figures, in page order."""
    ci = either_case
    rows = pages.select("doc_id", "page", F.col("text").rlike(ci(SI_HEADING)).alias("si"), F.transform(F.regexp_extract_all("text", F.lit(ci(SI_FIGURE)), 0), lambda x: F.trim(x)).alias("refs"))
    grouped = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("si"), F.col("page")))).alias("si_pages"), F.array_sort(F.collect_list(F.struct("page", "refs"))).alias("r"))
    refs = F.flatten(F.transform("r", lambda p: F.transform(p["refs"], lambda x: F.struct(p["page"].alias("page"), x.alias("ref")))))
    return grouped.select("doc_id", "si_pages", F.slice(refs, 1, 20).alias("si_figure_refs"), (F.size("si_pages") > 0).alias("has_si_section"))
