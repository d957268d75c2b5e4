"""Crystallographic checks: groups, systems, cells, wavelengths.  All are expressions without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylit.functions.text import leading_number

# The last space-group number of each crystal system.
SYSTEM_LAST = {"triclinic": 2, "monoclinic": 15, "orthorhombic": 74, "tetragonal": 142, "trigonal": 167, "hexagonal": 194, "cubic": 230}
# Characteristic lines in angstrom (ka1, ka2, ka, kb).
WAVELENGTHS = {
    "cu": (1.5406, 1.5444, 1.5418, 1.3922), "mo": (0.7093, 0.7136, 0.7107, 0.6323), "co": (1.7890, 1.7929, 1.7902, 1.6208), "fe": (1.9360, 1.9400, 1.9373, 1.7566),
    "cr": (2.2897, 2.2936, 2.2909, 2.0849), "ag": (0.5594, 0.5638, 0.5608, 0.4970), "w": (0.2090, 0.2136, 0.2104, 0.1844), "ni": (1.6579, 1.6617, 1.6592, 1.5001),
    "mn": (2.1018, 2.1058, 2.1031, 1.9102), "ti": (2.7496, 2.7522, 2.7505, 2.5139), "ga": (1.3401, 1.3440, 1.3414, 1.2079), "in": (0.5121, 0.5163, 0.5135, 0.4551),
}
LINES = ("ka1", "ka2", "ka", "kb")
# Structure words of each crystal system, besides the systems' own names.
STRUCTURES = {
    "cubic": ("fcc", "face centered cubic", "face centred cubic", "bcc", "body centered cubic", "body centred cubic", "sc", "simple cubic", "primitive cubic", "diamond", "diamond cubic", "isometric", "rocksalt", "rock salt", "halite", "nacl", "zincblende", "zinc blende", "sphalerite", "fluorite", "antifluorite", "spinel", "perovskite", "garnet", "pyrochlore", "bixbyite"),
    "hexagonal": ("hcp", "hexagonal close packed", "wurtzite", "graphite"),
    "tetragonal": ("anatase", "rutile", "scheelite"),
    "orthorhombic": ("brookite", "aragonite", "brownmillerite", "olivine"),
}
SYSTEMS = ("cubic", "tetragonal", "orthorhombic", "hexagonal", "trigonal", "rhombohedral", "monoclinic", "triclinic")
TOL_EDGE, TOL_ANGLE, TOL_WAVE, MOST_EDGE = 0.02, 0.5, 0.002, 100.0


def system_of_number(n: Column) -> Column:
    """The crystal system of a space-group number, empty outside 1 to 230."""
    out = F.when(n.isNull() | ~n.between(1, 230), "")
    for system, last in SYSTEM_LAST.items():
        out = out.when(n <= last, system)
    return out


def normal_symbol(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[_ -]", ""))


def number_of_symbol(rows: DataFrame, table: DataFrame, symbol: str = "symbol") -> DataFrame:
    """The rows with space_group_number by a table (symbol, number, seq): the symbol as written, else without _, - and spaces
    in either case, the first such entry.  Spark broadcasts the table if it is as small as it should be."""
    exact = table.select(F.col("symbol").alias("__exact"), F.col("number").alias("__n1"))
    loose = table.groupBy(normal_symbol(F.col("symbol")).alias("__loose")).agg(F.min_by("number", "seq").alias("__n2"))
    out = rows.join(exact, F.col(symbol) == F.col("__exact"), "left").join(loose, normal_symbol(F.col(symbol)) == F.col("__loose"), "left")
    return out.withColumn("space_group_number", F.coalesce("__n1", "__n2")).drop("__exact", "__n1", "__loose", "__n2")


def normal_system(words: Column) -> Column:
    """The crystal system that a structure description names: as a whole, by a system's name among its words, by a structure's
    name inside it, in a fixed order each; a description that names none stays as it is, in small letters."""
    low = F.trim(F.regexp_replace(F.translate(F.lower(F.coalesce(words, F.lit(""))), "-", " "), r"\s+", " "))

    def system(v: Column) -> Column:
        table = [(w, s) for s, ws in STRUCTURES.items() for w in ws]
        whole = F.create_map(*(F.lit(x) for kv in table for x in kv))[v]
        tokens = F.split(v, " ")
        named = [F.when(F.array_contains(tokens, s), s) for s in SYSTEMS]
        inside = [F.when(F.contains(v, F.lit(w)) if " " in w else F.array_contains(tokens, w), s) for w, s in table]
        return F.coalesce(whole, *named, *inside, v)

    return F.transform(F.array(low), system)[0]


def systems_of(values: Column) -> Column:
    """The distinct systems of a list of descriptions, in order."""
    return F.array_distinct(F.filter(F.transform(values, normal_system), lambda s: s != ""))


def _apart(a: Column, b: Column, tolerance: float) -> Column:
    """Both are given, and differ."""
    return F.coalesce((a != 0) & (b != 0) & (F.abs(a - b) > tolerance), F.lit(False))


def lattice_issues(system: Column, cell: dict[str, Column]) -> Column:
    """Names of the rules that a cell (a, b, c, alpha, beta, gamma as texts) breaks, in a fixed order."""
    v = {k: leading_number(cell[k]) if k in cell else F.lit(None).cast("double") for k in ("a", "b", "c", "alpha", "beta", "gamma")}
    issues = [F.when(v[k].isNotNull() & ((v[k] <= 0) | (v[k] > MOST_EDGE)), f"{k} non-physical") for k in "abc"]
    ab, bc = _apart(v["a"], v["b"], TOL_EDGE), _apart(v["b"], v["c"], TOL_EDGE)
    is_ = lambda *names: system.isin(*names)
    off = lambda k, x: _apart(v[k], F.lit(x), TOL_ANGLE)
    issues.append(F.when(is_("cubic", "tetragonal", "hexagonal") & ab, "a=b"))
    issues.append(F.when(is_("cubic") & bc, "b=c"))
    for k, systems in (("alpha", ("cubic", "tetragonal", "hexagonal", "orthorhombic", "monoclinic")), ("beta", ("cubic", "tetragonal", "hexagonal", "orthorhombic")), ("gamma", ("cubic", "tetragonal", "orthorhombic", "monoclinic"))):
        issues.append(F.when(is_(*systems) & off(k, 90.0), f"{k}=90"))
    issues.append(F.when(is_("hexagonal") & off("gamma", 120.0), "gamma=120"))
    angles = [_apart(v["alpha"], v["beta"], TOL_ANGLE), _apart(v["beta"], v["gamma"], TOL_ANGLE)]
    issues.append(F.when(is_("trigonal") & (ab | off("gamma", 120.0)) & (ab | bc | angles[0] | angles[1]), "either trigonal setting"))
    issues.append(F.when(is_("rhombohedral") & (ab | bc), "a=b=c"))
    issues.append(F.when(is_("rhombohedral") & angles[0], "alpha=beta=gamma"))
    return F.array_compact(F.array(*issues))


def lattice_check(system: Column, cell: dict[str, Column]) -> Column:
    issues = lattice_issues(system, cell)
    return F.struct(F.when(F.size(issues) == 0, "consistent").otherwise("VIOLATION").alias("status"), issues.alias("issues"))


def wavelength_check(radiation: Column, wavelength: Column) -> Column:
    """The status of a stated wavelength against the element and line of its label.

    The element is the first of the table, in its order, that the label holds; the line the first of LINES
    (ka without one).  Below 0.3 a wavelength ten times as large that fits is a nanometre."""
    label = F.trim(F.translate(F.lower(F.coalesce(radiation, F.lit(""))), "αβ", "ab"))
    element = F.coalesce(*(F.when(F.contains(label, F.lit(e)), e) for e in WAVELENGTHS))
    flat = F.regexp_replace(label, r"[\s\-_]", "")
    line = F.coalesce(*(F.when(F.contains(flat, F.lit(k)), k) for k in LINES), F.lit("ka"))
    stated = leading_number(wavelength)
    table = F.create_map(*(x for e, ws in WAVELENGTHS.items() for x in (F.lit(e), F.create_map(*(y for k, w in zip(LINES, ws, strict=True) for y in (F.lit(k), F.lit(w)))))))
    own = table[element]
    expected = own[line]
    near = lambda x, y: F.abs(x - y) <= TOL_WAVE
    nearest = F.array_min(F.transform(F.array(*(F.lit(k) for k in LINES)), lambda k: F.struct(F.abs(own[k] - stated).alias("by"), k.alias("line"))))
    status = F.when(stated.isNull() | (stated == 0), "no_wavelength").when(element.isNull(), "unknown_source").when(near(stated, expected), "consistent").when((stated < 0.3) & near(stated * 10, expected), "UNIT_ERROR").when(nearest["by"] <= TOL_WAVE, "MISLABELED").otherwise("MISMATCH")
    return F.struct(status.alias("status"), element.alias("element"), line.alias("line"), expected.alias("expected"), stated.alias("stated"), nearest["line"].alias("nearest_line"))


def space_group_check(number: Column, system: Column) -> Column:
    """error / unresolved / resolved / consistent / CONTRADICTION of a group's number and a stated system."""
    own = system_of_number(number)
    fits = (own == system) | ((own == "trigonal") & (system == "rhombohedral"))
    return F.when(number.isNotNull() & (own == ""), "error").when(number.isNull(), "unresolved").when(F.coalesce(system, F.lit("")) == "", "resolved").when(fits, "consistent").otherwise("CONTRADICTION")


def post_check(status: Column, failures: list[Column]) -> Column:
    """A supported verdict is unsupported once a deterministic check fails."""
    failed = reduce(lambda a, b: a | b, failures)
    return F.when((status == "supported") & failed, "unsupported").otherwise(status)
