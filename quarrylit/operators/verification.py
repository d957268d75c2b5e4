"""Verification of blocks of fields: rounds of questions about what is open, deterministic checks after them, results and logs.

A block is the fields of one scope of a document (its methods, a figure); a field is a row, its values JSON texts, so that a list, a
map and a number stay what they are.  Each round asks only about the fields that no reply has settled; the number of rounds is
bounded, and what is open then is unclear.  Checks of space group, cell and wavelength then take support away, with the reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylit.functions.text import leading_number
from quarrylit.operators import validate
from quarrylit.operators.records import wavelength_of

BLOCK = ["doc_id", "scope"]
#: Rounds of questions at most.
ROUNDS = 6
_SETTLED = ("supported", "unsupported")


# ---- values as JSON texts ---------------------------------------------------------------------------------------------


def _variant(json: Column) -> Column:
    return F.try_parse_json(json)


def strings(json: Column) -> Column:
    """The texts, trimmed and not empty, of a value that is a text or a list; other values have none."""
    v = _variant(json)
    kind = F.schema_of_variant(v)
    items = F.when(kind == "STRING", F.array(v)).when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>"))
    own = F.transform(F.filter(items, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False))), lambda x: F.trim(F.try_variant_get(x, "$", "string")))
    return F.coalesce(F.filter(own, lambda s: s != ""), F.array().cast("array<string>"))


def text(json: Column) -> Column:
    """The first of a value's texts, empty without any."""
    return F.coalesce(F.get(strings(json), F.lit(0)), F.lit(""))


def group_number(json: Column) -> Column:
    """The group number, 1 to 230, that a number, a text or a list's first entry with one states; 0 without."""

    def one(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        number = F.when(kind == "BIGINT", F.try_variant_get(v, "$", "int")).when(kind == "STRING", F.regexp_extract(F.try_variant_get(v, "$", "string"), r"\d+", 0).try_cast("int"))
        return F.when(number.between(1, 230), number).otherwise(0)

    v = _variant(json)
    kind = F.schema_of_variant(v)
    items = F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
    return F.coalesce(F.get(F.filter(F.transform(items, one), lambda n: n > 0), F.lit(0)), F.lit(0))


def final_value(candidate: Column, corrected: Column) -> Column:
    """The corrected value, whatever its type, but for an empty text, an empty list and null."""
    bare = F.regexp_replace(F.coalesce(corrected, F.lit("null")), r"^\s+|\s+$", "")
    return F.when(bare.isin('""', "null") | bare.rlike(r"^\[\s*\]$"), candidate).otherwise(corrected)


# ---- rounds -------------------------------------------------------------------------------------------------------------


def asked(fields: DataFrame, contexts: DataFrame, ask: Callable[[DataFrame], DataFrame], folder: str, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, scope, field, candidate, status, corrected, evidence, round) of every field (doc_id, scope, field, candidate).

    `ask` gets requests (doc_id, scope, context, fields: an array of field and candidate by name) and gives replies (doc_id, scope,
    field, status, corrected, evidence), of as many of the fields as it likes; statuses other than the three are unclear, and replies to
    fields that weren't asked about are not read.  Rounds are tables in `folder`, so each is computed once and lineage stays short."""
    spark = fields.sparkSession
    open_ = fields.select(*BLOCK, "field", "candidate").withColumn("round", F.lit(0))
    empty = ["unclear" if c == "status" else "" if c == "evidence" else None for c in ("status", "corrected", "evidence")]
    for name, value in zip(("status", "corrected", "evidence"), empty, strict=True):
        open_ = open_.withColumn(name, F.lit(value).cast("string"))
    parts: list[DataFrame] = []
    for n in range(1, rounds + 1):
        requests = open_.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("field", "candidate"))).alias("fields"))  # a block's fields
        replies = ask(requests.join(contexts.select(*BLOCK, "context"), BLOCK, "left"))
        status = F.when(F.col("status").isin(*_SETTLED), F.col("status")).otherwise("unclear")
        said = replies.groupBy(*BLOCK, "field").agg(F.first(F.struct(status.alias("status"), F.col("corrected").alias("corrected"), F.coalesce("evidence", F.lit("")).alias("evidence"))).alias("said"))
        now = open_.join(said, [*BLOCK, "field"], "left").select(
            *BLOCK, "field", "candidate", F.when(F.col("said").isNotNull(), n).otherwise(F.col("round")).alias("round"), *(F.when(F.col("said").isNotNull(), F.col(f"said.{c}")).otherwise(F.col(c)).alias(c) for c in ("status", "corrected", "evidence"))
        )
        now.write.parquet(f"{folder}/round-{n}")
        now = spark.read.parquet(f"{folder}/round-{n}")
        parts.append(now.where(F.col("status").isin(*_SETTLED)))
        open_ = now.where(~F.col("status").isin(*_SETTLED))
        if open_.isEmpty():
            break
    out = open_
    for p in parts:
        out = out.unionByName(p)
    return out.select(*BLOCK, "field", "candidate", "status", "corrected", "evidence", "round")


# ---- checks -------------------------------------------------------------------------------------------------------------


def _number(c: Column) -> Column:
    return F.when(c == c.cast("long"), F.concat(c.cast("long").cast("string"), F.lit(".0"))).otherwise(c.cast("string"))


def lattice_notes(system: Column, cell: dict[str, Column]) -> Column:
    """What a cell breaks of its system's rules, in words and in a fixed order."""
    v = {k: leading_number(cell[k]) for k in ("a", "b", "c", "alpha", "beta", "gamma")}
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else _number(p) for p in parts))
    apart, is_ = validate._apart, lambda *names: system.isin(*names)
    notes = [F.when(v[k].isNotNull() & ((v[k] <= 0) | (v[k] > validate.MOST_EDGE)), said(f"lattice {k}=", v[k], " is non-physical (expected 0 < edge < 100 Å)")) for k in "abc"]
    ab, bc = apart(v["a"], v["b"], validate.TOL_EDGE), apart(v["b"], v["c"], validate.TOL_EDGE)
    for s in ("cubic", "tetragonal", "hexagonal"):
        notes.append(F.when(is_(s) & ab, said(f"{s} requires a=b, got a=", v["a"], ", b=", v["b"])))
    notes.append(F.when(is_("cubic") & bc, said("cubic requires b=c, got b=", v["b"], ", c=", v["c"])))
    right = {"cubic": ("alpha", "beta", "gamma"), "tetragonal": ("alpha", "beta", "gamma"), "hexagonal": ("alpha", "beta"), "orthorhombic": ("alpha", "beta", "gamma"), "monoclinic": ("alpha", "gamma")}
    for s, angles in right.items():
        notes += [F.when(is_(s) & apart(v[k], F.lit(90.0), validate.TOL_ANGLE), said(f"{s} requires {k}=90, got ", v[k])) for k in angles]
    wide = apart(v["gamma"], F.lit(120.0), validate.TOL_ANGLE)
    notes.append(F.when(is_("hexagonal") & wide, said("hexagonal requires gamma=120, got ", v["gamma"])))
    unlike = apart(v["alpha"], v["beta"], validate.TOL_ANGLE)
    rhombohedral = ab | bc | unlike | apart(v["beta"], v["gamma"], validate.TOL_ANGLE)
    notes.append(F.when(is_("trigonal") & (ab | wide) & rhombohedral, F.lit("trigonal requires either hexagonal axes (a=b, gamma=120) or rhombohedral axes (a=b=c, alpha=beta=gamma)")))
    notes.append(F.when(is_("rhombohedral") & ab, said("rhombohedral requires a=b=c, got a=", v["a"], ", b=", v["b"])))
    notes.append(F.when(is_("rhombohedral") & bc, said("rhombohedral requires a=b=c, got b=", v["b"], ", c=", v["c"])))
    notes.append(F.when(is_("rhombohedral") & unlike, said("rhombohedral requires alpha=beta=gamma, got alpha=", v["alpha"], ", beta=", v["beta"])))
    return F.array_compact(F.array(*notes))


def _symbol(c: Column) -> Column:
    return F.trim(F.replace(F.translate(c, "−–—", "---"), F.lit("‾"), F.lit("")))


def wavelength_note(radiation: Column, wavelength: Column) -> Column:
    """Why a stated wavelength can't be its label's, null where it can."""
    got = validate.wavelength_check(radiation, wavelength)
    low = F.lower(wavelength)
    nanometres = F.contains(low, F.lit("nm")) & ~F.contains(low, F.lit("pm"))
    stated = leading_number(wavelength)
    real = F.when(nanometres & (stated < 0.35), F.round(stated * 10, 10)).otherwise(stated)
    again = validate.wavelength_check(radiation, F.when(nanometres & (stated < 0.35), real.cast("string")).otherwise(wavelength))
    nearest = F.create_map(*(x for e, ws in validate.WAVELENGTHS.items() for x in (F.lit(e), F.create_map(*(y for k, w in zip(validate.LINES, ws, strict=True) for y in (F.lit(k), F.lit(w)))))))[again["element"]][again["nearest_line"]]
    too_large = F.concat(F.lit("Wavelength looks mislabeled: X-ray wavelengths are ~0.5-2.5 Å (0.05-0.25 nm); '"), wavelength, F.lit("' is ~10x too large for nm."))
    mislabeled = F.concat(F.lit("Value "), _number(real), F.lit(" matches "), F.upper(again["element"]), F.lit(" "), again["nearest_line"], F.lit(" ("), _number(nearest), F.lit("), not "), again["line"], F.lit(" ("), _number(again["expected"]), F.lit(")"))
    unknown = F.lit("Reported wavelength does not match any known line for this source")
    return F.when(got["status"] == "no_wavelength", None).when(nanometres & (stated >= 0.35), too_large).when(again["status"] == "MISLABELED", mislabeled).when(again["status"].isin("MISMATCH", "UNIT_ERROR"), unknown)


def post_checked(verdicts: DataFrame, symbols: dict[str, int]) -> DataFrame:
    """The verdicts after the checks of each block; what was supported and can't be is unsupported, with the reason as evidence.

    Only a block that names exactly one crystal system is held against it.  A group's number counts before its symbol, which `symbols`
    resolves: as written, else without _, - and spaces in either case.  One shuffle by block; a block has some twenty fields."""
    rows = verdicts.groupBy(*BLOCK).agg(F.collect_list(F.struct("field", "candidate", "status", "corrected", "evidence", "round")).alias("rows"))
    of = lambda name: F.get(F.filter("rows", lambda r: r["field"] == name), F.lit(0))["candidate"]
    rows = rows.select("*", *(of(n).alias(n) for n in ("space_group", "space_group_number", "crystal_structure", "lattice_parameters", "radiation", "radiation_wavelength")))
    rows = rows.withColumn("systems", validate.systems_of(strings(F.col("crystal_structure")))).withColumn("groups", strings(F.col("space_group")))
    rows = rows.withColumn("system", F.when(F.size("systems") == 1, F.col("systems")[0])).withColumn("symbol", F.when(F.size("groups") == 1, _symbol(F.col("groups")[0])).otherwise(""))
    known = F.create_map(*(F.lit(x) for kv in symbols.items() for x in kv)) if symbols else F.create_map().cast("map<string,int>")
    flat: dict[str, int] = {}
    for k, n in symbols.items():
        flat.setdefault(k.lower().translate(str.maketrans("", "", "_- ")), n)
    loose = F.create_map(*(F.lit(x) for kv in flat.items() for x in kv)) if flat else known
    rows = rows.withColumn("number", F.coalesce(F.nullif(group_number(F.col("space_group_number")), F.lit(0)), known[F.col("symbol")], loose[validate.normal_symbol(F.col("symbol"))]))
    own = validate.system_of_number(F.col("number"))
    contradicts = F.col("system").isNotNull() & (validate.space_group_check(F.col("number"), F.col("system")) == "CONTRADICTION")
    group_note = F.when(contradicts, F.concat("symbol", F.lit(" (#"), F.col("number").cast("string"), F.lit(") belongs to "), own, F.lit(", not "), "system"))
    is_map = F.startswith(F.schema_of_variant(_variant(F.col("lattice_parameters"))), F.lit("OBJECT"))
    text_of = lambda k: F.when(F.schema_of_variant(F.try_variant_get(_variant(F.col("lattice_parameters")), f"$.{k}", "variant")) == "STRING", F.try_variant_get(_variant(F.col("lattice_parameters")), f"$.{k}", "string"))
    notes = lattice_notes(F.col("system"), {k: text_of(k) for k in ("a", "b", "c", "alpha", "beta", "gamma")})
    lattice_note = F.when(is_map & F.col("system").isNotNull() & (F.size(notes) > 0), F.array_join(notes, "; "))
    label = text(F.col("radiation"))
    stated = F.coalesce(F.nullif(text(F.col("radiation_wavelength")), F.lit("")), wavelength_of(label))
    wave_note = F.when((label != "") & (stated != ""), wavelength_note(label, stated))
    rows = rows.withColumn("group_note", group_note).withColumn("lattice_note", lattice_note).withColumn("wave_note", wave_note)
    out = rows.select(*BLOCK, "group_note", "lattice_note", "wave_note", F.explode("rows").alias("r"))
    field = F.col("r.field")
    note = F.when(field.isin("space_group", "crystal_structure"), F.col("group_note")).when(field == "lattice_parameters", F.col("lattice_note")).when(field.isin("radiation", "radiation_wavelength"), F.col("wave_note"))
    fails = (F.col("r.status") == "supported") & note.isNotNull()
    return out.select(*BLOCK, field.alias("field"), F.col("r.candidate").alias("candidate"), F.when(fails, "unsupported").otherwise(F.col("r.status")).alias("status"), F.col("r.corrected").alias("corrected"), F.when(fails, F.concat(F.lit("POST-FINALIZE: "), note)).otherwise(F.col("r.evidence")).alias("evidence"), F.col("r.round").alias("round"))


def blocks(verdicts: DataFrame) -> DataFrame:
    """Per block what is kept and both halves of its log: final (field to value, of what is supported or unclear), verified and
    unverified (field to candidate, corrected, evidence and status)."""
    entry = F.struct("field", F.struct(F.col("candidate").alias("candidate_value"), F.col("corrected").alias("corrected_value"), F.col("evidence").alias("evidence_span"), "status").alias("entry"))
    rows = verdicts.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    log = lambda yes: F.map_from_entries(F.filter("rows", lambda r: (r["entry"]["status"] == "supported") == yes))
    kept = F.filter("rows", lambda r: r["entry"]["status"].isin("supported", "unclear"))
    final = F.map_from_entries(F.transform(kept, lambda r: F.struct(r["field"], final_value(r["entry"]["candidate_value"], r["entry"]["corrected_value"]))))
    return rows.select(*BLOCK, final.alias("final"), log(True).alias("verified"), log(False).alias("unverified"))
