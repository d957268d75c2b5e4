"""Record cleaning: titles, materials, slim figure records, guards on files, traces, path lookups, counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylit.functions.text import nfkc

# The patterns of a material's name in order of preference, and what is no material.
MATERIALS = (
    r"\b([A-Z][a-z]?(?:\d+[A-Za-z0-9\-]*)?(?:\s+[A-Z][a-z]?(?:\d+[A-Za-z0-9\-]*)?)*)\s+(?:alloy|alloys|nanoparticles|thin films|film|powder|ceramics|ceramic|oxide|oxides|composite|composites|system|systems)\b",
    r"\b([A-Z][a-z]?(?:[-/][A-Z][a-z]?)+(?:\s*[A-Za-z0-9\-]+)?)\b",
    r"\b([A-Z][a-z]?\d*[A-Za-z0-9\-]*(?:/[A-Z][a-z]?\d*[A-Za-z0-9\-]*)+)\b",
    r"\b([A-Z][a-z]?(?:\d+[A-Za-z0-9\-]*)?(?:[A-Z][a-z]?(?:\d+[A-Za-z0-9\-]*)?){1,5})\b",
)
NO_MATERIAL = ("XRD", "PXRD", "PDF", "DOI", "TEM", "SEM", "XPS", "Rietveld", "Cu K", "Mo K", "Kα", "K a", "AI", "ML")
# Words that a title does not end with, headings and institutions that end it.
OPEN_WORDS = ("in", "of", "for", "with", "by", "and", "or", "the", "a", "an", "on", "at", "to", "from")
AFTER_TITLE = r"^(?:abstract|keywords?|introduction)\b|^summary$|\b(?:university|department|institute|school|laboratory)\b"
# Bounds of a crop's share of the page, least bytes of a downloaded file, marks of a trace's observations.
SHARE, FILE_BYTES, OBSERVATION = (0.01, 0.90), 50_000, {"report": 400, "record": 500, "agent": 2000}
_LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"


def _squeezed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def _first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _once(value: Column, made: Callable[[Column], Column]) -> Column:
    """made(value), with the value made once however often it is asked for: an array of one."""
    return F.transform(F.array(value), made)[0]


def uniq_clean(items: Column) -> Column:
    """The first spelling of each entry, squeezed, whatever its case; without empty ones."""
    clean = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), _squeezed), lambda s: s != "")
    return _once(clean, lambda c: _once(F.transform(c, F.lower), lambda lower: F.filter(c, lambda s, i: F.array_position(lower, lower[i]) == i + 1)))


# ---- titles and materials -------------------------------------------------------------------------------------


def text_title(text: Column, most: int = 500) -> Column:
    """The title at a text's head: the first line of 20 characters or more among the first 20, that is no identifier and
    no short run of words, with up to four more lines while it ends with an open word; empty without any."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), _LINE_BREAK), _squeezed), lambda s: s != "")
    words = lambda s: F.size(F.split(s, " "))
    begins = lambda s: ~F.lower(s).rlike("^(?:arxiv:|doi)") & ~(s.rlike("^[A-Za-z ,.-]+$") & (words(s) <= 6)) & (F.length(s) >= 20)

    def grow(acc: Column, line: Column) -> Column:
        low = F.lower(line)
        stop = acc["over"] | low.rlike(AFTER_TITLE) | F.contains(line, F.lit("@")) | (F.size(F.split(line, ",")) >= 4) | (F.length(line) < 3)
        now = F.when(stop, acc["title"]).otherwise(F.concat(acc["title"], F.lit(" "), line))
        last = F.lower(F.element_at(F.split(F.regexp_replace(now, "[.,;:]+$", ""), " "), -1))
        return F.struct((stop | ~last.isin(*OPEN_WORDS)).alias("over"), now.alias("title"))

    def title(x: Column) -> Column:
        at = F.get(F.filter(F.sequence(F.lit(0), F.lit(19)), lambda i: F.coalesce(begins(F.get(x, i)), F.lit(False))), F.lit(0))
        return F.when(at.isNull(), F.lit("")).otherwise(F.aggregate(F.slice(x, at + 2, 4), F.struct(F.lit(False).alias("over"), F.get(x, at).alias("title")), grow)["title"])

    return F.substring(_first(F.transform(F.array(lines), title)), 1, most)


def longer_title(metadata: Column, from_text: Column) -> Column:
    """The file's own title unless the text's is longer."""
    own = F.coalesce(metadata, F.lit(""))
    return F.when(F.length(from_text) > F.length(own), from_text).otherwise(own)


def guessed_material(title: Column, abstract: Column) -> Column:
    """The first match of the first pattern that has one of 2 to 120 characters that is no known abbreviation."""
    text = F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))
    clean = lambda s: F.regexp_replace(_squeezed(s), "^[ ,.;:-]+|[ ,.;:-]+$", "")
    fits = lambda s: F.length(s).between(2, 120) & ~s.isin(*NO_MATERIAL) & ~s.rlike(r"^\d+(?:\.\d+)?$")
    return F.coalesce(*(_first(F.filter(F.transform(F.regexp_extract_all(text, F.lit(p), 1), clean), fits)) for p in MATERIALS), F.lit(""))


def figure_material(systems: Column, reported: Column, legend: Column) -> Column:
    """One material of a figure: of its text, else reported in the plot, else of the legend."""
    return F.coalesce(*(_first(uniq_clean(c)) for c in (systems, reported, legend)), F.lit(""))


def pretty_title(path: Column) -> Column:
    """A readable title from a file's name, without an arXiv id or DOI at its end."""
    base = F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.pdf$", "")
    base = F.regexp_replace(F.regexp_replace(base, r"__\d{4}\.\d{4,5}v?\d*$", ""), r"(?s)__10\..*$", "")
    return F.trim(F.translate(base, "_", " "))


def upload_name(name: Column) -> Column:
    """Letters, digits and ._ - stay, whatever else is an underscore."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}._ -]", "_")


# ---- coercions ------------------------------------------------------------------------------------------------


def first_text(items: Column) -> Column:
    """The first entry of a list that is not blank, trimmed; empty without any."""
    return F.coalesce(_first(F.filter(F.transform(items, lambda s: F.trim(s)), lambda s: s != "")), F.lit(""))


def group_number(value: Column) -> Column:
    """The first number in a text if it is a space group's (1 to 230), else 0."""
    n = F.regexp_extract(F.coalesce(value, F.lit("")), r"(\d+)", 1).try_cast("long")
    return F.when(n.between(1, 230), n).otherwise(0).cast("int")


def first_group_number(items: Column) -> Column:
    """The first entry of a list that has one, else 0."""
    return F.coalesce(_first(F.filter(F.transform(items, group_number), lambda n: n > 0)), F.lit(0))


def symbol_text(symbol: Column) -> Column:
    """A Hermann-Mauguin symbol with compatible forms folded, dashes as hyphens and no overline."""
    return F.trim(F.replace(F.translate(nfkc(F.coalesce(symbol, F.lit(""))), "−–—", "---"), F.lit("‾"), F.lit("")))


def wavelength_of(radiation: Column) -> Column:
    """A wavelength in a radiation's text: after λ, lambda or an equals sign, else the first decimal from 0.1 to 3; else empty."""
    named = F.regexp_extract(radiation, r"(?iu)(?:λ|lambda|=)\s*=?\s*(\d+\.\d+)", 1)
    plain = _first(F.filter(F.regexp_extract_all(radiation, F.lit(r"(\d+\.\d+)"), 1), lambda s: s.try_cast("double").between(0.1, 3.0)))
    return F.coalesce(F.nullif(named, F.lit("")), plain, F.lit(""))


def evidence_tag(value: Column, kind: str = "string") -> Column:
    """The mark of a value that was added, empty where there is none."""
    there = F.trim(value) != "" if kind == "string" else F.size(value) > 0
    return F.when(there, "phase 2 addition").otherwise("")


def nested(record: Column, *path: str, default: str | None = None) -> Column:
    """A value inside a JSON record, the default where any step is missing."""
    return F.coalesce(F.get_json_object(record, "$" + "".join(f"['{p}']" for p in path)), F.lit(default))


def keyword_query(elements: Column, technique: Column) -> Column:
    """A search of keywords: alternatives of elements and of techniques, each split at OR."""
    part = lambda c, strip: F.array_join(F.transform(F.split(c, "OR"), lambda s: F.concat(F.lit('keyword:"'), strip(F.trim(s)), F.lit('"'))), " OR ")
    unquoted = lambda s: F.regexp_replace(F.regexp_replace(s, "^'+|'+$", ""), '^"+|"+$', "")
    return F.concat(F.lit("("), part(elements, lambda s: s), F.lit(") AND ("), part(technique, unquoted), F.lit(")"))


# ---- filters --------------------------------------------------------------------------------------------------


def figure_kept(number: Column, is_xrd: Column, data_type: Column) -> Column:
    """A figure with a number that shows diffraction, not only simulated."""
    return number.isNotNull() & F.coalesce(is_xrd, F.lit(False)) & ~F.coalesce(data_type == "simulated", F.lit(False))


def crop_kept(share: Column) -> Column:
    """A crop that is neither a speck nor the whole page."""
    return F.coalesce(share.between(*SHARE), F.lit(False))


def file_kept(size: Column, content_type: Column, *, sized: bool = True) -> Column:
    """A PDF by its type, and (but for publishers that send no length) by its size."""
    typed = F.coalesce(F.contains(F.lower(content_type), F.lit("pdf")), F.lit(False))
    return typed & F.coalesce(size > FILE_BYTES, F.lit(False)) if sized else typed


def journal_kept(journal: Column, allowed: list[str]) -> Column:
    return F.coalesce(journal.isin(*allowed), F.lit(False)) if allowed else F.lit(True)


def licence(answer: Column) -> Column:
    """The licence that a repository's answer states; null where it could not be determined."""
    return F.nullif(F.trim(F.regexp_extract(answer, r"(?s)<license>(.*?)</license>", 1)), F.lit(""))


def is_open_licence(url: Column) -> Column:
    """True, false, or null where the licence is unknown: a failed lookup is no decision."""
    return F.contains(F.lower(url), F.lit("creativecommons")) | F.contains(F.lower(url), F.lit("/cc/"))


# ---- slim records ---------------------------------------------------------------------------------------------

_PLOT = (
    "struct<x_axis_label: string, y_axis_label: string, legend_entries: array<struct<label: string, color: string, linestyle: string, temperature: string, material: string>>, reported_temperatures: array<string>, reported_materials: array<string>, "
    "reported_phases: array<string>, lattice_parameters: map<string, string>, profile_function: string, peak_positions_2theta: array<string>, fwhm: array<string>, notes: string, is_multi_panel: boolean, sub_panel_labels: array<string>>"
)
_FIGURE = (
    f"struct<figure_id: string, matched_fig_num: int, page: int, matched_caption_text: string, plot_info: {_PLOT}, phase2_xrd_text: struct<regex_candidate: struct<material_systems: array<string>>, verified: string>, "
    "metadata_provenance: map<string, struct<sources: array<string>, verified_status: string>>>"
)
_TEXTS = ("title", "doi", "author", "source_type", "arxiv_id", "doi_source", "published_doi")
RECORD = f"pdf string, pdf_resolved string, {', '.join(f'{c} string' for c in _TEXTS)}, main_material string, material string, paper_material_system string, abstract string, global_xrd_text struct<verified: string, regex_candidate: string>, xrd_figures array<{_FIGURE}>"
# Fields of a paper that a pattern found, which stand in where no verified value is.
PATTERN_FIELDS = (
    "lattice_parameters", "reported_phases", "profile_function", "peak_positions_2theta", "fwhm", "formula_units_Z", "chemical_formula", "database_refs",
    "xray_density", "cell_volume", "space_group_number", "formula_weight", "radiation_wavelength", "wyckoff_positions", "miller_indices",
)
_MAP = "map<string, string>"


def verified_block(block: Column) -> Column:
    """A block of verified fields (JSON, each with a value) as field to value (JSON text); what has no value is gone."""
    parsed = F.try_variant_get(F.try_parse_json(block), "$", "map<string, variant>")
    has = lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT")) & F.array_contains(F.json_object_keys(F.to_json(v)), "value")
    kept = F.map_filter(parsed, lambda _, v: F.coalesce(has(v), F.lit(False)))
    return F.coalesce(F.transform_values(kept, lambda _, v: F.coalesce(F.to_json(F.try_variant_get(v, "$.value", "variant")), F.lit("null"))), F.create_map().cast(_MAP))


def paper_fields(verified: Column, found: Column) -> Column:
    """A paper's verified fields, with what patterns found of those that verification says nothing of."""
    parsed = F.try_variant_get(F.try_parse_json(found), "$", "map<string, variant>")
    values = F.transform_values(F.map_filter(parsed, lambda k, _: k.isin(*PATTERN_FIELDS)), lambda _, v: F.to_json(v))
    filled = lambda own: F.map_filter(values, lambda k, v: v.isNotNull() & ~v.isin('""', "[]", "{}", "null") & ~F.map_contains_key(own, k))
    return _once(verified_block(verified), lambda own: F.map_concat(own, F.coalesce(filled(own), F.create_map().cast(_MAP))))


def slim(rows: DataFrame, record: str = "record") -> DataFrame:
    """Records (JSON) as the fields that later steps need, with defaults: the paper's texts, its main material, its verified fields
    as `global`, and its figures, each with one material, its own verified fields and its plot.  Verified values are JSON texts."""
    empty = F.array().cast("array<string>")
    legend_type = "array<struct<label: string, color: string, linestyle: string, temperature: string, material: string>>"

    def figure(f: Column) -> Column:
        plot = f["plot_info"]
        own = [F.coalesce(plot[c], F.lit("")).alias(c) for c in ("x_axis_label", "y_axis_label", "profile_function", "notes")]
        own += [F.coalesce(plot[c], empty).alias(c) for c in ("reported_temperatures", "reported_materials", "reported_phases", "peak_positions_2theta", "fwhm")]
        legend = F.transform(plot["legend_entries"], lambda e: F.trim(e["material"]))
        return F.struct(
            F.coalesce(f["figure_id"], F.lit("")).alias("figure_id"), f["matched_fig_num"].alias("figure_number"), f["page"].alias("page"), f["matched_caption_text"].alias("caption"),
            figure_material(f["phase2_xrd_text"]["regex_candidate"]["material_systems"], plot["reported_materials"], legend).alias("material"), verified_block(f["phase2_xrd_text"]["verified"]).alias("xrd_metadata"),
            F.struct(*own, F.coalesce(plot["legend_entries"], F.array().cast(legend_type)).alias("legend_entries"), F.coalesce(plot["lattice_parameters"], F.create_map().cast(_MAP)).alias("lattice_parameters")).alias("plot_info"),
            F.coalesce(plot["is_multi_panel"], F.lit(False)).alias("is_multi_panel"), F.coalesce(plot["sub_panel_labels"], empty).alias("sub_panel_labels"), f["metadata_provenance"].alias("metadata_provenance"),
        )

    r = rows.withColumn("__r", F.from_json(record, RECORD))
    texts = [F.coalesce(F.col(f"__r.{c}"), F.lit("")).alias(c) for c in _TEXTS]
    figures = F.transform(F.coalesce("__r.xrd_figures", F.array()), figure)
    r = r.select(*(c for c in rows.columns if c != record), "__r", F.coalesce("__r.pdf_resolved", "__r.pdf").alias("pdf"), *texts, figures.alias("figures"))
    named = [_squeezed(F.coalesce(F.col(f"__r.{c}"), F.lit(""))) for c in ("main_material", "material", "paper_material_system", "title", "abstract")]
    of_figures = _first(F.filter(F.transform("figures", lambda f: f["material"]), lambda m: m != ""))
    main = F.coalesce(*(F.nullif(c, F.lit("")) for c in named), of_figures, F.lit(""))
    return r.select(*(c for c in r.columns if c not in ("__r", "figures")), main.alias("main_material"), paper_fields(F.col("__r.global_xrd_text.verified"), F.col("__r.global_xrd_text.regex_candidate")).alias("global"), "figures")


def trimmed_trace(trace: Column, most: int = OBSERVATION["report"]) -> Column:
    """The steps of an agent (structs of step, tool, observation) with so much of what came back."""
    return F.transform(F.coalesce(trace, F.array().cast("array<struct<step:int,tool:string,observation:string>>")), lambda s: F.struct(F.coalesce(s["step"], F.lit(0)).alias("step"), F.coalesce(s["tool"], F.lit("")).alias("tool"), F.substring(F.coalesce(s["observation"], F.lit("")), 1, most).alias("observation")))


# ---- lookups and counters -------------------------------------------------------------------------------------


def resolved_paths(records: DataFrame, files: DataFrame, pdf_dir: str) -> DataFrame:
    """Per record (stored, json_path) the PDF's path among the files (path): as stored, in the PDF folder, next to the JSON."""
    name = F.regexp_extract("stored", r"([^/]*)$", 1)
    out = records.withColumn("__1", F.concat(F.lit(pdf_dir.rstrip("/") + "/"), name)).withColumn("__2", F.concat(F.regexp_extract("json_path", r"^(.*/)?[^/]*$", 1), name))
    for i, c in enumerate(("stored", "__1", "__2")):
        out = out.join(files.select(F.col("path").alias(f"__p{i}")).distinct(), F.col(c) == F.col(f"__p{i}"), "left")
    return out.withColumn("pdf_path", F.coalesce("__p0", "__p1", "__p2")).drop("__1", "__2", "__p0", "__p1", "__p2")


def first_of_path(rows: DataFrame, path: str, order: str) -> DataFrame:
    """The first row of each path, the case of which does not matter."""
    one = F.min_by(F.struct(*rows.columns), order)
    return rows.groupBy(F.lower(path).alias("__path")).agg(one.alias("r")).select("r.*")


def library(files: DataFrame, path: str = "path") -> DataFrame:
    """How many PDFs, records and logs there are; an agent's cache is no record."""
    p = F.col(path)
    kind = F.when(p.endswith(".pdf"), "pdf").when(p.endswith(".json") & ~F.contains(F.regexp_extract(p, r"([^/]*)$", 1), F.lit("_agent_cache_")), "json").when(p.endswith(".txt"), "log")
    return files.select(kind.alias("kind")).where("kind is not null").groupBy("kind").agg(F.count("*").alias("files"))


def errors(outcomes: DataFrame, by: str, failed: str) -> DataFrame:
    """Per run the documents, those with an error, and whether every one had."""
    out = outcomes.groupBy(by).agg(F.count("*").alias("documents"), F.count_if(F.coalesce(F.col(failed), F.lit(False))).alias("errors"))
    return out.withColumn("all_failed", F.col("documents") == F.col("errors"))


def missing_credentials(stages: DataFrame, credentials: DataFrame) -> DataFrame:
    """Per credential that enabled stages (stage, seq, credential, enabled) need and nobody has, the list of these stages."""
    need = stages.where("enabled").join(credentials.where("trim(value) <> ''").select("credential"), "credential", "left_anti")
    return need.groupBy("credential").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "stage"))), lambda x: x["stage"]).alias("stages"))
