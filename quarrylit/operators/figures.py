"""Figure records: candidate scores, text around a box, candidates and their provenance, summaries, patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words near a figure, and on its page, that speak for diffraction.
NEAR_WORDS = ("fig", "figure", "2θ", "2theta", "intensity", "xrd", "pxrd", "rietveld", "diffraction")
PAGE_WORDS = ("xrd", "pxrd", "x-ray diffraction", "x ray diffraction", "2θ", "2theta", "theta", "intensity", "rietveld", "diffract")
# Least share of the page, least bytes of a rendered crop, least score.
LEAST_SHARE, LEAST_BYTES, LEAST_SCORE = 0.03, 1200, 0.20


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(F.lower(F.coalesce(text, F.lit(""))), w))


def candidate_score(kind: Column, share: Column, crop_bytes: Column, near: Column, page: Column) -> Column:
    """(score, call, reasons, whose names are fixed values) of a figure candidate: five signals make a score of 1; too low a score, too small a
    crop or a drawing without any text near it is not worth a call."""
    drawn, wide, rendered = kind.isin("vector", "mixed"), share >= LEAST_SHARE, crop_bytes >= LEAST_BYTES
    by_near = _any(near, NEAR_WORDS)
    by_page = ~by_near & _any(page, PAGE_WORDS)
    points = drawn.cast("int") + wide.cast("int") + rendered.cast("int") + F.when(by_near, 2).when(by_page, 1).otherwise(0)
    score = F.round(F.least(F.lit(1.0), points / 5.0), 4)
    textless = (kind == "vector") & (F.trim(F.coalesce(near, F.lit(""))) == "")
    stops = ((textless, "skip_textless_vector_candidate"), (~rendered, "skip_tiny_render"), (score < LEAST_SCORE, "below_agent_score_threshold"))
    reasons = F.array_compact(F.array(*(F.when(c, r) for c, r in ((drawn, "vector_or_mixed_candidate"), (wide, "reasonable_area"), (rendered, "nontrivial_crop"), (by_near, "nearby_text_support"), (by_page, "page_text_support"), *stops))))
    return F.struct(score.alias("score"), (~textless & rendered & (score >= LEAST_SCORE)).alias("call"), reasons.alias("reasons"))


def text_near(words: Column, box: Column, most: int = 1200) -> Column:
    """The words (structs of a page) around a box, in reading order: 8 % or 20 units beside it, 80 more above, 120 more below."""
    x = F.greatest(F.lit(20.0), (box["x1"] - box["x0"]) * 0.08)
    y = F.greatest(F.lit(20.0), (box["y1"] - box["y0"]) * 0.08)
    near = F.filter(words, lambda w: (w["x1"] >= box["x0"] - x) & (w["x0"] <= box["x1"] + x) & (w["y1"] >= box["y0"] - y - 80) & (w["y0"] <= box["y1"] + y + 120))
    ordered = F.array_sort(F.transform(near, lambda w: F.struct(w["y0"], w["x0"], w["text"])))
    return F.substring(F.trim(F.regexp_replace(F.array_join(F.transform(ordered, lambda w: w["text"]), " "), r"\s+", " ")), 1, most)


def filled(c: Column, kind: str) -> Column:
    """Whether a field of a kind (string, list or map) holds anything."""
    return F.coalesce(F.trim(c) != "", F.lit(False)) if kind == "string" else F.coalesce(F.size(c) > 0, F.lit(False))


def provenance(in_document: Column, in_figure: Column, verified: Column, caption: Column | None = None, field: str = "") -> Column:
    """(sources, verified_status) of a field: where a value of it was found, and the verdict on it if there is one.

    A caption is a source of phases and materials.  The names are fixed values."""
    status = F.coalesce(F.nullif(verified, F.lit("")), F.lit("not_verified"))
    told = F.coalesce(caption != "", F.lit(False)) if caption is not None and field in ("reported_phases", "reported_materials") else F.lit(False)
    sources = F.array_compact(F.array(F.when(in_document, "global_regex"), F.when(in_figure, "figure_vision_phase1"), F.when(told, "caption"), F.when(status != "not_verified", "llm_verification")))
    return F.struct(sources.alias("sources"), status.alias("verified_status"))


def figure_candidate(document: Column, figure: Column) -> Column:
    """A list field of a figure: its own entries if it has any, else the document's (they are not united)."""
    return F.when(F.size(figure) > 0, figure).otherwise(document)


def figure_id(stem: Column, figure: Column, page: Column) -> Column:
    return F.concat(stem, F.lit("__fig"), figure.cast("string"), F.lit("_p"), page.cast("string"))


def summary(papers: DataFrame) -> DataFrame:
    """Per paper (stem, figures, methods): the number of figures, its first five materials and first eight method names."""
    named = F.array_distinct(F.filter(F.transform("figures", lambda f: F.trim(f["material"])), lambda m: m != ""))
    return papers.select("stem", F.size("figures").alias("figures"), F.array_join(F.slice(named, 1, 5), ", ").alias("materials"), F.array_join(F.slice(F.map_keys("methods"), 1, 8), ", ").alias("methods"))


def patched(records: DataFrame, curves: DataFrame) -> DataFrame:
    """The records with curves (stem, figure_number, curves) put into the first figure of that number.

    Of several curves of one number the least counts; curves without a number are left out."""
    one = curves.where("figure_number is not null").groupBy("stem", "figure_number").agg(F.min("curves").alias("curves"))
    own = one.groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct("figure_number", "curves"))).alias("__curves"))

    def put(figures: Column) -> Column:
        numbers = F.transform(figures, lambda f: f["figure_number"])
        return F.transform(figures, lambda f, i: F.when(F.array_position(numbers, f["figure_number"]) == i + 1, f.withField("curves", F.coalesce(F.try_element_at(F.col("__curves"), f["figure_number"]), f["curves"]))).otherwise(f))

    out = records.join(own, "stem", "left")
    return out.withColumn("figures", F.when(F.col("__curves").isNull(), F.col("figures")).otherwise(put(F.col("figures")))).drop("__curves")


def variants(files: DataFrame, tags: list[str]) -> DataFrame:
    """Per paper the files of its stages, (stem, tag, path), as a list in the order of the tags."""
    order = F.array_position(F.array(*(F.lit(t) for t in tags)), F.col("tag"))
    rows = files.where(order > 0).groupBy("stem").agg(F.array_sort(F.collect_list(F.struct(order.alias("place"), "tag", "path"))).alias("v"))
    return rows.select("stem", F.transform("v", lambda x: F.struct(x["tag"], x["path"])).alias("variants"))


def formula_like(c: Column, names: dict[str, str]) -> Column:
    """The symbol of an element's name, a whole formula without spaces, else the longest formula inside; empty without any."""
    text = F.trim(F.coalesce(c, F.lit("")))
    flat = F.replace(text, F.lit(" "), F.lit(""))
    found = F.regexp_extract_all(flat, F.lit(r"(?:[A-Z][a-z]?\d*){1,8}"), 0)
    longest = F.array_max(F.transform(found, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("first"), x.alias("x"))))["x"]
    whole = F.when(flat.rlike(r"^(?:[A-Z][a-z]?\d*){1,8}$"), flat)
    by_name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.lower(text)] if names else F.lit(None).cast("string")
    return F.coalesce(by_name, whole, longest, F.lit(""))
