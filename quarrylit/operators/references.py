"""Bibliographic records: assembled from a document's own data, and merged from several records of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylit.functions import text
from quarrylit.operators.records import guessed_material, longer_title, text_title


@dataclass(frozen=True)
class Field:
    """A field of the merged record: where it is in a source's JSON, its Spark type, and what it is where no source has it."""

    path: str
    type: str = "string"
    default: Column | None = None


def _filled(c: Column, kind: str) -> Column:
    """Whether a value says something: a text, a list or a map that is not empty, a number but 0, true."""
    if kind == "string":
        return text.is_filled(c)
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    return F.coalesce(c != 0, F.lit(False))


def merged(sources: DataFrame, key: str, priority: str, record: str, fields: dict[str, Field]) -> DataFrame:
    """Per key, each field from the first source, by priority, that fills it, whatever its type; else its default.

    One aggregation with partial results: no source of a record waits for another.  Records that don't parse have no values;
    of sources with one priority any may be taken, so priorities are to be distinct within a key."""
    v = F.try_parse_json(record)
    read = {n: F.try_variant_get(v, f.path, f.type) for n, f in fields.items()}
    clean = {n: F.trim(c) if fields[n].type == "string" else c for n, c in read.items()}
    rows = sources.select(key, F.col(priority).alias("__p"), *(c.alias(n) for n, c in clean.items()))
    first = [F.min_by(n, F.when(_filled(F.col(n), f.type), F.col("__p"))) for n, f in fields.items()]
    none = {"string": F.lit(""), "boolean": F.lit(False)}
    default = [f.default if f.default is not None else none.get(f.type, F.array().cast(f.type) if f.type.startswith("array") else F.create_map().cast(f.type) if f.type.startswith("map") else F.lit(0).cast(f.type)) for f in fields.values()]
    return rows.groupBy(key).agg(*(F.coalesce(F.when(_filled(a, f.type), a), d).alias(n) for (n, f), a, d in zip(fields.items(), first, default, strict=True)))


# What a reference has, and the blocks that stand in where a record has no title of its own.
REFERENCE = ("pdf", "title", "doi", "author", "source_type", "arxiv_id", "doi_source", "published_doi")
INNER = ("global", "methods", "global_xrd_text")


def reference(sources: DataFrame, key: str, priority: str, record: str, name: Column) -> DataFrame:
    """Per key the reference of its records, the record in hand first, then its siblings by stage.

    A record without a title looks into its blocks: the last block with a title gives it, the first with a DOI or author
    gives these where the record has none.  What no record says of source and arXiv id is told from path and title; an
    arXiv paper without DOI has the one of its id.  `name` is the file's name, for records without a PDF."""
    at = lambda *path: F.trim(F.coalesce(F.get_json_object(record, "$" + "".join(f"['{p}']" for p in path)), F.lit("")))
    rows = sources.withColumns({f"__{f}": at(f) for f in REFERENCE} | {f"__{b}_{f}": at(b, f) for b in INNER for f in ("title", "doi", "author")})
    untitled = F.col("__title") == ""
    chain = lambda f, blocks: F.coalesce(*(F.nullif(F.col(f"__{b}_{f}"), F.lit("")) for b in blocks), F.lit(""))
    own = {
        "title": F.when(untitled, chain("title", INNER[::-1])).otherwise(F.col("__title")),
        "doi": F.when(untitled & (F.col("__doi") == ""), chain("doi", INNER)).otherwise(F.col("__doi")),
        "author": F.when(untitled & (F.col("__author") == ""), chain("author", INNER)).otherwise(F.col("__author")),
        "source_type": F.lower("__source_type"),
    }
    # a block's DOI and author are asked for only where the block's record has been found without a title by then
    values = {f: own.get(f, F.col(f"__{f}")) for f in REFERENCE}
    rows = rows.select(key, F.col(priority).alias("__p"), name.alias("__name"), *(c.alias(f) for f, c in values.items()))
    first = [F.coalesce(F.min_by(f, F.when(F.col(f) != "", F.col("__p"))), F.lit("")).alias(f) for f in REFERENCE]
    got = rows.groupBy(key).agg(F.min_by("__name", "__p").alias("__name"), *first)
    got = got.withColumn("pdf_name", F.when(F.col("pdf") != "", F.regexp_extract("pdf", r"([^/]*)/*$", 1)).otherwise(F.col("__name")))
    got = got.withColumn("source_type", F.when(F.col("source_type") != "", F.col("source_type")).otherwise(text.source_type(F.col("pdf"))))
    found = text.arxiv_id(F.concat_ws("\n", "pdf", "title"), old_style=True)
    got = got.withColumn("arxiv_id", F.when(F.col("arxiv_id") != "", F.col("arxiv_id")).otherwise(F.coalesce(found, F.lit(""))))
    bare = F.regexp_replace(F.trim("arxiv_id"), r"(?i)^arxiv\s*:\s*", "")
    lacks = (F.col("arxiv_id") != "") & (F.col("source_type") == "arxiv") & (F.col("doi") == "")
    got = got.withColumns({"doi": F.when(lacks, text.arxiv_doi(bare)).otherwise(F.col("doi")), "doi_source": F.when(lacks, "arxiv").otherwise(F.col("doi_source"))})
    return got.select(key, "title", "doi", "author", "pdf", "pdf_name", "source_type", "arxiv_id", "doi_source", "published_doi", F.lit(0.0).alias("match_confidence"))


def assembled(rows: DataFrame, *, pages: int = 3) -> DataFrame:
    """A document's bibliographic record from (path, meta_title, meta_author, pages: array of texts) and what lookups gave
    (material, found_title, found_doi, found_doi_source, found_author; null without), other columns kept.

    The first pages' text gives arXiv id, DOI, a title if longer than the file's own, abstract and, where no model named one, a material.  An
    arXiv paper's DOI is that of its id, its own the published one.  A lookup, made by title, fills DOI and author and may lengthen the title."""
    sample = F.array_join(F.slice(F.coalesce("pages", F.array().cast("array<string>")), 1, pages), "\n")
    out = rows.withColumn("__text", sample)
    body = F.col("__text")
    found = F.coalesce(F.regexp_replace(text.first_group(body, r"(?i)(10\.\d{4,9}/[-._;()/:A-Z0-9]+)"), r"[.,;:)\]} ]+$", ""), F.lit(""))
    identifier = F.coalesce(text.arxiv_id(body, F.col("path")), F.lit(""))
    is_arxiv = F.col("arxiv_id") != ""
    out = out.withColumn("arxiv_id", identifier).withColumn("__doi", found).withColumn("__title", longer_title(F.trim(F.coalesce("meta_title", F.lit(""))), text_title(body))).withColumn("abstract", F.coalesce(text.abstract(body, 4000), F.lit("")))
    doi = F.when(is_arxiv, text.arxiv_doi(F.col("arxiv_id"))).otherwise(F.col("__doi"))
    author = F.trim(F.coalesce("meta_author", F.lit("")))
    looked = (F.col("__title") != "") & F.coalesce(F.col("found_title"), F.col("found_doi"), F.col("found_author")).isNotNull()
    fill = lambda own, other: F.when(looked & (own == ""), F.coalesce(other, own)).otherwise(own)
    material = F.coalesce(F.nullif(F.trim("material"), F.lit("")), guessed_material(F.col("__title"), F.col("abstract")))
    longer = looked & (F.length(F.coalesce("found_title", F.lit(""))) > F.length("__title"))
    out = out.select(
        *(c for c in rows.columns if c not in ("pages", "meta_title", "meta_author", "material", "found_title", "found_doi", "found_doi_source", "found_author")),
        F.when(longer, F.col("found_title")).otherwise(F.col("__title")).alias("title"), fill(doi, F.col("found_doi")).alias("doi"), fill(author, F.col("found_author")).alias("author"), "abstract", material.alias("main_material"),
        F.when(is_arxiv, "arxiv").otherwise("").alias("source_type"), "arxiv_id", F.when(is_arxiv, F.lit("arxiv")).when(looked & (F.col("__doi") == ""), F.coalesce("found_doi_source", F.lit(""))).otherwise("").alias("doi_source"), F.when(is_arxiv, F.col("__doi")).otherwise("").alias("published_doi"),
    )
    return out
