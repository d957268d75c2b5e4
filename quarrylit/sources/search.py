"""Literature sources behind injected fetchers: paged searches become candidates, candidates become documents.

A fetcher is the network: `fetch(query, start, size)` gives a page of records.  `search` goes through one search in one task;
`literature` has a partition a page, and downloads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylit.operators.records import is_open_licence
from quarrylit.operators.screening import last_wins

Fetch = Callable[[str, int, int], list[dict]]


@dataclass(frozen=True)
class Paging:
    """Where a search begins, how many records a page has, and how far it goes, by the number of documents wanted."""

    start: int
    size: Callable[[int], int]
    pages: Callable[[int], int]
    short_page_ends: bool = False


# How far each source is searched for n documents.
PAGING = {
    "arxiv": Paging(0, lambda n: 25, lambda n: -(-10 * n // 25)),
    "springer": Paging(1, lambda n: 25, lambda n: 15),
    "elsevier": Paging(0, lambda n: 25, lambda n: -(-5 * n // 25), True),
    "crossref": Paging(0, lambda n: 3 * n, lambda n: 1),
}
MOST = {"arxiv": lambda n: 10 * n}
SIZED = ("arxiv", "elsevier")  # whose files must be over 50,000 bytes


def paged(fetch: Fetch, source: str, query: str, target: int) -> Iterator[dict]:
    """A source's records in the order of its pages; an empty page ends the search."""
    rule = PAGING[source]
    size, left = rule.size(target), MOST.get(source, lambda n: None)(target)
    for n in range(rule.pages(target)):
        page = fetch(query, rule.start + n * size, size)[:left]
        yield from page
        left = left and left - len(page)
        if not page or left == 0 or (rule.short_page_ends and len(page) < size):
            return


def search(requests: DataFrame, fetchers: dict[str, Fetch]) -> DataFrame:
    """Per request (source, query, target) its records: source, seq (from 0), record (JSON), error. A failed page ends its
    search with a row that holds the error and no record; what came before stays. Unknown sources are such rows too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for source, query, target in zip(batch["source"], batch["query"], batch["target"], strict=True):
                seq = 0
                try:
                    for record in paged(fetchers[source], source, query, int(target)):
                        out.append((source, seq, json.dumps(record, ensure_ascii=False), None))
                        seq += 1
                except Exception as e:
                    out.append((source, seq, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source", "seq", "record", "error"])

    return requests.select("source", "query", "target").mapInPandas(run, "source string, seq long, record string, error string")


def unique(records: DataFrame) -> DataFrame:
    """Each publisher's records by DOI, else title: the last one, at the place of the first; without either they go."""
    at = lambda path: F.nullif(F.get_json_object("record", path), F.lit(""))
    keyed = records.withColumn("__key", F.coalesce(at("$['prism:doi']"), at("$['dc:title']"))).where("__key IS NOT NULL")
    keyed = keyed.withColumn("__key", F.struct("source", "__key"))
    first = keyed.groupBy("__key").agg(F.min("seq").alias("__first"))
    return last_wins(keyed, "__key", "seq").join(first, "__key").drop("__key", "seq").withColumnRenamed("__first", "seq")


# ---- what a record says -------------------------------------------------------------------------------------

_PLACES = "array<struct<license: string, url_for_pdf: string>>"


def _low(record: Column, path: str) -> Column:
    return F.lower(F.coalesce(F.get_json_object(record, path), F.lit("")))


def _locations(record: Column) -> Column:
    """The best open location first, then all."""
    places = F.from_json(record, f"best_oa_location struct<license: string, url_for_pdf: string>, oa_locations {_PLACES}")
    return F.concat(F.array(places["best_oa_location"]), F.coalesce(places["oa_locations"], F.array().cast(_PLACES)))


def is_open(source: str, record: Column) -> Column:
    """Whether a record is under a Creative Commons licence, by its source's own rule; arXiv's may be unknown (null)."""
    match source:
        case "springer":
            said = F.concat(_low(record, "$.copyright"), F.lit(" "), _low(record, "$.license"))
            return F.contains(said, F.lit("creative commons")) | F.contains(said, F.lit("cc by")) | F.contains(said, F.lit("cc-by"))
        case "elsevier":
            return F.contains(_low(record, "$['prism:copyright']"), F.lit("creative commons")) | F.contains(_low(record, "$['prism:copyright']"), F.lit("cc")) | (_low(record, "$.openaccess") == "true")
        case "crossref":
            return F.exists(_locations(record), lambda x: F.coalesce(F.startswith(F.lower(x["license"]), F.lit("cc")), F.lit(False)))
        case "arxiv":
            return is_open_licence(F.get_json_object(record, "$.license"))
    raise ValueError(f"no source {source!r}")


def pdf_url(source: str, record: Column) -> Column:
    """Where a record's PDF is; null where it doesn't say."""
    filled = lambda c: F.nullif(c, F.lit(""))
    match source:
        case "springer":
            urls = F.transform(F.from_json(F.get_json_object(record, "$.url"), "array<struct<value: string>>"), lambda u: u["value"])
            return F.get(F.filter(urls, lambda u: F.endswith(F.lower(u), F.lit(".pdf"))), F.lit(0))
        case "elsevier":
            return F.concat(F.lit("https://api.elsevier.com/content/article/doi/"), filled(F.get_json_object(record, "$['prism:doi']")))
        case "crossref":
            return F.get(F.filter(F.transform(_locations(record), lambda x: filled(x["url_for_pdf"])), lambda u: u.isNotNull()), F.lit(0))
        case "arxiv":
            page = filled(F.get_json_object(record, "$.entry_id"))
            return F.coalesce(filled(F.get_json_object(record, "$.pdf_url")), F.concat(F.replace(page, F.lit("/abs/"), F.lit("/pdf/")), F.lit(".pdf")))
    raise ValueError(f"no source {source!r}")


# Where an article's PDF may be by its DOI, and the host of a link without one.
SPRINGER_PLACES = ("https://link.springer.com/article/{}/pdf", "https://link.springer.com/article/{}/pdf?pdf=button", "https://link.springer.com/content/pdf/{}.pdf", "https://rd.springer.com/content/pdf/{}.pdf")
ARTICLE_HOST = "https://www.nature.com"


def article_urls(record: Column) -> Column:
    """All addresses of a Springer record, in order."""
    return F.filter(F.transform(F.from_json(F.get_json_object(record, "$.url"), "array<struct<value: string>>"), lambda u: u["value"]), lambda u: u.isNotNull())


def page_link(page: Column) -> Column:
    """The first link to a PDF of an article's page (HTML), null without any; a link without a host is the publisher's."""
    link = F.nullif(F.regexp_extract(page, r"""(?is)<a\b[^>]*?\shref\s*=\s*["']?([^"'>\s]*\.pdf(?:\?[^"'>\s]*)?)["'\s>]""", 1), F.lit(""))
    return F.when(F.startswith(link, F.lit("http")), link).otherwise(F.concat(F.lit(ARTICLE_HOST), link))


def candidate_urls(source: str, record: Column, page: Column | None = None) -> Column:
    """Where a record's PDF may be, in the order to try: its own link, for Springer else that of its article page, then by DOI."""
    own = pdf_url(source, record)
    if source != "springer":
        return F.array_compact(F.array(own))
    urls = article_urls(record)
    doi = F.nullif(F.regexp_extract(F.array_join(F.coalesce(urls, F.array().cast("array<string>")), " "), r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+", 0), F.lit(""))
    linked = F.coalesce(own, page_link(page)) if page is not None else own
    return F.array_compact(F.array(linked, *(F.concat(F.lit(a), doi, F.lit(b)) for a, b in (x.split("{}") for x in SPRINGER_PLACES))))
