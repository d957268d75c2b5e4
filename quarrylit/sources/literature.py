"""Literature searches as a Spark data source: one partition a result page, and one file a task.

    register(spark, {"arxiv": Store(fetch, count)})
    spark.read.format("literature").option("source", "arxiv").option("query", "NiO").option("target", 20).load()

What a fetcher does is the network's: `fetch(query, start, size)` gives a page of records, `count(query)` how many there are,
where a service tells.  A page is a task of its own, so a page that fails fails alone.  As pages don't know of one another, the
one that ends its search (empty, short, failed) says so in a row without a record; `complete` drops what lies beyond."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from quarrylit.operators.records import FILE_BYTES
from quarrylit.sources.search import MOST, PAGING, SIZED, Fetch

SCHEMA = "source string, query string, page int, seq long, record string, journal string, year int, ends boolean, error string"

# Where a record says its journal and date, the first that is filled.
JOURNAL = ("publicationName", "prism:publicationName", "journal_ref", "container-title")
DATE = ("publicationDate", "prism:coverDate", "published", "year")


@dataclass(frozen=True)
class Store:
    fetch: Fetch
    count: Callable[[str], int] | None = None


@dataclass
class Page(InputPartition):
    number: int
    start: int
    size: int
    most: int


def _first(record: dict, names: tuple[str, ...]) -> str:
    found = next((record[n] for n in names if record.get(n)), "")
    return str((found[0] if found else "") if isinstance(found, list) else found)


def facts(record: dict) -> tuple[str | None, int | None]:
    """A record's journal and year."""
    year = re.search(r"\d{4}", _first(record, DATE))
    return _first(record, JOURNAL) or None, int(year[0]) if year else None


_TESTS = {
    EqualTo: lambda v, x: v == x,
    In: lambda v, x: v in x,
    IsNotNull: lambda v, x: True,  # as for every other test
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
}


class Pages(DataSourceReader):
    def __init__(self, options: dict[str, str], stores: dict[str, Store]):
        self.source, self.query, self.target = options["source"], options.get("query", ""), int(options.get("target", 10))
        if self.source not in stores:
            raise ValueError(f"no source {self.source!r}")
        self.store, self.tests = stores[self.source], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what compares a record's journal or year with values; the rest is Spark's.  Rows that end a search pass all."""
        for f in filters:
            path = getattr(f, "attribute", ())
            if type(f) in _TESTS and path in (("journal",), ("year",)):
                self.tests.append((path[0] == "year", type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Page]:
        rule = PAGING[self.source]
        size, pages, most = rule.size(self.target), rule.pages(self.target), MOST.get(self.source, lambda n: 1 << 62)(self.target)
        if self.store.count:  # nothing is asked for beyond the end
            pages = min(pages, max(1, -(-self.store.count(self.query) // size)))
        return [Page(n, rule.start + n * size, size, most - n * size) for n in range(pages)]

    def wanted(self, journal: str | None, year: int | None) -> bool:
        values = (journal, year)
        return all(values[i] is not None and _TESTS[kind](values[i], x) for i, kind, x in self.tests)

    def read(self, page: Page) -> Iterator[tuple]:
        rule, seq = PAGING[self.source], page.number * page.size
        head = (self.source, self.query, page.number)
        try:
            found = self.store.fetch(self.query, page.start, page.size)
        except Exception as e:
            yield (*head, seq, None, None, None, True, f"{type(e).__name__}: {e}")
            return
        for i, record in enumerate(found[: page.most]):
            journal, year = facts(record)
            if self.wanted(journal, year):
                yield (*head, seq + i, json.dumps(record, ensure_ascii=False), journal, year, False, None)
        if not found or (rule.short_page_ends and len(found) < page.size):
            yield (*head, seq + len(found), None, None, None, True, None)


def register(spark: SparkSession, stores: dict[str, Store], name: str = "literature") -> None:
    """Makes the sources readable under `name`; options: source, query, target."""
    kind = name

    class Literature(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> Pages:
            return Pages(self.options, stores)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Literature)


def complete(pages: DataFrame) -> DataFrame:
    """The records up to the page that ends their search, and why it ended if it failed.  A search has some hundred records."""
    end = F.min(F.when(F.col("ends"), F.col("page"))).over(Window.partitionBy("source", "query"))
    rows = pages.withColumn("__end", end).where(F.col("__end").isNull() | (F.col("page") <= F.col("__end")))
    return rows.where("record IS NOT NULL OR error IS NOT NULL").drop("__end", "ends")


def looked_up(records: DataFrame, lookup: Callable[[str], dict | None], at: str = "$.DOI") -> DataFrame:
    """Records of an index as what a second service answers of their DOI, at the same places; without DOI or answer they go.

    One DOI a call, where the record's row is; what fails is no answer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = []
            for key in batch["doi"]:
                try:
                    answers.append(lookup(key))
                except Exception:
                    answers.append(None)
            batch = batch.assign(record=[json.dumps(a, ensure_ascii=False) if a else None for a in answers])
            yield batch[batch["record"].notna()]

    keyed = records.where("record IS NOT NULL").select("source", "query", "seq", F.nullif(F.get_json_object("record", at), F.lit("")).alias("doi")).where("doi IS NOT NULL")
    return keyed.mapInPandas(run, "source string, query string, seq long, doi string, record string")


def download(candidates: DataFrame, get: Callable[[str], tuple[int, str, bytes]], target: int, folder: str, existing: DataFrame | None = None) -> DataFrame:
    """Candidates (source, seq, name, url or urls: an array to try in order) until a source has its target: source, seq, name, status, content.

    Waves of candidates are fetched, one file a task, into tables below `folder`; a wave has as many of a source as it still
    lacks, or as were tried before if that is more, so there are few waves and less than twice the fetches needed.  A rank over
    what came then ends each source at its target.  Names that exist count and aren't fetched; what fails, or isn't a PDF by
    its type (and size, where a source tells), is `refused`.  The driver holds two numbers a source."""
    spark = candidates.sparkSession
    urls = F.col("urls") if "urls" in candidates.columns else F.array_compact(F.array("url"))
    rows = candidates.select("source", "seq", "name", urls.alias("urls"))
    there = existing.select("name").distinct().withColumn("there", F.lit(True)) if existing is not None else None
    rows = rows.join(there, "name", "left") if there is not None else rows.withColumn("there", F.lit(None).cast("boolean"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("seq", "name"))
    rows.withColumn("rank", rank).write.parquet(f"{folder}/queue")
    queue = spark.read.parquet(f"{folder}/queue")
    fields = "source string, seq long, name string, rank int, status string, content binary"

    def one(source: str, urls: list[str] | None, there: bool | None) -> tuple[str, bytes | None]:
        if there is True:
            return "exists", None
        for url in urls if urls is not None else ():
            try:
                status, kind, content = get(url)
            except Exception:
                continue
            if status == 200 and "pdf" in (kind or "").lower() and (source not in SIZED or len(content) > FILE_BYTES):
                return "kept", content
        return "refused", None

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                yield pd.DataFrame([(r.source, r.seq, r.name, r.rank, *one(r.source, r.urls, r.there))], columns=["source", "seq", "name", "rank", "status", "content"])

    state = {r.source: [0, 0, r.n] for r in queue.groupBy("source").agg(F.count("*").alias("n")).collect()}
    wave = 0
    while todo := [(s, tried, min(n, tried + max(target - got, tried))) for s, (tried, got, n) in state.items() if got < target and tried < n]:
        limits = F.broadcast(spark.createDataFrame(todo, "source string, low int, high int"))
        part = queue.join(limits, "source").where("rank > low AND rank <= high").repartition(sum(high - low for _, low, high in todo))
        part.mapInPandas(fetch, fields).write.parquet(f"{folder}/files/wave={wave}")
        for r in spark.read.parquet(f"{folder}/files/wave={wave}").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("status") != "refused").alias("got")).collect():
            state[r.source][0] += r.n
            state[r.source][1] += r.got
        wave += 1
    if not wave:
        return spark.createDataFrame([], fields).drop("rank")
    files = spark.read.parquet(f"{folder}/files").drop("wave")
    before = F.coalesce(F.sum(F.when(F.col("status") != "refused", 1).otherwise(0)).over(Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = files.select("source", "rank", "status").withColumn("before", before).where(F.col("before") < target).select("source", "rank")
    return files.join(kept, ["source", "rank"]).select("source", "seq", "name", "status", "content")
