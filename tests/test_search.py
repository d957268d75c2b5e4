"""Paged searches, licences and PDF places, by fetchers that are lists."""

import json

from pyspark.sql import functions as F

from quarrylit.sources import search


def pages_of(n, asked=None):
    def fetch(query, start, size):
        if asked is not None:
            asked.append((start, size))
        return [{"i": i} for i in range(start, min(n, start + size))]

    return fetch


def test_paging():
    def asked(source, n, target):
        seen = []
        return len(list(search.paged(pages_of(n, seen), source, "q", target))), [s for s, _ in seen]

    assert asked("arxiv", 1000, 3) == (30, [0, 25])
    assert asked("springer", 60, 1) == (59, [1, 26, 51, 76])
    assert asked("springer", 10**6, 1) == (375, [1 + 25 * i for i in range(15)])
    assert asked("elsevier", 1000, 10) == (50, [0, 25])
    assert asked("elsevier", 30, 100) == (30, [0, 25])
    assert asked("crossref", 1000, 7) == (21, [0])
    assert asked("arxiv", 0, 3) == (0, [0])


def test_search(spark):
    def broken(query, start, size):
        if start:
            raise OSError("429")
        return [{"i": i} for i in range(size)]

    requests = spark.createDataFrame([("arxiv", "q", 1), ("elsevier", "q", 10), ("other", "q", 1)], "source string, query string, target int")
    got = search.search(requests, {"arxiv": pages_of(4), "elsevier": broken}).groupBy("source").agg(F.count("record").alias("n"), F.max("seq").alias("last"), F.max("error").alias("error")).collect()
    assert {r.source: (r.n, r.last, r.error) for r in got} == {"arxiv": (4, 3, None), "elsevier": (25, 25, "OSError: 429"), "other": (0, 0, "KeyError: 'other'")}


def test_unique(spark):
    records = [{"prism:doi": "d", "v": 0}, {"dc:title": "t", "v": 1}, {"v": 2}, {"prism:doi": "d", "v": 3}, {"prism:doi": "", "dc:title": "t", "v": 4}]
    rows = spark.createDataFrame([("elsevier", i, json.dumps(r)) for i, r in enumerate(records)], "source string, seq long, record string")
    assert [(r.seq, json.loads(r.record)["v"]) for r in search.unique(rows).orderBy("seq").collect()] == [(0, 3), (1, 4)]


def test_unique_by_source(spark):
    rows = spark.createDataFrame([(s, i, json.dumps({"prism:doi": "d", "v": s + str(i)})) for s in ("elsevier", "springer") for i in range(2)], "source string, seq long, record string")
    assert sorted((r.source, r.seq, json.loads(r.record)["v"]) for r in search.unique(rows).collect()) == [("elsevier", 0, "elsevier1"), ("springer", 0, "springer1")]


def test_springer_candidates(spark):
    record = json.dumps({"url": [{"value": "http://x/10.1007/a-b"}, {"value": "http://y"}]})
    pages = {'<a class="c" href="/articles/s1.pdf?x=1">': "https://www.nature.com/articles/s1.pdf?x=1", "<A HREF='http://h/a.pdf'>": "http://h/a.pdf", '<a href="/a.html">': None, None: None}
    for page, link in pages.items():
        frame = spark.createDataFrame([(record, page)], "r string, page string")
        got = frame.select(search.candidate_urls("springer", F.col("r"), F.col("page")).alias("u")).first().u
        assert got == [link] * (link is not None) + [p.format("10.1007/a-b") for p in search.SPRINGER_PLACES]
    assert one(spark, search.candidate_urls, "springer", {"url": []}) == [] and one(spark, search.candidate_urls, "arxiv", {"pdf_url": "p"}) == ["p"]


def one(spark, f, source, record):
    text = record if isinstance(record, str) else json.dumps(record)
    return spark.createDataFrame([(text,)], "r string").select(f(source, F.col("r")).alias("x")).first().x


def test_licences_and_places(spark):
    cases = [
        ("springer", {"copyright": "(c) X", "license": "CC-BY 4.0"}, True),
        ("springer", {"copyright": "(c) X"}, False),
        ("elsevier", {"openaccess": "True"}, True),
        ("elsevier", {"prism:copyright": "Creative Commons"}, True),
        ("elsevier", {}, False),
        ("crossref", {"best_oa_location": None, "oa_locations": [{"license": None}, {"license": "CC-by"}]}, True),
        ("crossref", {"best_oa_location": {"license": "acc"}}, False),
        ("arxiv", {"license": "http://x/cc/1"}, True),
        ("arxiv", {"license": "nonexclusive"}, False),
        ("arxiv", {}, None),
    ]
    assert [one(spark, search.is_open, s, r) for s, r, _ in cases] == [x for *_, x in cases]
    cases = [
        ("springer", {"url": [{"value": "a"}, {"value": "b.PDF"}]}, "b.PDF"),
        ("springer", {"url": []}, None),
        ("springer", {}, None),
        ("elsevier", {"prism:doi": "10.1/x"}, "https://api.elsevier.com/content/article/doi/10.1/x"),
        ("elsevier", {}, None),
        ("crossref", {"best_oa_location": {"url_for_pdf": ""}, "oa_locations": [{"url_for_pdf": "u"}]}, "u"),
        ("crossref", "broken", None),
        ("arxiv", {"entry_id": "http://arxiv.org/abs/1"}, "http://arxiv.org/pdf/1.pdf"),
    ]
    assert [one(spark, search.pdf_url, s, r) for s, r, _ in cases] == [x for *_, x in cases]
