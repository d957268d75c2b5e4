"""The literature source, the ledger, attribution by time, and phases of a log stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quarrylit.operators import ordered
from quarrylit.operators.records import FILE_BYTES
from quarrylit.sources import ledger, literature
from quarrylit.streaming import phases


def store(n, fail_at=None):
    def fetch(query, start, size):
        if fail_at is not None and start >= fail_at:
            raise OSError("429")
        return [{"i": i, "publicationName": f"J{i % 3}", "publicationDate": f"{2000 + i}-01-02"} for i in range(start, min(n, start + size))]

    return fetch


def test_literature_pages(spark):
    literature.register(spark, {"springer": literature.Store(store(60)), "elsevier": literature.Store(store(55), lambda q: 55), "arxiv": literature.Store(store(10**6, 50))})
    read = lambda source, target: spark.read.format("literature").option("source", source).option("query", "q").option("target", target).load()
    springer = read("springer", 1)
    assert springer.rdd.getNumPartitions() == 15  # how far it may go
    got = literature.complete(springer).collect()
    assert sorted(r.seq for r in got) == list(range(59)) and not any(r.error for r in got)
    assert read("elsevier", 20).rdd.getNumPartitions() == 3  # 55 records, told by the store, of 100 that may be asked for
    assert literature.complete(read("elsevier", 20)).count() == 55
    failed = literature.complete(read("arxiv", 6)).orderBy("seq").collect()
    assert [r.error for r in failed if r.error] == ["OSError: 429"] and len(failed) == 51 and failed[-1].seq == 50
    some = springer.where(F.col("journal").isin("J1") & (F.col("year") >= 2010) & (F.col("year") < 2040))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(json.loads(r.record)["i"] for r in literature.complete(some).collect()) == [i for i in range(1, 60) if i % 3 == 1 and 10 <= i < 40]
    assert "Filter" not in plan  # taken by the source, not left to a filter above it
    with pytest.raises(Exception, match="no source"):
        read("nowhere", 1).collect()


def test_download_waves(spark, tmp_path):
    big = b"x" * (FILE_BYTES + 1)
    answers = {"good": (200, "application/PDF", big), "html": (200, "text/html", big), "small": (200, "application/pdf", b"x"), "gone": (404, "application/pdf", big)}
    names = ["there", "html", "small", "gone", "fails", None, "good", "good", "good"]
    rows = spark.createDataFrame([(s, i, n or "null", n) for s in ("arxiv", "springer") for i, n in enumerate(names)], "source string, seq long, name string, url string")
    got = literature.download(rows, answers.__getitem__, 2, f"{tmp_path}/a", spark.createDataFrame([("there",), ("there",)], "name string")).collect()
    by = {s: [(r.name, r.status) for r in sorted(got, key=lambda r: r.seq) if r.source == s] for s in ("arxiv", "springer")}
    assert by["arxiv"] == [("there", "exists"), ("html", "refused"), ("small", "refused"), ("gone", "refused"), ("fails", "refused"), ("null", "refused"), ("good", "kept")]
    assert by["springer"] == [("there", "exists"), ("html", "refused"), ("small", "kept")]
    assert all((r.content is not None) == (r.status == "kept") for r in got)
    assert spark.read.parquet(f"{tmp_path}/a/files").where("source = 'arxiv'").count() <= 2 * 7  # fetches, against those needed
    several = rows.limit(1).withColumn("urls", F.array(F.lit("gone"), F.lit("fails"), F.lit("good"))).drop("url")
    assert [r.status for r in literature.download(several, answers.__getitem__, 1, f"{tmp_path}/c").collect()] == ["kept"]
    assert literature.download(rows.limit(0), answers.__getitem__, 2, f"{tmp_path}/b").count() == 0


def test_second_lookup(spark):
    records = spark.createDataFrame([("crossref", "q", i, json.dumps(r)) for i, r in enumerate([{"DOI": "10.1/a"}, {"DOI": ""}, {}, {"DOI": "10.1/none"}, {"DOI": "10.1/fails"}])] + [("crossref", "q", 9, None)], "source string, query string, seq long, record string")
    answers = {"10.1/a": {"best_oa_location": {"url_for_pdf": "u", "license": "cc-by"}}, "10.1/none": None}
    got = literature.looked_up(records, answers.__getitem__).collect()
    assert [(r.seq, r.doi, json.loads(r.record)) for r in got] == [(0, "10.1/a", answers["10.1/a"])]


def test_ledger(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    ledger.register(spark)
    rows = spark.createDataFrame([("r1", f"f{i % 5}", i, [str(i)], None) for i in range(20)] + [("r1", None, 99, [], 1.5)], "run string, file string, n long, tags array<string>, x double").repartition(3)
    # a task that fails after another has written leaves nothing to see
    with pytest.raises(Exception):
        ledger.append(rows.repartition(4).withColumn("n", F.when(F.col("n") == 7, F.raise_error("lost").cast("long")).otherwise(F.col("n"))), path, ["run", "file"])
    with pytest.raises(Exception, match="nothing has been committed"):
        spark.read.format("ledger").load(path).count()
    ledger.append(rows, path, ["run", "file"])
    ledger.append(rows, path, ["run", "file"])
    more = spark.createDataFrame([("r1", "f1", 500, [], 0.0), ("r2", "f1", 501, ["é"], 0.0)], rows.schema)
    ledger.append(more, path, ["run", "file"], batch="b-1")
    ledger.append(spark.createDataFrame([("r3", "f", 7, [], None)], rows.schema), path, ["run", "file"], batch="b-1")  # the batch is there already
    there = spark.read.format("ledger").load(path)
    assert sorted(r.n for r in there.collect()) == [*range(20), 99, 501]
    assert there.where("run = 'r2'").first().tags == ["é"]
    with pytest.raises(ValueError):
        ledger.append(rows.drop("x"), path, ["run", "file"])
    with pytest.raises(Exception):
        rows.write.format("ledger").mode("overwrite").save(path)


@pytest.mark.parametrize("segments", [1, 5, 64])
def test_attributed(spark, segments):
    rng = random.Random(4)
    calls = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *range(100)]), "x") for i in range(400)]
    marks = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 90)]), rng.choice(["d1", "d2", "d3", None])) for _ in range(60)]
    got = ordered.attributed(spark.createDataFrame(calls, "id long, worker string, at int, value string"), spark.createDataFrame(marks, "worker string, at int, document string"), by="worker", at="at", value="document", segments=segments)
    assert got.columns == ["id", "worker", "at", "value", "document"]

    def last(worker, at):
        own = [(t, d is not None, d or "") for w, t, d in marks if w is not None and w == worker and t is not None and at is not None and t <= at]
        return (max(own)[2] or None) if own else None

    assert {r.id: r.document for r in got.collect()} == {i: last(w, t) for i, w, t, _ in calls}
    empty = spark.createDataFrame([], "worker string, at int, document string")
    assert {r.document for r in ordered.attributed(spark.createDataFrame(calls, "id long, worker string, at int, value string"), empty, by="worker", at="at", value="document").collect()} == {None}


def test_numbered(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = ordered.numbered(rows.repartition(6), ["k"], f"{tmp_path}/n").collect()
    assert len(got) == 1000 and all(r.k == r.seq for r in got)


LINES = [
    "Starting arXiv download phase", "[OK] Downloaded a.pdf", "Starting Phase 0", "Phase 1 skipped", "Starting phase 2", "noise", None, "Pipeline completed", "Starting Phase 2", "Starting JSON clean agent", "JSON clean agent skipped",
]


def states(lines):
    """Line by line."""
    info = dict.fromkeys(phases.PHASES, "Idle")
    for text in lines:
        low = (text or "").lower()
        for phase, (runs, skips) in phases.PHASES.items():
            if any(t in low for t in runs):
                info[phase] = "Running"
            if any(t in low for t in skips):
                info[phase] = "Skipped"
        if phases.COMPLETED in low:
            info = {k: "Done" if v == "Running" else v for k, v in info.items()}
    return info


def test_phases(spark, tmp_path):
    rng = random.Random(7)
    runs = {"a": LINES, "b": LINES[:5], "c": ["noise"], "d": [rng.choice(LINES) for _ in range(60)], "e": ["Starting phase 1, pipeline completed"], "23:59 to 00:01": LINES[2:5]}
    rows = [(run, n, text) for run, texts in runs.items() for n, text in enumerate(texts)]
    want = {(run, p): s for run, texts in runs.items() for p, s in states(texts).items()}
    batch = spark.createDataFrame(rows, "run string, line long, message string")
    assert {(r.run, r.phase): r.status for r in phases.statuses(batch).collect()} == want
    rng.shuffle(rows)
    for i in range(3):
        spark.createDataFrame(rows[i::3], batch.schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    got = {}
    try:
        lines = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")

        def take(frame, _):
            got.update({(r.run, r.phase): r.status for r in frame.collect()})

        query = phases.watched(lines).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    assert got == {k: v for k, v in want.items() if k[0] != "c"}  # a run without marks has no state


def test_failed(spark):
    cases = [("Traceback (most recent call last)", 1, True), ("RuntimeError: x", None, True), ("an Exception", 0, False), ("Pipeline failed", 2, True), ("all errors fixed", 1, False), ("", 1, False), (None, None, False)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, code int, want boolean")
    assert all(r.got == r.want for r in rows.withColumn("got", phases.failed(F.col("t"), F.col("code"))).collect())
