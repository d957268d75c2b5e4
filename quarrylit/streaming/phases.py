"""State of a run's phases from its log lines, as a batch and as a stream with keyed state.

A line may say that a phase starts, goes on or was skipped; the last such line of a phase counts.  The completion marker turns
what runs by then into Done; a phase that starts again after it is Running again.  Both follow from the last line of each phase and
the last completion, so lines may arrive in any order: they are told by their numbers, not by clocks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Phases in the order that they are shown, with what lines hold that start them, carry them on, and skip them.
PHASES = {
    "download": (("starting arxiv download phase", "starting springer download phase", "starting elsevier download phase", "starting crossref + unpaywall download phase", "[ok] downloaded", "downloaded oa pdf", "downloaded arxiv pdf", "already exists"), ()),
    "phase0": (("starting phase 0",), ("phase 0 skipped",)),
    "phase1": (("starting phase 1",), ("phase 1 skipped",)),
    "phase2": (("starting phase 2",), ("phase 2 skipped",)),
    "cleaner": (("starting json clean agent",), ("json clean agent skipped",)),
    "verifier": (("starting json verify agent",), ("json verify agent skipped",)),
}
COMPLETED = "pipeline completed"


def marks(lines: DataFrame, run: str = "run", line: str = "line", message: str = "message") -> DataFrame:
    """(run, line, phase, status) of what lines say; the completion marker is the phase ''.  Lines without a mark are gone."""
    low = F.lower(F.coalesce(F.col(message), F.lit("")))
    has = lambda texts: [F.contains(low, F.lit(t)) for t in texts]

    def any_of(tests: list[Column]) -> Column:
        return F.array_contains(F.array(*tests), True) if tests else F.lit(False)

    said = [F.when(any_of(has(skips)), F.struct(F.lit(p).alias("phase"), F.lit("Skipped").alias("status"))).when(any_of(has(runs)), F.struct(F.lit(p).alias("phase"), F.lit("Running").alias("status"))) for p, (runs, skips) in PHASES.items()]
    said.append(F.when(F.contains(low, F.lit(COMPLETED)), F.struct(F.lit("").alias("phase"), F.lit("Done").alias("status"))))
    found = lines.select(F.col(run).alias("run"), F.col(line).cast("long").alias("line"), F.explode(F.array_compact(F.array(*said))).alias("m"))
    return found.select("run", "line", "m.phase", "m.status")


def _now(status: Column, line: Column, completed: Column) -> Column:
    return F.when((status == "Running") & F.coalesce(completed >= line, F.lit(False)), "Done").otherwise(F.coalesce(status, F.lit("Idle")))


def statuses(lines: DataFrame, run: str = "run", line: str = "line", message: str = "message") -> DataFrame:
    """(run, phase, status) of every phase of each run that has lines, Idle where none told of it.  One row a run and phase is
    what is shuffled."""
    runs = lines.select(F.col(run).alias("run"), F.explode(F.array(F.lit(""), *(F.lit(p) for p in PHASES))).alias("phase"))
    whole = marks(lines, run, line, message).unionByName(runs.select("run", "phase"), allowMissingColumns=True)
    last = whole.groupBy("run", "phase").agg(F.max(F.when(F.col("line").isNotNull(), F.struct("line", "status"))).alias("m"))
    by = last.groupBy("run").agg(F.max(F.when(F.col("phase") == "", F.col("m.line"))).alias("completed"), F.collect_list(F.when(F.col("phase") != "", F.struct("phase", "m"))).alias("phases"))  # six a run
    out = by.select("run", "completed", F.explode("phases").alias("p"))
    return out.select("run", "p.phase", _now(F.col("p.m.status"), F.col("p.m.line"), F.col("completed")).alias("status"))


# What the summary of a log says, and what marks an error in one.
DOWNLOADED = ("[ok] downloaded", "downloaded oa pdf", "downloaded arxiv pdf")
PROGRESS = (("Step I", ("starting phase 1",)), ("Step II", ("starting phase 2",)), ("JSON cleaner", ("starting json clean",)), ("JSON verifier", ("starting json verify",)))
AGENTS = {"JSON cleaner": "json clean agent", "JSON verifier": "json verify agent"}
ERRORS = ("traceback", "runtimeerror", "exception", "pipeline failed")
SHOWN = 8


def summaries(lines: DataFrame, run: str = "run", line: str = "line", message: str = "message") -> DataFrame:
    """(run, summary): the last downloads of each run, and how far its steps have come, as text.

    Flags are told by partial aggregates; of downloads the last eight are kept where the lines are, before any are brought together."""
    text = F.coalesce(F.col(message), F.lit(""))
    low = F.lower(text)
    has = lambda t: F.contains(low, F.lit(t))
    any_of = lambda ts: F.array_contains(F.array(*(has(t) for t in ts)), True)
    began = {n: any_of(ts) | (has(AGENTS[n]) & has("starting") if n in AGENTS else F.lit(False)) for n, ts in PROGRESS}
    rows = lines.select(F.col(run).alias("run"), F.col(line).alias("line"), text.alias("message"), any_of(DOWNLOADED).alias("got"), has("already exists").alias("there"), has(COMPLETED).alias("done"), *(c.alias(n) for n, c in began.items()))
    flags = rows.groupBy("run").agg(*(F.bool_or(c).alias(c) for c in ("got", "there", "done", *began)))
    part = F.pmod(F.xxhash64("line"), F.lit(32))
    first = F.row_number().over(Window.partitionBy("run", part).orderBy(F.desc("line")))
    some = rows.where("got").withColumn("n", first).where(F.col("n") <= SHOWN)  # a run's lines in parts, eight of each at most
    some = some.withColumn("n", F.row_number().over(Window.partitionBy("run").orderBy(F.desc("line")))).where(F.col("n") <= SHOWN)
    shown = some.groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "message"))), lambda x: F.concat(F.lit("- "), x["message"])).alias("shown"))
    head = F.when(F.col("got"), F.concat(F.array(F.lit("Downloaded files:")), F.col("shown"))).when(F.col("there"), F.array(*(F.lit(x) for x in ("Download phase:", "- Files already exist.", "- See the detailed log below for file names.")))).otherwise(F.array(F.lit("No completed downloads yet.")))
    state = [F.concat(F.lit(f"- {n}: "), F.when(F.col(n), "started").otherwise("not started")) for n, _ in PROGRESS]
    tail = F.array(F.lit(""), F.lit("Framework progress:"), *state, F.concat(F.lit("- Pipeline: "), F.when(F.col("done"), "completed").otherwise("running")))
    return flags.join(shown, "run", "left").select("run", F.array_join(F.concat(head, tail), "\n").alias("summary"))


def failed(text: Column, return_code: Column) -> Column:
    """Whether a run's text tells of an error; a run that returned 0 has none."""
    told = F.array_contains(F.array(*(F.contains(F.lower(text), F.lit(t)) for t in ERRORS)), True)
    return F.coalesce(told, F.lit(False)) & ~F.coalesce(return_code == 0, F.lit(False))


class _Phases(StatefulProcessor):
    """Per run, each phase's last line and status, and the last completion; given up some time after a completion."""

    def __init__(self, keep_seconds: int):
        self.keep = keep_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getMapState("last", "phase string", "line long, status string")
        self.completed = handle.getValueState("completed", "line long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        done = self.completed.get()
        done = done[0] if done else None
        ended, seen = done is not None, {}
        for r in rows:
            if r.phase == "":
                done = r.line if done is None else max(done, r.line)
            else:
                seen[r.phase] = max(seen.get(r.phase, (-1, "")), (r.line, r.status))
        for phase, new in seen.items():
            old = self.last.getValue((phase,)) if self.last.containsKey((phase,)) else None
            if old is None or tuple(old) < new:
                self.last.updateValue((phase,), new)
        if done is not None:
            self.completed.update((done,))
            if not ended:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep)
        for phase in PHASES:
            line, status = self.last.getValue((phase,)) if self.last.containsKey((phase,)) else (None, "Idle")
            yield Row(run=key[0], phase=phase, status="Done" if status == "Running" and done is not None and done >= line else status)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        self.completed.clear()
        return iter(())

    def close(self) -> None:
        pass


def watched(lines: DataFrame, run: str = "run", line: str = "line", message: str = "message", keep_seconds: int = 86_400) -> DataFrame:
    """A stream of (run, phase, status): all phases of each run that a batch of lines tells something of.

    State is kept by run and in RocksDB; the session needs that state store.  A timer clears a run a day after it completed."""
    return marks(lines, run, line, message).groupBy("run").transformWithState(_Phases(keep_seconds), "run string, phase string, status string", "Update", "ProcessingTime")
