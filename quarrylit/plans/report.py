"""The run report: screening records joined with timing, steps, stage records, figures and their logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 40


def with_timing(records: DataFrame, timing: DataFrame, stem: str = "stem") -> DataFrame:
    """Each record with its document's timing: that of its own name, else of the first name with the same 40 characters."""
    values = [c for c in timing.columns if c not in ("pdf_name", "seq")]
    exact = timing.select(F.col("pdf_name").alias(stem), F.struct(*values).alias("__exact"))
    rough = timing.groupBy(F.substring("pdf_name", 1, PREFIX).alias("__prefix")).agg(F.min_by(F.struct(*values), "seq").alias("__rough"))
    out = records.join(exact, stem, "left").join(rough, F.substring(stem, 1, PREFIX) == F.col("__prefix"), "left")
    got = F.coalesce("__exact", "__rough")
    return out.select(*records.columns, *(got[c].alias(c) for c in values))


def paired(figures: DataFrame, logs: DataFrame, key: str = "stem") -> DataFrame:
    """Figures with the log entry at the same place of their document's list."""
    left = figures.select(key, F.posexplode("figures").alias("pos", "figure"))
    right = logs.select(key, F.posexplode("entries").alias("pos", "log"))
    return left.join(right, [key, "pos"], "left")


def first_on_page(rows: DataFrame, figures: DataFrame) -> DataFrame:
    """Crops with the first figure of their page."""
    first = figures.groupBy("stem", "page").agg(F.min_by("figure_number", "seq").alias("figure_number"))
    return rows.join(first, ["stem", "page"], "left")


def papers(screening: DataFrame, costs: DataFrame, stages: list[DataFrame] = (), key: str = "stem") -> DataFrame:
    """A row a paper: its decision, what its steps cost, and what the stages say of it."""
    out = screening.join(costs, key, "left")
    for stage in stages:
        out = out.join(stage, key, "left")
    return out


def order(decision: Column, cost: Column, seq: Column) -> list[Column]:
    """Kept papers first, dearer ones before others."""
    return [(decision != "keep").asc(), cost.desc_nulls_last(), seq.asc()]


def header(rows: DataFrame) -> DataFrame:
    """Papers, kept papers, and the mean cost of the kept (0 without any)."""
    kept = F.col("decision") == "keep"
    return rows.agg(F.count("*").alias("papers"), F.count_if(kept).alias("kept"), F.round(F.coalesce(F.avg(F.when(kept, F.col("cost"))), F.lit(0.0)), 4).alias("avg_cost"))
