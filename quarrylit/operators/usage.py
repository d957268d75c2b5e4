"""Model-usage accounting: prices, costs, roll-ups.  Costs are added in whole millionths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# USD per million tokens of input and output.
PRICES = {
    "gpt-4o": (2.50, 10.00), "gpt-4o-mini": (0.15, 0.60), "gpt-4.1": (2.00, 8.00), "gpt-4.1-mini": (0.40, 1.60), "gpt-4.1-nano": (0.10, 0.40),
    "o3": (2.00, 8.00), "o3-mini": (1.10, 4.40), "o4-mini": (1.10, 4.40), "gpt-5.2": (2.00, 8.00), "grok-3": (3.00, 15.00), "grok-3-mini": (0.30, 0.50),
    "gemini-2.5-pro": (1.25, 10.00), "gemini-2.5-flash": (0.15, 0.60), "gemini-2.0-flash": (0.10, 0.40),
    "claude-sonnet-4-20250514": (3.00, 15.00), "claude-haiku-4-5-20251001": (0.80, 4.00), "deepseek-chat": (0.27, 1.10), "deepseek-reasoner": (0.55, 2.19),
    "llama-3.3-70b-versatile": (0.59, 0.79), "meta-llama/Llama-3.3-70B-Instruct-Turbo": (0.88, 0.88), "meta-llama/Llama-3.2-90B-Vision-Instruct-Turbo": (1.20, 1.20),
    "meta-llama/Llama-4-Maverick-17B-128E-Instruct-FP8": (0.27, 0.85), "meta-llama/Llama-4-Scout-17B-16E-Instruct": (0.18, 0.59),
    "deepseek-ai/DeepSeek-R1": (3.00, 7.00), "Qwen/Qwen2.5-72B-Instruct-Turbo": (0.60, 0.60),
}
DEFAULT_PRICE = (2.00, 8.00)
STEPS = {"phase0": "s0", "phase1": "s1", "phase1_agent": "s1", "phase2": "s2", "phase2_agent": "s2", "phase3": "s3", "phase3_agent": "s3"}


def price(model: Column, prices: dict[str, tuple[float, float]] | None = None, default: tuple[float, float] = DEFAULT_PRICE) -> Column:
    """(input, output, matched) of the longest listed name that the model's begins with, else the default.

    The price list is a constant, so the prefix join is an expression: names from the longest down, the first that fits."""
    made = lambda p, k: F.struct(F.lit(p[0]).alias("input"), F.lit(p[1]).alias("output"), F.lit(k).alias("matched"))
    table = PRICES if prices is None else prices
    out = None
    for k in sorted(table, key=lambda k: (-len(k), k)):
        test = F.startswith(model, F.lit(k))
        out = F.when(test, made(table[k], k)) if out is None else out.when(test, made(table[k], k))
    rest = made(default, "")
    return rest if out is None else out.otherwise(rest)


def cost(calls: DataFrame, prices: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The calls (model, input_tokens, output_tokens) with their price and cost in USD, 6 decimals."""
    priced = calls.withColumn("price", price(F.col("model"), prices))
    usd = F.col("input_tokens") / 1e6 * F.col("price.input") + F.col("output_tokens") / 1e6 * F.col("price.output")
    return priced.withColumn("cost_usd", F.floor(usd * 1e6 + 0.5) / 1e6)  # halves go up, in any engine


def summed(c: Column) -> Column:
    """A sum of costs in whole millionths: the same in any order of addition."""
    return F.sum(F.round(c * 1e6).cast("long")) / 1e6


def _sums() -> tuple[Column, ...]:
    return (F.count("*").alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), summed(F.col("cost_usd")).alias("cost_usd"), F.round(F.sum("wall_seconds"), 3).alias("wall_seconds"))


def by_phase(calls: DataFrame) -> DataFrame:
    return calls.groupBy("phase").agg(*_sums())


def with_total(calls: DataFrame) -> DataFrame:
    """Per phase and, with the phase `TOTAL`, over all of them: one shuffle."""
    return calls.rollup("phase").agg(*_sums(), F.grouping("phase").alias("g")).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("phase")).alias("phase"), "requests", "input_tokens", "output_tokens", "cost_usd", "wall_seconds")


def by_document(calls: DataFrame) -> DataFrame:
    """Per document and phase, and per document (phase `TOTAL`); calls without a document are `unknown`."""
    named = calls.withColumn("pdf_name", F.when(F.coalesce(F.col("pdf_name"), F.lit("")) == "", "unknown").otherwise(F.col("pdf_name")))
    sets = named.groupingSets([["pdf_name", "phase"], ["pdf_name"]], "pdf_name", "phase").agg(F.count("*").alias("calls"), summed(F.col("cost_usd")).alias("cost"), F.round(F.sum("wall_seconds"), 3).alias("wall"), F.grouping("phase").alias("g"))
    return sets.select("pdf_name", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("phase")).alias("phase"), "calls", "cost", "wall")


def step_of(phase: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in STEPS.items() for x in kv))[phase]


def step_costs(calls: DataFrame) -> DataFrame:
    """Per document: cost and calls of each of the four steps, 0 where there are none."""
    out = [f(c).alias(f"{n}_{s}") for s in ("s0", "s1", "s2", "s3") for n, c, f in (("cost", F.when(F.col("step") == s, F.col("cost_usd")).otherwise(0.0), summed), ("calls", F.col("step") == s, F.count_if))]
    return calls.withColumn("step", step_of(F.col("phase"))).groupBy("pdf_name").agg(*out)


def tool_counts(traces: DataFrame) -> DataFrame:
    """How often each tool of the traces (array of structs with a tool) was called."""
    return traces.select(F.explode("agent_trace").alias("t")).groupBy(F.col("t.tool").alias("tool")).count()
