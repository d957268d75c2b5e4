"""Model calls behind an interface: requests in, replies out, in partitions; cached replies are not asked for again."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylit.functions.text import first_json, inferred_confidence
from quarrylit.operators.screening import cache_misses, call_key


class ModelClient(Protocol):
    def reply(self, prompt: str) -> str: ...


class RuleClient:
    """Replies without a model: keeps a text that holds enough of the words."""

    def __init__(self, words: list[str], least: int = 2):
        self.words, self.least = [w.lower() for w in words], least

    def reply(self, prompt: str) -> str:
        n = sum(w in prompt.lower() for w in self.words)
        return f'{{"decision": "{"keep" if n >= self.least else "reject"}", "confidence": {min(1.0, n / max(1, len(self.words))):.2f}, "reason": "{n} words"}}'


def ask(requests: DataFrame, client: ModelClient, cache: DataFrame | None = None) -> DataFrame:
    """(key, reply, error) for each distinct prompt; a failed call is a row with its error, not a failed task."""
    keyed = requests.select(call_key(F.col("prompt")).alias("key"), "prompt").dropDuplicates(["key"])
    missing = cache_misses(keyed, cache, "key") if cache is not None else keyed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, prompt in zip(batch["key"], batch["prompt"], strict=True):
                try:
                    out.append((key, client.reply(prompt), None))
                except Exception as e:
                    out.append((key, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "reply", "error"]).astype(object)

    new = missing.mapInPandas(run, "key string, reply string, error string")
    return new if cache is None else new.unionByName(cache.join(keyed.select("key"), "key", "left_semi").select("key", "reply", F.lit(None).cast("string").alias("error")))


def decisions(replies: DataFrame) -> DataFrame:
    """Screening decisions of replies: unknown ones and failed calls are rejected with what is known."""
    parsed = replies.withColumn("r", F.from_json(first_json(F.col("reply")), "decision string, confidence double, reason string"))
    word = F.lower(F.trim(F.col("r.decision")))
    decision = F.when(F.col("error").isNotNull(), "error").when(word == "keep", "keep").otherwise("reject")
    return parsed.select("key", decision.alias("decision"), inferred_confidence(F.col("r.confidence"), F.col("r.reason")).alias("confidence"), F.coalesce("r.reason", "error", F.lit("")).alias("reason"))
