"""Screening and cleaning of records: gates, consolidation, material choice, ordered dedup, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylit.functions.text import is_filled


def consolidate(results: DataFrame, folder: str = "folder") -> DataFrame:
    """Totals of screening records: a recorded decision counts before the folder that a record was in."""
    decision = F.upper(F.coalesce(F.nullif(F.col("decision"), F.lit("")), F.col(folder)))
    return results.select(decision.alias("d")).agg(F.count("*").alias("total"), F.count_if(F.col("d") == "KEEP").alias("kept"), F.count_if(F.col("d") == "REJECT").alias("rejected"), F.count_if(~F.col("d").isin("KEEP", "REJECT") | F.col("d").isNull()).alias("errors"))


def decisions(files: DataFrame, text: str = "value", folder: str = "folder") -> DataFrame:
    """The screening files (their text, the label of their folder, other columns kept) with decision and error.

    A recorded decision, in capitals, counts before the folder's; a file that isn't a record, or whose decision isn't a text in a
    record of its own, stays a row, with its folder's decision and `parse_failed`."""
    v = F.try_parse_json(text)
    kind = lambda c: F.coalesce(F.schema_of_variant(c), F.lit("VOID"))
    at = lambda path: F.try_variant_get(v, path, "variant")
    empty = lambda c: (kind(c) == "VOID") | F.coalesce(F.to_json(c), F.lit("null")).isin('""', "[]", "{}", "0", "0.0", "false", "null")
    inner, said = at("$.decision"), at("$.decision.decision")
    is_object = lambda c: F.startswith(kind(c), F.lit("OBJECT"))
    readable = is_object(v) & (empty(inner) | (is_object(inner) & (empty(said) | (kind(said) == "STRING"))))
    recorded = F.when(readable & ~empty(said), F.upper(F.try_variant_get(v, "$.decision.decision", "string")))
    return files.select(*(c for c in files.columns if c not in (text, folder)), F.coalesce(recorded, F.col(folder)).alias("decision"), F.when(~F.coalesce(readable, F.lit(False)), "parse_failed").alias("error"))


def first_per(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in an order that ties must not leave open (a window group limit)."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("__rank") <= n).drop("__rank")


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Per key its last row's values, at its first row's place: an aggregation, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, seq)]
    return rows.groupBy(key).agg(F.min(seq).alias(seq), F.max_by(F.struct(*rest), seq).alias("__last")).select(key, seq, *(F.col(f"__last.{c}").alias(c) for c in rest))


def licensed(text: Column) -> Column:
    """Whether a text names a Creative Commons licence."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return low.contains("creativecommons") | low.contains("creative commons") | low.contains("/cc/") | low.startswith("cc")


def ordered_distinct(values: Column) -> Column:
    """Entries without repeats in either case, white space unified and empty ones left out, first spellings in order.

    Linear in the array's distinct entries squared; for arrays of a record, not for a corpus (use `distinct_rows`)."""
    clean = F.filter(F.transform(values, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    add = lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(clean, F.array().cast("array<string>"), add)


def distinct_rows(rows: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The same over rows: per key and lower-cased value the first spelling and its place."""
    clean = F.trim(F.regexp_replace(F.col(value), r"\s+", " "))
    named = rows.select(key, clean.alias("v"), seq).where("v <> ''")
    return named.groupBy(key, F.lower("v").alias("folded")).agg(F.min_by("v", seq).alias(value), F.min(seq).alias(seq)).drop("folded")


def first_filled(*candidates: Column) -> Column:
    """The first candidate with text, trimmed; empty without one."""
    return F.coalesce(*(F.when(is_filled(c), F.trim(c)) for c in candidates), F.lit(""))


def filled_count(record: list[Column]) -> Column:
    """How many fields have something: strings with text, lists and maps with entries."""
    out = F.lit(0)
    for c in record:
        out = out + c.cast("int")
    return out


def supported(verdicts: Column) -> Column:
    """Of a map field -> (status, ...), those that are supported or unclear."""
    return F.map_filter(verdicts, lambda _, v: v["status"].isin("supported", "unclear"))


def final_value(candidate: Column, corrected: Column) -> Column:
    return F.coalesce(F.nullif(corrected, F.lit("")), candidate)


def flatten_verified(block: Column) -> Column:
    return F.transform_values(block, lambda _, v: v["value"])


def verify_gate(signals: Column, least: int, **skips: Column) -> Column:
    """(run, reasons): run unless signals are too few or a named condition holds."""
    reasons = F.array_compact(F.array(F.when(signals < least, "few_signals"), *(F.when(c, name) for name, c in skips.items())))
    return F.struct((F.size(reasons) == 0).alias("run"), reasons.alias("reasons"))


def cache_misses(calls: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Calls whose key no cached reply has."""
    return calls.join(cache.select(key), key, "left_anti")


def call_key(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("\x1f", *parts))


def newest(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy(F.desc("modificationTime"), "path").limit(n)
