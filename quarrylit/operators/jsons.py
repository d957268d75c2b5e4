"""JSON documents: leaves with their paths, and differences of two documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def depth(json: Column) -> Column:
    """How deep the objects and lists of a JSON text are nested, told from its brackets outside of strings."""
    brackets = F.regexp_replace(F.regexp_replace(json, r'(?s)"(?:[^"\\]++|\\.)*+"', ""), r"[^{}\[\]]", "")
    step = lambda n, c: n["now"] + F.when(c.isin("{", "["), 1).otherwise(-1)
    return F.aggregate(F.filter(F.split(brackets, ""), lambda c: c != ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda n, c: F.struct(step(n, c).alias("now"), F.greatest(n["most"], step(n, c)).alias("most")))["most"]


def leaves(docs: DataFrame, key: str, json: str) -> DataFrame:
    """(key, path, value) of every scalar of a document, however deep; documents that don't parse have none.

    One explode a level, as many as the deepest document needs, which one pass over the texts tells; what is a scalar already
    goes through the levels below as it is, so that a document is parsed once."""
    v = F.try_parse_json(json)
    levels = docs.agg(F.max(F.when(v.isNotNull(), depth(F.col(json))))).first()[0] or 0
    level = docs.select(key, F.lit("").alias("path"), v.alias("v")).where("v is not null")
    for _ in range(levels):
        kind = F.schema_of_variant("v")
        name = f"__leaves_{id(level)}"
        level.withColumn("nested", F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))).createOrReplaceTempView(name)
        level = docs.sparkSession.sql(
            f"select `{key}`, case when not nested then path when e.key is null then concat(path, '[', e.pos, ']') when path = '' then e.key else concat(path, '.', e.key) end as path, if(nested, e.value, v) as v "
            f"from {name}, lateral variant_explode_outer(if(nested, v, null)) as e where not nested or e.pos is not null"
        )
        docs.sparkSession.catalog.dropTempView(name)
    return level.select(key, "path", F.try_variant_get("v", "$", "string").alias("value"))


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Leaves that two sets of documents don't share: added, removed or changed."""
    met = left.withColumnRenamed("value", "old").join(right.withColumnRenamed("value", "new"), [key, "path"], "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return met.where(~F.col("old").eqNullSafe(F.col("new"))).select(key, "path", "old", "new", change.alias("change"))
