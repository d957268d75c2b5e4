"""Pictures of a record's figures: five ways to find them, in one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stages whose records name pictures, in the order that they are read.
STAGES = ("__phase1_raw.json", "__phase2_enriched.json")
FOLDER = "__XRD_ONLY"


def _name(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(F.coalesce(path, F.lit(""))), r"([^/\\]*)$", 1))


def _stage(path: Column) -> Column:
    return F.coalesce(*(F.when(path.endswith(s), i) for i, s in enumerate(STAGES)))


def _base(path: Column) -> Column:
    out = F.regexp_extract(path, r"([^/]*)$", 1)
    for s in STAGES:
        out = F.regexp_replace(out, s.replace(".", "[.]") + "$", "")
    return out


#: The most figures of one path that are sent to one task.
FREQUENT = 1000


def _existing(figures: DataFrame, files: DataFrame) -> DataFrame:
    """The figures whose path is among the files.  A path that very many figures name would come into one task with all of them, so
    such paths, few as they are, are looked up by themselves and told to every task."""
    often = figures.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > FREQUENT).select("path")
    there = often.join(files, "path", "left_semi")
    rest = figures.join(F.broadcast(often), "path", "left_anti").join(files, "path", "left_semi")
    return rest.unionByName(figures.join(F.broadcast(there), "path", "left_semi"))


def pictures(wanted: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    """(id, place, path, caption, level) of every picture of the wanted records, in order.

    wanted: id, json_path, base, pdf.  records: json_path, pdf, figures (an array of path, number, page, caption), of the wanted
    ones and all others.  files: path, of all pictures that exist.  Pictures come (1) from the record itself, (2) from
    its siblings of either stage, (3) if there are none so far, from any stage record of the same PDF; (4) from the folder of its base;
    (5) if there are still none, from the folders whose first stage names the same PDF.  A picture that comes twice counts where it came first.

    Each wanted record is five keys and each picture the keys that it is found by, so all five ways are one join; what a way
    may add is told from the ways before it, by an aggregate over the record's matches."""
    figures = records.select("json_path", "pdf", F.posexplode("figures").alias("at", "f"))
    label = F.array_join(F.array_compact(F.array(F.concat(F.lit("Figure "), F.nullif(F.col("f.number").cast("string"), F.lit(""))), F.concat(F.lit("page "), F.nullif(F.col("f.page").cast("string"), F.lit(""))), F.nullif(F.trim("f.caption"), F.lit("")))), " • ")
    figures = figures.select("json_path", "pdf", "at", F.col("f.path").alias("path"), label.alias("label"))
    figures = _existing(figures, files.select("path").distinct())
    stage = _stage(F.col("json_path"))
    caption = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.regexp_extract("path", r"([^/]*)$", 1)).alias("caption")
    order = F.struct(F.coalesce(stage, F.lit(-1)).alias("stage"), F.col("json_path").alias("file"), F.col("at").alias("at")).alias("order")
    keys = [F.struct(F.lit(1).alias("level"), F.col("json_path").alias("key")), F.when(stage.isNotNull(), F.struct(F.lit(2).alias("level"), _base(F.col("json_path")).alias("key"))), F.when(stage.isNotNull() & (_name(F.col("pdf")) != ""), F.struct(F.lit(3).alias("level"), _name(F.col("pdf")).alias("key")))]
    named = figures.select(F.explode(F.array_compact(F.array(*keys))).alias("k"), "path", caption, order)
    inside = files.select("path", F.regexp_extract("path", rf"([^/]*){FOLDER}/[^/]*\.png$", 1).alias("base")).where("base <> ''")
    stage_pdf = records.where(F.col("json_path").endswith(STAGES[0])).groupBy(_base(F.col("json_path")).alias("base")).agg(F.min(_name(F.col("pdf"))).alias("pdf"))
    inside = inside.join(stage_pdf, "base", "left")
    keys = [F.struct(F.lit(4).alias("level"), F.col("base").alias("key")), F.when(F.coalesce("pdf", F.lit("")) != "", F.struct(F.lit(5).alias("level"), F.col("pdf").alias("key")))]
    order = F.struct(F.lit(9).alias("stage"), F.col("base").alias("file"), F.lit(0).alias("at")).alias("order")
    found = named.unionByName(inside.select(F.explode(F.array_compact(F.array(*keys))).alias("k"), "path", F.regexp_extract("path", r"([^/]*)$", 1).alias("caption"), order))
    found = found.select("k.level", "k.key", "path", "caption", "order")
    asked = [F.struct(F.lit(n).alias("level"), F.nullif(c, F.lit("")).alias("key")) for n, c in ((1, F.col("json_path")), (2, F.col("base")), (3, _name(F.col("pdf"))), (4, F.col("base")), (5, _name(F.col("pdf"))))]
    met = wanted.select("id", F.explode(F.array(*asked)).alias("k")).select("id", "k.level", "k.key").join(found, ["level", "key"])
    # the levels that a record has pictures on, then one row a record and path, where it came first
    have = F.collect_set("level").over(Window.partitionBy("id"))
    met = met.withColumn("have", have)
    before = lambda *levels: ~F.arrays_overlap("have", F.array(*(F.lit(x) for x in levels)))
    counts = F.col("level").isin(1, 2, 4) | ((F.col("level") == 3) & before(1, 2)) | ((F.col("level") == 5) & before(1, 2, 3, 4))
    one = met.where(counts).groupBy("id", "path").agg(F.min(F.struct("level", "order", "caption")).alias("m"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("m.level", "m.order", "path"))
    return one.select("id", place.alias("place"), "path", F.col("m.caption").alias("caption"), F.col("m.level").alias("level"))
