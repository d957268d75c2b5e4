"""Page layout: blocks in reading order, captions, text windows, snippets, table budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylit.functions.text import sentences, unify

CAPTION_MOST, NEARBY_MOST, GAP, GAP_AFTER, JUMP = 700, 2500, 18.0, 60, 120.0


def reading_order(blocks: Column) -> Column:
    """An array of block structs by (y0, x0)."""
    return F.array_sort(F.transform(blocks, lambda b: F.struct(b["y0"], b["x0"], b["y1"], b["text"])))


# How a caption begins, and what makes a low block a footer.
LABEL = r"(?i)(fig\.|figure)\s*(\d+)\s*[:.\-]?\s*"
FOOTER = r"(?i)copyright|all rights reserved|doi|issn|\bpage\s*\d+\b"
WINDOW_SENTENCES, WINDOW_MOST, TABLES_MOST, CONTEXT_BLOCKS = 10, 6000, 2000, 12


def is_footer(y0: Column, height: Column, text: Column) -> Column:
    """Low on the page, with a publisher's words or a page number; or short, with a year."""
    year = text.rlike(r"\b(?:19|20)\d{2}\b") & (F.length(text) < 120)
    return (height > 0) & (y0 >= 0.86 * height) & (text.rlike(FOOTER) | year)


def caption_score(text: Column, y0: Column, number: Column) -> Column:
    """How well a block begins the caption of a figure; null if the first label in it is not the figure's."""
    at = F.regexp_instr(text, F.lit(LABEL)) - 1
    named = (at >= 0) & (F.regexp_extract(text, LABEL, 2) == number.cast("string"))
    return F.when(named, F.when(at == 0, 10).otherwise(0) + F.greatest(F.lit(0), 50 - at) - F.floor(y0.cast("long") / 50)).cast("long")


def caption_blocks(blocks: DataFrame, figures: DataFrame) -> DataFrame:
    """Per figure (doc_id, page, figure): the block number that begins its caption; the earlier one of equals."""
    met = figures.join(blocks, ["doc_id", "page"]).withColumn("score", caption_score(F.col("text"), F.col("y0"), F.col("figure"))).where("score is not null")
    return met.groupBy("doc_id", "page", "figure").agg(F.max_by("block_no", F.struct("score", (-F.col("block_no")).alias("first"))).alias("block_no"), F.max("score").alias("score"))


def assemble_caption(blocks: Column, begin: Column, height: Column) -> Column:
    """The caption that starts at a place (from 1) of blocks in reading order: following blocks are taken until a footer,
    a figure's caption, a gap below a caption that is long already, a jump to another column, or one that it has no room for."""
    first = blocks[begin - 1]
    rest = F.slice(blocks, begin + 1, F.greatest(F.lit(0), F.size(blocks) - begin))

    def step(acc: Column, b: Column) -> Column:
        gap = b["y0"] - acc["y1"]
        stop = (
            acc["over"]
            | is_footer(b["y0"], height, b["text"])
            | b["text"].rlike("^(?:" + LABEL + ")")
            | ((gap > GAP) & (F.length(acc["text"]) > GAP_AFTER))
            | ((F.abs(b["x0"] - acc["x0"]) > JUMP) & (gap > 2))
            | (F.length(acc["text"]) + 1 + F.length(b["text"]) > CAPTION_MOST)
        )
        text = F.when(stop, acc["text"]).otherwise(F.concat(acc["text"], F.lit(" "), b["text"]))
        return F.struct(stop.alias("over"), F.when(stop, acc["y1"]).otherwise(b["y1"]).alias("y1"), acc["x0"].alias("x0"), text.alias("text"))

    return F.trim(F.aggregate(rest, F.struct(F.lit(False).alias("over"), first["y1"].alias("y1"), first["x0"].alias("x0"), first["text"].alias("text")), step)["text"])


def nearby_text(blocks: Column, begin: Column, height: Column, n: int = 4) -> Column:
    """The next n blocks without footers, a line each, up to a figure's caption or one that the budget has no room for."""

    def step(acc: Column, b: Column) -> Column:
        footer = is_footer(b["y0"], height, b["text"])
        stop = acc["over"] | (~footer & (b["text"].rlike("^(?:" + LABEL + ")") | (acc["used"] + F.length(b["text"]) > NEARBY_MOST)))
        take = ~stop & ~footer
        return F.struct(stop.alias("over"), (acc["used"] + F.when(take, F.length(b["text"])).otherwise(0)).alias("used"), F.when(take, F.concat(acc["lines"], F.array(b["text"]))).otherwise(acc["lines"]).alias("lines"))

    start = F.struct(F.lit(False).alias("over"), F.lit(0).alias("used"), F.array().cast("array<string>").alias("lines"))
    return F.trim(F.array_join(F.aggregate(F.slice(blocks, begin + 1, n), start, step)["lines"], "\n"))


def figure_window(caption: Column, nearby: Column, tables: Column | None = None) -> Column:
    """The first sentences of a figure's caption and the text near it, with tables of the pages around."""
    blob = unify(F.concat_ws("\n", F.coalesce(caption, F.lit("")), F.coalesce(nearby, F.lit(""))))
    own = F.filter(F.transform(sentences(blob), lambda s: F.trim(s)), lambda s: s != "")
    window = F.substring(F.array_join(F.slice(own, 1, WINDOW_SENTENCES), " "), 1, WINDOW_MOST)
    if tables is None:
        return window
    return F.concat(window, F.when(F.trim(F.coalesce(tables, F.lit(""))) != "", F.concat(F.lit("\n\n[TABLES NEAR FIGURE]\n"), F.substring(tables, 1, TABLES_MOST))).otherwise(""))


def figure_context(blocks: Column, begin: Column, caption: Column, page_text: Column, most: int) -> Column:
    """The blocks from a figure's caption on (its place from 1, null if it wasn't found), else the caption and the page's text."""
    local = F.array_join(F.transform(F.slice(blocks, F.coalesce(begin, F.lit(1)), CONTEXT_BLOCKS), lambda b: b["text"]), " ")
    whole = F.concat_ws("\n", F.nullif(caption, F.lit("")), F.substring(page_text, 1, most))
    return F.substring(unify(F.when(begin.isNotNull(), local).otherwise(whole)), 1, most)


def page_captions(blocks: DataFrame, text: str = "text") -> DataFrame:
    """The blocks that name a figure or a table, with the label and the beginning of their text."""
    label = F.trim(F.regexp_extract(text, r"(?i)(fig(?:ure|\.)\s*\d+|table\s*\d+)\s*[:.\-]?\s*", 1))
    short = F.substring(F.regexp_replace(F.trim(F.col(text)), r"\s+", " "), 1, 300)
    return blocks.withColumn("label", label).withColumn("caption", short).where("label <> ''")


def snippets(pages: DataFrame, pattern: str, *, most: int = 8, around: int = 160, key: str = "doc_id") -> DataFrame:
    """The first hits of a pattern in a document, by page and place, each with the text around it."""
    lengths = F.arrays_zip(F.transform(F.slice(F.split("text", pattern, -1), 1, F.size(F.regexp_extract_all("text", F.lit(pattern), 0))), lambda x: F.length(x)).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), 0).alias("hit"))
    rows = pages.where(F.col("text").rlike(pattern)).select(key, "page", "text", F.posexplode(lengths).alias("pos", "m"))
    by_page = Window.partitionBy(key, "page").orderBy("pos")
    upto = F.sum(F.col("m.gap") + F.length("m.hit")).over(by_page)
    rows = rows.select(key, "page", "pos", (upto - F.length("m.hit")).alias("start"), F.col("m.hit").alias("hit"), "text")
    rank = F.row_number().over(Window.partitionBy(key).orderBy("page", "pos"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    begin = F.greatest(F.lit(0), F.col("start") - around // 2)
    return rows.select(key, "page", "rank", "start", "hit", F.substring("text", (begin + 1).cast("int"), (F.col("start") - begin + F.length("hit") + around // 2).cast("int")).alias("snippet"))


def within_budget(rows: DataFrame, key: str, seq: str, text: str, most: int) -> DataFrame:
    """Rows of each key, in order, while their running length with separators is within a budget, and whether the last one was cut off."""
    w = Window.partitionBy(key).orderBy(seq)
    used = F.sum(F.length(text) + 1).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(F.length(text) + 1).over(Window.partitionBy(key))
    return rows.withColumn("used", used).withColumn("truncated", total > most).where(F.col("used") <= most)


TRUNCATED = "... (truncated)"  # fixed value


def budget_text(rows: DataFrame, key: str, seq: str, text: str, most: int) -> DataFrame:
    """(key, text): the rows of each key, in order, as lines while they are within a budget, and a last line that tells of a cut."""
    w = Window.partitionBy(key).orderBy(seq)
    used = F.sum(F.length(text) + 1).over(w.rowsBetween(Window.unboundedPreceding, 0))
    kept = F.when(F.col("used") <= most, F.struct(F.col(seq).alias("seq"), F.col(text).alias("line")))
    lines = rows.withColumn("used", used).groupBy(key).agg(F.array_sort(F.collect_list(kept)).alias("l"), F.max("used").alias("total"))
    cut = F.when(F.col("total") > most, F.array(F.lit(TRUNCATED))).otherwise(F.array().cast("array<string>"))
    return lines.select(key, F.array_join(F.concat(F.transform("l", lambda x: x["line"]), cut), "\n").alias("text"))


def on_adjacent_pages(figures: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables on a figure's page or one next to it: a range join as three equal ones."""
    near = figures.withColumn("table_page", F.explode(F.array(F.col("page") - 1, F.col("page"), F.col("page") + 1)))
    return near.join(tables.withColumnRenamed("page", "table_page"), ["doc_id", "table_page"])


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")
