"""Filter interaction audit: what each of several filters removes under every order of applying them.

Documents become mask cells: one bit a failed filter, counted by part with the good and the toxic
documents among them.  A cell depends on nothing but its part and mask, so there are at most
2^k cells a part, however many documents there are.  Cells are unpivoted against the steps of all
k! orders; a running bit-or window over a cell's steps tells what an earlier filter has removed;
conditional sums give the counts of a step, and a window over all orders of a part a filter's total.

One filter, the last letter, is whether the text equals that of a smaller id anywhere in the table.
Rows are counted by text digest and id, then by digest alone, both with partial sums: a group of
copies of any size arrives as one row a part and label.

Defined cases: a null or empty text is the empty text, which fails by its number of words and repeats
other empty ones; a null language is the part ''; a null id is neither smaller nor larger than any,
so it repeats nothing and nothing repeats it; rows repeated with one id count each, and none repeats
the other; of a document's labels 1 holds if any row says so; an empty table has no parts and no rows.
Of other columns, whatever their names, nothing is read.  Very long texts are judged whole.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Filters on one text at most, as orders are the factorial of their number.
MOST_FILTERS = 7


def rules(text: Column) -> dict[str, Column]:
    """The filters on single texts: few words, few distinct words, capitals, symbols."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, *, text: str = "text", part: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """(part, mask, documents, good, toxic): bit i of a mask is the i-th filter's, the highest is for repeated texts."""
    own = F.coalesce(F.col(text), F.lit(""))
    filters = rules(own) if filters is None else filters
    if len(filters) > MOST_FILTERS:
        raise ValueError(f"{len(filters)} filters are beyond {MOST_FILTERS}")
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(filters.values())]
    mask = sum(bits[1:], bits[0]).cast("int")
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(own, 256)).alias("digest"))
    marks = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(*(F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))))
    marked = rows.join(marks, "id", "left").fillna(0, ["good", "toxic"])
    # one row an id and text, then one a text, part and label: what may repeat is told from the smallest id by its own count
    ids = marked.groupBy("id", "digest", "part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")
    groups = ids.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), least, F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.id").over(Window.partitionBy("digest"))
    single = F.col("nameless") + F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    both = groups.withColumn("single", single).select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("single").alias("n")),
        F.struct((F.col("mask") + (1 << len(bits))).alias("mask"), (F.col("n") - F.col("single")).alias("n")),
    )).alias("cell"))
    both = both.select("part", "good", "toxic", "cell.*")
    sums = (F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return both.groupBy("part", "mask").agg(*sums)  # a part whose cells are all empty has no documents, so it isn't there


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """A row for each part, order of the letters and step; letters[i] names bit i of the cells' masks."""
    steps = [(f"{''.join(o)}", k + 1, 1 << letters.index(c)) for o in permutations(letters) for k, c in enumerate(o)]
    table = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(b).alias("bit")) for o, k, b in steps))
    # the steps are a row a letter and order at most, bounded by the letters
    long = counted.withColumn("at", F.explode(table)).select("part", "mask", "documents", "good", "toxic", "at.*")
    before = Window.partitionBy("part", "filter_order", "mask").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.coalesce(F.bit_or(F.col("mask").bitwiseAND(F.col("bit"))).over(before), F.lit(0)) != 0
    seen = long.withColumn("own", own).withColumn("gone", gone)
    total = lambda test, what="documents": F.sum(F.when(test, F.col(what)).otherwise(0))
    removed = ~F.col("gone") & F.col("own")
    metrics = seen.groupBy("part", "filter_order", "step", "bit").agg(
        total(~F.col("gone") & ~F.col("own")).alias("kept"), total(removed).alias("removed"), total(F.col("gone") & F.col("own")).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
    )
    return metrics.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the four rules and of repeated texts, with letters A to E."""
    return audit(cells(docs, labels), "ABCDE")
