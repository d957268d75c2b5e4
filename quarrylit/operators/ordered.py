"""Work in an order that crosses partition borders: row numbers, and the last mark before each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces that the time axis is cut into, by quantiles: what one key's window holds at most is its rows of one piece.
SEGMENTS = 64


def numbered(rows: DataFrame, order: list[str], folder: str, name: str = "seq") -> DataFrame:
    """Rows with their place, from 0, in an order over all of them.  The ordered ranges are a table in `folder`; their sizes,
    one number a range, are added up."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    ranged.withColumn("__range", F.spark_partition_id()).withColumn("__in", place.bitwiseAND((1 << 33) - 1)).write.mode("overwrite").parquet(folder)
    table = rows.sparkSession.read.parquet(folder)
    sizes = table.groupBy("__range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    starts = F.broadcast(sizes.select("__range", before.alias("__before")))
    return table.join(starts, "__range").withColumn(name, F.col("__before") + F.col("__in")).drop("__range", "__in", "__before")


def _segment(at: Column, bounds: list, low: int, high: int) -> Column:
    """How many bounds a time has reached, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(at < F.lit(bounds[middle]), _segment(at, bounds, low, middle)).otherwise(_segment(at, bounds, middle + 1, high))


def attributed(calls: DataFrame, marks: DataFrame, *, by: str, at: str, value: str, segments: int = SEGMENTS) -> DataFrame:
    """Each call with the value of the last mark of its key at or before its time; null where there is none.

    The time axis is cut at quantiles.  Inside a piece a window carries marks forward; what a piece begins with comes from a
    prefix pass over the last mark of each key and piece, as rows of their own that stand first.  So a key that holds most
    of the rows is many windows, and calls are shuffled once.  Of marks at one time the largest value counts, a null value
    (nothing current) least; a null key or time has no mark."""
    own = marks.where(F.col(by).isNotNull() & F.col(at).isNotNull()).select(F.col(by).alias("k"), F.col(at).alias("t"), F.lit(0).alias("kind"), F.struct(F.col(value).alias("v")).alias("mark"), F.lit(None).cast(calls.schema.simpleString()).alias("row"))
    rows = calls.select(F.col(by).alias("k"), F.col(at).alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(own.schema["mark"].dataType).alias("mark"), F.struct(*calls.columns).alias("row"))
    cuts = rows.agg(F.percentile_approx("t", [i / segments for i in range(1, segments)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    both = rows.unionByName(own).withColumn("s", F.when(F.col("t").isNull(), F.lit(-1)).otherwise(_segment(F.col("t"), cuts, 0, len(cuts))))
    last = own.withColumn("s", _segment(F.col("t"), cuts, 0, len(cuts))).groupBy("k", "s").agg(F.max_by("mark", F.struct("t", "mark")).alias("mark"))
    until = F.coalesce(F.lead("s").over(Window.partitionBy("k").orderBy("s")), F.lit(len(cuts)))  # a row a key and piece
    carried = last.withColumn("until", until).where(F.col("s") < F.col("until")).select("k", F.explode(F.sequence(F.col("s") + 1, F.col("until"))).alias("s"), "mark")
    first = carried.select("k", F.lit(None).cast(rows.schema["t"].dataType).alias("t"), F.lit(-1).alias("kind"), "mark", F.lit(None).cast(rows.schema["row"].dataType).alias("row"), "s")
    order = Window.partitionBy("k", "s").orderBy(F.asc_nulls_first("t"), "kind", "mark").rowsBetween(Window.unboundedPreceding, 0)
    found = both.unionByName(first).withColumn("mark", F.last("mark", ignorenulls=True).over(order))
    return found.where("kind = 1").select("row.*", F.when(F.col("k").isNotNull() & F.col("t").isNotNull(), F.col("mark.v")).alias(value))
