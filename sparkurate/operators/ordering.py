"""Places in a total order of a whole table, by ranges: no task holds more than its range.

Rows are dealt out by ranges of the order and sorted within; the row id that Spark gives them then is
their range and their place there. They are written once, as ranges are cut at samples that
differ from run to run. A table of one row a range gives each range its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkurate.session import written


def ranged(df: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """df with _range and _at, written: a row is after every row of a lower range, and of a lower place in its own."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("_id", F.monotonically_increasing_id())
    return written(dealt.withColumns({"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id"))


def numbered(df: DataFrame, order: list[Column], name: str = "place", ranges: int | None = None) -> DataFrame:
    """df with the number (from 1) of each row in an order of the whole table. Rows that the order doesn't tell apart share a range."""
    dealt = ranged(df, order, ranges)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_range", "_at", "_start")


def running_sum(df: DataFrame, order: list[Column], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """df with the sum of value over all rows up to this one, in an order of the whole table."""
    dealt = ranged(df, order, ranges)
    starts = dealt.groupBy("_range").agg(F.sum(value).alias("_sum"))
    starts = starts.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    within = F.sum(value).over(Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.coalesce(within, F.lit(0))).drop("_range", "_at", "_start")


def joined_text(df: DataFrame, keys: list[str], order: list[Column], value: str, separator: str, ranges: int | None = None) -> DataFrame:
    """keys, text: each key's values in order, joined; nulls are left out.

    Two levels: a range joins its own run of a key, and runs are joined in order. A key of a third of all rows is
    in a third of the ranges; only its runs, one a range, meet in one task.
    """
    dealt = ranged(df.select(*keys, value, *[c.alias(f"_o{i}") for i, c in enumerate(order)]), [*[F.col(k) for k in keys], *[F.col(f"_o{i}") for i in range(len(order))]], ranges)

    def in_order(place: str, text: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda x: x[text]), separator)

    runs = dealt.groupBy(*keys, "_range").agg(in_order("_at", value).alias("_run"), F.count(value).alias("_n"))
    # A run of nulls alone has no text at all, which isn't an empty one.
    return runs.withColumn("_run", F.when(F.col("_n") > 0, F.col("_run"))).groupBy(*keys).agg(in_order("_range", "_run").alias("text"))
