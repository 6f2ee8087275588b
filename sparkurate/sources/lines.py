"""Lines of text files with their place, and records that span lines; files are split as Spark likes.

Spark tells of each line which file it is from and where its split starts. How many lines a split
has, and in which state (inside quotes or not) it leaves what comes after it, are small tables of
one row a split; running sums over those give every split its start, and a window within each
split does the rest. Where a file is split may differ from run to run, so lines are written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkurate.session import written

#: Bytes of a record that spans lines; a longer one is an unclosed quote, and malformed.
LONGEST_RECORD = 1 << 21


def _scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block (where its split starts), row (rising within a split), value; a carriage return stays at the end of the value."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    return spark.read.option("lineSep", "\n").text(paths).select(*place, "value")


def _before(df: DataFrame) -> DataFrame:
    """One row a split (file, block, n): with the number of lines before it in its file, and in all files before it."""
    files = df.groupBy("file").agg(F.sum("n").alias("lines")).withColumn("file_start", F.coalesce(F.sum("lines").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("start", F.coalesce(F.sum("n").over(along), F.lit(0))).join(files.drop("lines"), "file")


def numbered(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, line (from 1 in each file), place (from 1 over all files in path order), value.

    No sort: a split's lines are numbered from its first one, and splits by their counts.
    """
    lines = written(_scan(spark, paths))
    splits = _before(lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("row").alias("first")))
    within = F.col("row") - F.col("first") + 1
    joined = lines.join(splits, ["file", "block"])
    return joined.select("file", (F.col("start") + within).alias("line"), (F.col("file_start") + F.col("start") + within).alias("place"), F.regexp_replace("value", "\r$", "").alias("value"))


def first_lines(spark: SparkSession, paths: str | list[str], n: int) -> DataFrame:
    """The first n lines that aren't blank, in file order, with their place; an error if there are fewer, or n isn't positive.

    Lines that aren't blank are counted by split; only the splits up to the n-th are looked at, and nothing is sorted.
    """
    if n < 1:
        raise ValueError("a limit is 1 or more")
    lines = written(_scan(spark, paths).where(F.trim(F.regexp_replace("value", "\r$", "")) != ""))
    splits = written(_before(lines.groupBy("file", "block").agg(F.count("*").alias("n"))).withColumn("before", F.col("file_start") + F.col("start")))
    there = splits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if there < n:
        raise ValueError(f"{n} rows are asked for, {there} are there")
    needed = lines.join(splits.where(F.col("before") < n).drop("n"), ["file", "block"])
    rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("row"))
    return needed.withColumn("place", F.col("before") + rank).where(F.col("place") <= n).select("file", "place", F.regexp_replace("value", "\r$", "").alias("value"))


# --- records that span lines -----------------------------------------------------------------


def opens(value: Column, separator: str) -> Column:
    """Whether a line that starts outside quotes ends inside of them; quotes open at the start of a field alone."""
    sep = "\\" + separator if separator == "|" else separator
    bare = F.regexp_replace(F.regexp_replace(value, '""', ""), f'(^|{sep})"[^"]*"', "$1")
    return F.when(value.contains('"'), bare.rlike(f'(^|{sep})"')).otherwise(False)


def stays(value: Column, separator: str) -> Column:
    """Whether a line that starts inside quotes ends inside of them."""
    sep = "\\" + separator if separator == "|" else separator
    bare = F.regexp_replace(value, '""', "")
    rest = F.regexp_replace(F.regexp_replace(bare, '^[^"]*"', ""), f'({sep})"[^"]*"', "$1")
    return F.when(bare.contains('"'), rest.rlike(f'{sep}"')).otherwise(True)


def _state(df: DataFrame, along: Window, out: str, inside: str) -> DataFrame:
    """What a row starts in, as rows of (out, inside: whether it ends inside, started so or so) are chained.

    A row leaves the state, turns it, or sets it. known: the state that the last setting row and the turns
    since give, null if there is none; turned: whether the turns before this row are odd.
    """
    turns = (F.col(out) & ~F.col(inside)).cast("int")
    upto, before = (along.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    df = df.withColumns({"_turns": F.sum(turns).over(upto), "_before": F.coalesce(F.sum(turns).over(before), F.lit(0)), "_sets": F.col(out) == F.col(inside)})
    df = df.withColumn("_set", F.when(F.col("_sets"), (F.col(out).cast("int") + F.col("_turns")) % 2))
    last = F.last("_set", ignorenulls=True).over(before)
    return df.withColumns({"known": (last + F.col("_before")) % 2 == 1, "turned": F.col("_before") % 2 == 1}).drop("_sets")


def records(spark: SparkSession, files: list[str], separator: str) -> DataFrame:
    """file, place (rising in a file), value: the records of delimited files, whose quoted fields may hold line ends."""
    lines = written(_scan(spark, files))
    lines = lines.withColumns({"o": opens(F.col("value"), separator), "i": stays(F.col("value"), separator)})
    within = Window.partitionBy("file", "block").orderBy("row")
    chained = _state(lines, within, "o", "i")
    # A split as one row: it sets the state if one of its lines does, else its turns count.
    ends = chained.groupBy("file", "block").agg(F.max_by(F.struct("_turns", "_set", "known", "turned", "o", "i"), "row").alias("end"))
    closing = F.when(F.col("end.known").isNotNull(), F.when(F.col("end.known"), F.col("end.i")).otherwise(F.col("end.o")))
    o = F.coalesce(closing, F.when(F.col("end.turned"), F.col("end.i")).otherwise(F.col("end.o")))
    i = F.coalesce(closing, F.when(F.col("end.turned"), F.col("end.o")).otherwise(F.col("end.i")))
    splits = _state(ends.select("file", "block", o.alias("o"), i.alias("i")), Window.partitionBy("file").orderBy("block"), "o", "i")
    splits = splits.select("file", "block", F.coalesce("known", "turned").alias("start"))
    inside = F.coalesce(F.col("known"), F.col("turned") != F.col("start"))
    placed = chained.join(splits, ["file", "block"]).select("file", "block", "row", "value", inside.alias("inside"), F.when(inside, F.col("i")).otherwise(F.col("o")).alias("goes_on"))
    alone = placed.where("NOT inside AND NOT goes_on")
    # A record's key is where it starts: within the split, or where the last record of a split before it does.
    several = written(placed.where("inside OR goes_on"))
    starts = several.where("NOT inside").groupBy("file", "block").agg(F.max("row").alias("last_row"))
    blocks = several.select("file", "block").distinct().join(starts, ["file", "block"], "left")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("earlier", F.last(F.when(F.col("last_row").isNotNull(), F.struct(F.col("block").alias("block"), F.col("last_row").alias("row"))), ignorenulls=True).over(earlier))
    own = F.last(F.when(~F.col("inside"), F.struct("block", "row")), ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    keyed = several.withColumn("own", own).join(blocks.select("file", "block", "earlier"), ["file", "block"]).withColumn("place", F.coalesce("own", "earlier"))
    sizes = keyed.groupBy("file", "place").agg(F.sum(F.octet_length("value") + 1).alias("size")).where(F.col("size") <= LONGEST_RECORD).select("file", "place")
    joined = keyed.join(sizes, ["file", "place"]).groupBy("file", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "value"))), lambda x: x["value"]), "\n").alias("value"))
    every = alone.select("file", F.struct("block", "row").alias("place"), "value").unionByName(joined.select("file", "place", "value"))
    return every.withColumn("value", F.regexp_replace("value", "\r$", ""))
