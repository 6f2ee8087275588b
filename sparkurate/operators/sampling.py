"""Deterministic sampling: md5 order keys, capped strata, diversified top-k, slices of quotas.

Ranks are bounded at once (rank <= most), so that Spark keeps only each task's first rows of a
key before the shuffle: even a key of a third of all rows sends few to its task.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.functions import values as V
from sparkurate.session import written


def order_key(*ids: str, seed: int = V.SEED) -> Column:
    """A pseudo-random order that is the same in every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(i).cast("string"), F.lit("")) for i in ids]))


def ranked(df: DataFrame, by: list[str | Column], order: list[Column], name: str = "rn", most: int | None = None) -> DataFrame:
    """A row number in each group; the rows up to ``most`` if it is given."""
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return out.where(F.col(name) <= most) if most is not None else out


def stratified_cap(df: DataFrame, by: list[str], flag: str, ids: list[str], caps: tuple[int, int], seed: int = V.SEED) -> DataFrame:
    """Of each stratum and flag, the first caps[0] (flagged) or caps[1] rows in md5 order."""
    order = [order_key(*ids, seed=seed), *[F.col(i).asc_nulls_last() for i in ids]]
    drawn = ranked(df, [*by, flag], order, most=max(caps))
    return drawn.where((F.col(flag) & (F.col("rn") <= caps[0])) | (~F.col(flag) & (F.col("rn") <= caps[1])))


def one_observer_each(df: DataFrame, observation: str, observer: str) -> bool:
    """Whether an observation never has two observers, so that diverse_top is the greedy choice."""
    return df.groupBy(observation).agg(F.min(observer).alias("a"), F.max(observer).alias("b")).where("a <> b").isEmpty()


def _within_quota(df: DataFrame, label: str, order: list[Column], quota: Column | int) -> DataFrame:
    """The first quota rows of each label; a column of quotas is bounded by its greatest."""
    if isinstance(quota, int):
        if quota < 1:
            raise ValueError("a quota is 1 or more")
        return ranked(df, [label], order, "n_label", quota)
    most = df.agg(F.max(quota).alias("most")).first()["most"]
    return ranked(df, [label], order, "n_label", most or 0).where(F.col("n_label") <= quota)


def _draw_order(flag: str, ids: list[str], seed: int) -> list[Column]:
    return [F.col(flag).desc(), order_key(*ids, seed=seed), *[F.col(i).asc_nulls_last() for i in ids]]


def diverse_top(df: DataFrame, label: str, observation: str, observer: str, flag: str, ids: list[str], quota: Column | int, per_observer: int = V.PER_OBSERVER, seed: int = V.SEED, order: list[Column] | None = None) -> DataFrame:
    """Per label the first quota rows, flagged ones first: one an observation, few an observer.

    Three ranks over one total order; the greedy choice, as an observation has one observer.
    """
    order = order or _draw_order(flag, ids, seed)
    once = ranked(df, [label, observation], order, "n_observation", 1)
    few = ranked(once, [label, observer], order, "n_observer", per_observer)
    return _within_quota(few, label, order, quota)


def greedy_top(df: DataFrame, label: str, observation: str, observer: str, flag: str, ids: list[str], quota: Column | int, per_observer: int = V.PER_OBSERVER, seed: int = V.SEED, order: list[Column] | None = None) -> DataFrame:
    """diverse_top for any rows: what a loop in order would choose that takes a row if its observation isn't used yet and its observer has room.

    Rounds settle all labels at once. A row waits for earlier rows of its observation and its observer.
    In a round those are taken that stand first in their observation and among the first
    per_observer of their observer, taken ones counted: no earlier row can be in their way. Then the
    rest of their observations goes, and that of observers who are full (whose taken rows are their first, so
    all others come after). The first row of a label is always settled, and each round sends the first
    rows of a key alone, so neither a label nor an observer is one task's. Null keys are keys like others.
    """
    order = order or _draw_order(flag, ids, seed)
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = df.withColumns({"_label": key(label), "_observation": key(observation), "_observer": key(observer)})
    # Of an observer's rows of one observation only the first can be taken.
    one = ["_label", "_observation", "_observer"]
    left = written(ranked(rows, one, order, "_n", 1).drop("_n"))
    taken = None
    while not left.isEmpty():
        waiting = left.withColumn("_taken", F.lit(False))
        if taken is not None:
            waiting = waiting.unionByName(taken.withColumn("_taken", F.lit(True)))
        first = ranked(left, ["_label", "_observation"], order, "_n", 1).select(one)
        among = ranked(waiting, ["_label", "_observer"], order, "_n", per_observer).where("NOT _taken").drop("_n", "_taken")
        new = written(among.join(first, one, "left_semi"))
        taken = new if taken is None else written(taken.unionByName(new))
        full = taken.groupBy("_label", "_observer").agg(F.count("*").alias("_n")).where(F.col("_n") >= per_observer).drop("_n")
        left = written(left.join(new.select("_label", "_observation"), ["_label", "_observation"], "left_anti").join(full, ["_label", "_observer"], "left_anti"))
    chosen = left if taken is None else taken
    return _within_quota(chosen.drop(*one), label, order, quota)


def seeded(df: DataFrame, bucket: str, place: str, buckets: list[str], most_rows: int, seed: int = V.SEED, sample: int | None = None, name: str = "drawn") -> DataFrame:
    """Rows of the buckets with the number of their draw (from 1): what one seeded generator draws that goes from bucket to bucket.

    What the generator uses up depends on the buckets' sizes alone: the driver lets it draw for each
    size and keeps the state that it comes to a bucket with; the rows stay where they are until each bucket
    is drawn by itself, in the order of place. A bucket of more than most_rows rows is an error, as it is one
    task's. Without sample a bucket is shuffled whole, with it so many rows are drawn without repetition; an
    empty bucket draws nothing.
    """
    rows = df.where(F.col(bucket).isin(*buckets))
    sizes = {r[bucket]: r["n"] for r in rows.groupBy(bucket).agg(F.count("*").alias("n")).collect()}
    large = [b for b, n in sizes.items() if n > most_rows]
    if large:
        raise ValueError(f"more than {most_rows} rows: {sorted(map(str, large))[:5]}")

    def places_of(generator: random.Random, n: int) -> list[int]:
        if sample is not None:
            return generator.sample(range(n), min(n, sample))
        places = list(range(n))
        generator.shuffle(places)
        return places

    generator, states = random.Random(seed), {}
    for b in buckets:
        if b in sizes:
            states[b] = generator.getstate()
            places_of(generator, sizes[b])

    def draw(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(place)
        generator = random.Random()
        generator.setstate(states[rows.column(bucket)[0].as_py()])
        places = places_of(generator, rows.num_rows)
        return rows.take(pa.array(places, pa.int64())).append_column(name, pa.array(range(1, len(places) + 1), pa.int64()))

    return rows.groupBy(bucket).applyInArrow(draw, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))


def shortages(chosen: DataFrame, quotas: DataFrame, label: str = "label_id") -> DataFrame:
    """label, missing of every label that got less than its quota."""
    counts = chosen.groupBy(label).agg(F.count("*").alias("got"))
    short = quotas.join(counts, label, "left").select(label, (F.col("quota") - F.coalesce("got", F.lit(0))).alias("missing"))
    return short.where("missing > 0")


def add_shortages(*parts: DataFrame, label: str = "label_id") -> DataFrame:
    """Shortages of several causes by label."""
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    return total.groupBy(label).agg(F.sum("missing").alias("missing"))


def shortage_report(short: DataFrame, label: str = "label_id") -> DataFrame:
    """Shortages in label order with their place; there are no more than labels."""
    return short.withColumn("place", F.row_number().over(Window.orderBy(label)).cast("long"))


def oversample(df: DataFrame, label: str, labels: tuple[str, ...], ids: list[str], extra: int, seed: int = V.SEED, reason: str = "hard_negative_oversample") -> DataFrame:
    """df and, after it, up to ``extra`` rows again of each of the labels, with a reason."""
    if extra <= 0:
        return df
    again = ranked(df.where(F.col(label).isin(*labels)), [label], [order_key(*ids, seed=seed), *[F.col(i) for i in ids]], "_n", extra).drop("_n")
    return df.unionByName(again.withColumn("repeat_reason", F.lit(reason)), allowMissingColumns=True)


def slices(df: DataFrame, by: list[str], order: list[Column], quotas: dict[str, int], name: str = "split") -> DataFrame:
    """Each group in order, cut at the cumulated quotas; what is over is left out."""
    total = sum(quotas.values())
    placed = ranked(df, by, order, "_n", total)
    cut, start = F.lit(None).cast("string"), total
    for split, count in reversed(list(quotas.items())):
        start -= count
        cut = F.when(F.col("_n").between(start + 1, start + count), split).otherwise(cut)
    return placed.withColumn(name, cut).drop("_n")


def first_rows(df: DataFrame, place: str, n: int) -> DataFrame:
    """The first n rows by place; an error if there are fewer, or n isn't positive. Rows are sorted once, by the result."""
    if n < 1:
        raise ValueError("a limit is 1 or more")
    found = df.select(F.lit(1)).limit(n).count()
    if found < n:
        raise ValueError(f"{n} rows are asked for, {found} are there")
    return df.orderBy(place).limit(n)


def best_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key; filters on what it is come after, never before."""
    return ranked(df, [key], order, "_n", 1).drop("_n")


def min_by_ranks(df: DataFrame, key: list[str], value: str, ranks: list[Column]) -> DataFrame:
    """value of the least ranks, compared in turn; one aggregate, no sort."""
    return df.groupBy(*key).agg(F.min_by(value, F.struct(*[r.alias(f"r{i}") for i, r in enumerate(ranks)])).alias(value))


def max_by_size(df: DataFrame, key: list[str], value: str, size: str) -> DataFrame:
    """value of the greatest size; the last in name order on ties."""
    return df.groupBy(*key).agg(F.max_by(value, F.struct(size, value)).alias(value))


def newest(df: DataFrame, path: str, preferred: str = "last") -> DataFrame:
    """The checkpoint in a folder of the preferred name, else the one of the highest number."""
    number = F.regexp_extract(path, r"(\d+)[^\d/]*$", 1).try_cast("long")
    inside = F.col(path).rlike(f"(^|/){preferred}(/|$)").cast("int")
    return df.agg(F.max_by(path, F.struct(inside, F.coalesce(number, F.lit(-1)), F.col(path))).alias(path))


def first_with(files: DataFrame, name: str, parts: tuple[str, ...], order: str) -> DataFrame:
    """One row: the first file, in the given order, whose name has one of the parts in any case."""
    found = F.lit(False)
    for part in parts:
        found = found | F.lower(name).contains(part.lower())
    return files.where(found).agg(F.min_by(name, order).alias(name))


def first_items(column: str, n: int = 16) -> Column:
    """The first items of an array."""
    return F.slice(column, 1, n)
