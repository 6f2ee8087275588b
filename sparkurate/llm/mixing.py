"""Mixing sources to target weights by temperature, with DataFrame and SQL functions only.

A source's share s of all tokens becomes the weight s^t / sum(s^t). The exponent t between 0
(uniform) and 1 (as found) is bisected: the smallest that keeps every source within a
repetition limit, or the largest whose weights have a target share of the greatest entropy.
A look at the sources is one aggregate over one row a source, for several halvings at once.

A budget of tokens is then split by weight. A source is drawn in passes, each a permutation of
its documents by the md5 of seed, id and text: whole passes first, then the start of one more until
the source's part of the budget is used up. The permutation is a permutation of blocks (the
first hex digits) and of each block's documents, so that where a pass stops is found from
block sums: no window has more rows than the different ones of a block or STEP digits of block sums,
whatever the size of a source. A row's copies follow from its place and its source's cutoff. Budget None is the least that draws every document at least once.

Edge cases: a null source is the empty one; a null id counts as the empty string, so rows
without an id, or of one id, are spread by their texts; rows without tokens go with the place
where they stand; rows that are equal in all columns have one place, are counted as one and drawn each for itself; an empty
table gives an empty result; a single source keeps weight 1. Columns of documents may have any name
that doesn't start with _mix_.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkurate.llm import common

BLOCK_DOCS = 512
STEP = 3
#: Up to so many sources their cutoffs are broadcast (some 10 MB); beyond, a join by source and salt.
BROADCAST_SOURCES = 100_000
#: Equal rows where a pass stops are written out again in parts of so many.
PART_ROWS = 65_536
STEPS = 30
HALVINGS = 3
SEED = "mix"
#: Times keep their microseconds when rows are told apart.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
MAX_REPETITION = 1.25
COVER_SPREAD = 2.0


def n_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass
class Totals:
    tokens: int
    rows: int
    sources: int


def prepared(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """docs with their source's key, tokens and place in the permutation.

    Columns beside id, text and source are part of the place, so that rows of one place are equal, null or empty aside.
    """
    rest = sorted(set(docs.columns) - {"doc_id", "text", "source"})
    parts = [F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]), EXACT))] if rest else []
    return docs.withColumns(
        {
            "_mix_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "_mix_tokens": n_tokens(),
            "_mix_place": F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))), *parts)),
        }
    )


def shares(rows: DataFrame) -> tuple[DataFrame, Totals]:
    """_mix_source, tokens, share of each source; the totals."""
    sums = common.materialize(rows.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("tokens"), F.count("*").alias("docs")))
    t = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("docs"), F.lit(0)).alias("n"), F.count("*").alias("k")).first()
    return sums.withColumn("share", F.col("tokens") / F.lit(float(t["t"] or 1))), Totals(t["t"], t["n"], t["k"])


def _at(sources: DataFrame, *exponents: float) -> list[tuple[float, float, float, float]]:
    """Norm, entropy, least and greatest weight over share at each exponent; one aggregate for all."""
    parts: list[Column] = []
    for exponent in exponents:
        p = F.pow("share", F.lit(exponent))
        parts += [F.sum(p), F.sum(p * F.log("share")), F.min(p / F.col("share")), F.max(p / F.col("share"))]
    row = sources.where("tokens > 0").agg(*[c.alias(f"c{i}") for i, c in enumerate(parts)]).first()
    found = []
    for i, exponent in enumerate(exponents):
        z, zl, low, high = row[4 * i : 4 * i + 4]
        found.append((z, math.log(z) - exponent * zl / z, low / z, high / z) if z else (1.0, 0.0, 1.0, 1.0))
    return found


def exponent_for(sources: DataFrame, totals: Totals, budget: int | None, max_repetition: float | None = None, target_entropy: float | None = None) -> float:
    """The bisected exponent. Repetition: drawn tokens over own tokens; entropy: a part of log(sources).

    The interval is halved STEPS times, HALVINGS of them at each look at the sources.
    """

    def flat_enough(*exponents: float) -> list[bool]:
        found = []
        for _, entropy, low, high in _at(sources, *exponents):
            if max_repetition is not None:
                found.append((budget / max(1, totals.tokens) * high if budget is not None else high / low) > max_repetition)
            else:
                found.append(entropy >= target_entropy * math.log(max(1, totals.sources)))
        return found

    uniform, as_found = flat_enough(0.0, 1.0)
    if not uniform:
        return 0.0  # uniform weights are within the limit, or the target is out of reach
    if as_found:
        return 1.0
    low, high, parts = 0.0, 1.0, 1 << HALVINGS
    for _ in range(STEPS // HALVINGS):
        points = [low + (high - low) * k / parts for k in range(parts + 1)]
        flags = flat_enough(*points[1:-1])
        first, last = 0, parts
        while last - first > 1:
            middle = (first + last) // 2
            first, last = (middle, last) if flags[middle - 1] else (first, middle)
        low, high = points[first], points[last]
    return high if max_repetition is not None else low


def plan(sources: DataFrame, totals: Totals, exponent: float, budget: int | None) -> DataFrame:
    """_mix_source, weight, passes, room (tokens left for the last pass)."""
    norm, _, low, _ = _at(sources, exponent)[0]
    if budget is None:
        budget = math.ceil(totals.tokens / low)
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent)) / F.lit(norm)).otherwise(0.0)
    # The smallest rounding error must not cost a pass: half a token is added.
    part = F.floor(weight * F.lit(float(budget)) + 0.5).cast("long")
    planned = sources.select("_mix_source", "tokens", weight.alias("weight"), part.alias("part"))
    return planned.select("_mix_source", "weight", F.expr("if(tokens > 0, part div tokens, 1)").alias("passes"), F.expr("if(tokens > 0, part % tokens, -1)").alias("room"))


def digits_for(rows: int, block_docs: int = BLOCK_DOCS) -> int:
    """Hex digits that name a block of about block_docs rows."""
    return max(1, math.ceil(math.log(max(1, rows / block_docs), 16) - 1e-9))


def block_starts(rows: DataFrame, digits: int, step: int = STEP) -> DataFrame:
    """_mix_source, _mix_block, before: a source's tokens in the blocks before this one."""
    sums = rows.groupBy("_mix_source", F.substring("_mix_place", 1, digits).alias("_mix_block")).agg(F.sum("_mix_tokens").alias("tokens"))
    starts = sums.select("_mix_source", "_mix_block", F.lit(0).cast("long").alias("before")) if digits > step else None
    for upto in range(min(step, digits), digits + step, step):
        upto = min(upto, digits)
        own = F.substring("_mix_block", 1, upto)
        level = sums.groupBy("_mix_source", own.alias("_mix_own")).agg(F.sum("tokens").alias("tokens")) if upto < digits else sums.withColumnRenamed("_mix_block", "_mix_own")
        parent = F.substring("_mix_own", 1, max(0, upto - step if upto % step == 0 else upto - upto % step))
        by = Window.partitionBy("_mix_source", parent).orderBy("_mix_own").rowsBetween(Window.unboundedPreceding, -1)
        level = level.select("_mix_source", "_mix_own", F.coalesce(F.sum("tokens").over(by), F.lit(0)).alias("_mix_add"))
        if starts is None:
            return level.select("_mix_source", F.col("_mix_own").alias("_mix_block"), F.col("_mix_add").alias("before"))
        starts = starts.withColumn("_mix_own", own).join(level, ["_mix_source", "_mix_own"]).select("_mix_source", "_mix_block", (F.col("before") + F.col("_mix_add")).alias("before"))
        if upto == digits:
            return starts
    return starts


def cutoffs(rows: DataFrame, planned: DataFrame, digits: int, step: int = STEP) -> DataFrame:
    """planned with cut, equal, more: where the last pass of a source stops, one row a source.

    Rows placed before cut are drawn once more, rows at cut (equal of them) more times in all, rows after it not.
    The block of cut is the last that starts within the room; its rows alone are looked at, equal ones as one.
    """
    starts = block_starts(rows, digits, step).join(planned.select("_mix_source", "room"), "_mix_source").where("before <= room")
    last = starts.groupBy("_mix_source").agg(F.max_by(F.struct(F.col("_mix_block").alias("block"), "before", "room"), "_mix_block").alias("last")).select("_mix_source", "last.*")
    inside = rows.select("_mix_source", "_mix_place", "_mix_tokens", F.substring("_mix_place", 1, digits).alias("block")).join(last, ["_mix_source", "block"])
    distinct = inside.groupBy("_mix_source", "_mix_place", "_mix_tokens", "before", "room").agg(F.count("*").alias("n"))
    by = Window.partitionBy("_mix_source").orderBy("_mix_place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum(F.col("_mix_tokens") * F.col("n")).over(by), F.lit(0))
    left = distinct.withColumn("left", F.col("room") - before)
    drawn = F.when(F.col("left") < 0, 0).when(F.col("_mix_tokens") > 0, F.least("n", F.expr("left div _mix_tokens"))).otherwise(F.col("n"))
    ends = left.withColumn("drawn", drawn.cast("long"))
    # Without a row that isn't drawn the whole block is: "g" comes after all hex digits.
    first = F.min(F.when(F.col("drawn") < F.col("n"), F.struct("_mix_place", "n", "drawn")))
    cut = ends.join(last.select("_mix_source", "block"), "_mix_source").groupBy("_mix_source").agg(first.alias("first"), F.first("block").alias("block"))
    whole = F.struct(F.concat("block", F.lit("g")).alias("_mix_place"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("drawn"))
    found = cut.withColumn("at", F.coalesce("first", whole)).select("_mix_source", F.col("at._mix_place").alias("cut"), F.col("at.n").alias("equal"), F.col("at.drawn").alias("more"))
    nothing = {"cut": "", "equal": 0, "more": 0}
    return planned.join(found, "_mix_source", "left").fillna(nothing)


def assign(rows: DataFrame, sources: DataFrame, planned: DataFrame, totals: Totals, sums_from: DataFrame | None = None, digits: int | None = None, step: int = STEP) -> DataFrame:
    """rows with _mix_weight and _mix_copies: how often each row is drawn.

    A row is compared with its source's cutoff, so rows aren't moved. Where a pass stops amid equal rows, these
    alone are counted as one row and written out again, some with a copy more.
    """
    slim = sums_from if sums_from is not None else rows
    cuts = common.materialize(cutoffs(slim, planned, digits or digits_for(totals.rows), step)).select("_mix_source", *[F.col(k).alias(f"_mix_{k}") for k in ("weight", "passes", "room", "cut", "equal", "more")])
    if totals.sources <= BROADCAST_SOURCES:
        placed = rows.join(F.broadcast(cuts), "_mix_source")
    else:
        # A hot source's rows go to many tasks by the first digits of their places.
        salts = F.explode(F.array(*[F.lit(f"{k:02x}") for k in range(256)]))
        placed = rows.withColumn("_mix_salt", F.substring("_mix_place", 1, 2)).join(cuts.withColumn("_mix_salt", salts), ["_mix_source", "_mix_salt"]).drop("_mix_salt")
    copies = F.col("_mix_passes") + F.when(F.col("_mix_place") < F.col("_mix_cut"), 1).otherwise(0)
    if cuts.where("_mix_more > 0").isEmpty():
        return placed.withColumn("_mix_copies", copies)
    amid = (F.col("_mix_place") == F.col("_mix_cut")) & (F.col("_mix_more") > 0)
    # Rows of one place differ in what is null or empty at most; any one of a kind stands for all of it.
    kind = F.concat(*[F.col(c).isNull().cast("string") for c in ("doc_id", "text", "source") if c in rows.columns])
    counted = placed.where(amid).groupBy("_mix_source", "_mix_place", kind.alias("_mix_kind")).agg(F.count("*").alias("_mix_n"), F.first(F.struct(*[F.col(f"`{c}`") for c in placed.columns])).alias("_mix_row"))
    by = Window.partitionBy("_mix_source").orderBy("_mix_kind").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select("_mix_row", "_mix_n", F.coalesce(F.sum("_mix_n").over(by), F.lit(0)).alias("_mix_start"))
    parts = counted.withColumn("_mix_part", F.explode(F.expr(f"sequence(0L, (_mix_n - 1) div {PART_ROWS})"))).repartition("_mix_start", "_mix_part")
    numbers = F.explode(F.expr(f"sequence(_mix_part * {PART_ROWS} + 1, least(_mix_n, (_mix_part + 1) * {PART_ROWS}))"))
    numbered = parts.withColumn("_mix_number", numbers)
    again = numbered.select("_mix_row.*", F.expr("_mix_row._mix_passes + if(_mix_start + _mix_number <= _mix_row._mix_more, 1, 0)").alias("_mix_copies"))
    return placed.where(~amid).withColumn("_mix_copies", copies).unionByName(again)


def op8_source_mixing(spark, sf_dir: str) -> DataFrame:
    """A budget of as many tokens as there are, no source drawn more than MAX_REPETITION times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = common.materialize(prepared(docs.select("doc_id", "source", "text")).drop("text", "source"))
    sources, totals = shares(rows)
    exponent = exponent_for(sources, totals, totals.tokens, max_repetition=MAX_REPETITION)
    drawn = assign(rows, sources, plan(sources, totals, exponent, totals.tokens), totals)
    return drawn.select("doc_id", F.col("_mix_source").alias("source"), F.col("_mix_tokens").alias("n_tokens"), F.round("_mix_weight", 6).alias("weight"), F.col("_mix_copies").alias("copies"))


def oracle() -> str:
    """DuckDB SQL for op8_source_mixing."""
    greatest_ratio = "(SELECT max(pow(share, {0}) / share) / sum(pow(share, {0})) FROM s WHERE tokens > 0)"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS place FROM documents),
t AS (SELECT sum(n_tokens)::BIGINT AS total FROM d),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / any_value(total)::DOUBLE AS share FROM d, t GROUP BY source),
b(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, CASE WHEN {greatest_ratio.format("0.0")} > {MAX_REPETITION} THEN 1.0 ELSE 0.0 END::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN over_limit THEN middle ELSE low END, CASE WHEN over_limit THEN high ELSE middle END
  FROM (SELECT i, low, high, (low + high) / 2 AS middle, {greatest_ratio.format("(low + high) / 2")} > {MAX_REPETITION} AS over_limit FROM b WHERE i < {STEPS} AND high > 0)),
e AS (SELECT high AS x FROM b ORDER BY i DESC LIMIT 1),
n AS (SELECT sum(pow(share, x)) AS z FROM s, e WHERE tokens > 0),
w AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(share, x) / z ELSE 0 END AS weight, floor(CASE WHEN tokens > 0 THEN pow(share, x) / z ELSE 0 END * total + 0.5)::BIGINT AS part FROM s, e, n, t),
p AS (SELECT source, weight, CASE WHEN tokens > 0 THEN part // tokens ELSE 1 END AS passes, CASE WHEN tokens > 0 THEN part % tokens ELSE -1 END AS room FROM w),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY place, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT doc_id, c.source, n_tokens, round(weight, 6) AS weight, (passes + CASE WHEN upto <= room THEN 1 ELSE 0 END)::BIGINT AS copies FROM c JOIN p USING (source)
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document once at least; no source's rate over COVER_SPREAD times another's.

    Copies become rows, so what leaves has the target weights.
    """
    rows = prepared(docs)
    slim = common.materialize(rows.select("doc_id", "_mix_source", "_mix_tokens", "_mix_place"))
    sources, totals = shares(slim)
    exponent = exponent_for(sources, totals, None, max_repetition=COVER_SPREAD)
    drawn = assign(rows, sources, plan(sources, totals, exponent, None), totals, sums_from=slim)
    return drawn.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.greatest("_mix_copies", F.lit(1))))).select(*docs.columns)
