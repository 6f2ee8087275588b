"""Quality rules: adaptive thresholds from mergeable quantile sketches per language and source.

Each whole text gives integer measures and rates per thousand. A sketch of a rate or length is
its number of documents by bucket: buckets are exact below 64 and have a relative width of 1/32
above, so sketches merge by addition, in any order, with the same result. Each language and
source gets its own sketches; those of fewer than MIN_DOCS documents give way to the merged
sketches of the language, and those to the ones of all documents. A document is kept if it passes
the base rules and no rate is above its group's fence: the upper quartile and REACH spreads more.
A spread is the distance of the quartiles, or what one event (EVENTS) changes in the rate of a
text of the group's median length, if that is more: a rate that most documents have at 0 has no
other scale. All of a fence comes from the group's sketches.

Edge cases: null and empty texts have no words, fail the base rules and don't enter a sketch.
A null language or source counts as the empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

#: Each rate's least event, as a number of what it counts, and the length that it is a rate of.
EVENTS = {"symbols": (1, "words"), "dup_lines": (1, "lines"), "repeats": (6, "words"), "word_length": (1, "words")}
#: How many spreads over the upper quartile a fence is.
REACH = 6
MIN_DOCS = 50
MIN_WORDS = 50
#: Up to so many groups the thresholds are broadcast (some 10 MB); beyond, a shuffled join.
BROADCAST_GROUPS = 100_000
SYMBOLS = "#*$%&|<>"
_words = re.compile(common.WORD).findall
_BLANK = " \t\n\x0b\x0c\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window which comes up twice or more in the text."""
    if len(words) < 4:
        return 0
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(known) + ids[2:]
    _, place, n = np.unique(windows, return_inverse=True, return_counts=True)
    again = n[place] >= 2
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """MEASURES of one text."""
    words = _words(text)
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and MEASURES of every row."""
    schema = T.StructType([common.id_field(docs), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def start():
        def step(batch):
            made = np.array([measure(t) for t in common.texts_of(batch)], np.int64)
            keep = [common.column_of(batch, k) for k in ("doc_id", "lang", "source")]
            return pa.RecordBatch.from_arrays([*keep, *[pa.array(made[:, i]) for i in range(len(MEASURES))]], names=["doc_id", "lang", "source", *MEASURES])

        return step

    keys = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source")]
    return common.map_rows(docs.select("doc_id", "text", *keys), start, schema)


def rates() -> dict[str, Column]:
    """The rates per thousand, as integers."""
    return {
        "symbols": F.expr("1000 * n_symbols div n_words"),
        "dup_lines": F.expr("1000 * n_dup_lines div n_lines"),
        "repeats": F.expr("1000 * n_repeat_words div n_words"),
        "word_length": F.expr("1000 * word_chars div n_words"),
    }


def bucket_of(value: str) -> str:
    """SQL for the bucket of an integer from 0 on; high is its highest bit's place."""
    high = f"(length(bin({value})) - 1)"
    return f"CASE WHEN {value} < 64 THEN {value} ELSE 32 * {high} - 160 + (shiftright({value}, {high} - 5)) END"


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rate, bucket, n: one sketch for each language, source and rate or length."""
    values = rates() | {"words": F.col("n_words"), "lines": F.col("n_lines")}
    stacked = ", ".join(f"'{k}', `{k}`" for k in values)
    long = measured.where("n_words > 0").select("lang", "source", *[v.alias(k) for k, v in values.items()]).selectExpr("lang", "source", f"stack({len(values)}, {stacked}) as (rate, value)")
    return long.groupBy("lang", "source", "rate", F.expr(bucket_of("value")).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sketches of the same keys, added up."""
    return sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """For each of keys: n_docs and a fence for each rate, from the sketches' quartiles."""
    by = Window.partitionBy(*keys, "rate")
    # The lowest value of a bucket stands for it.
    value = F.expr("CASE WHEN bucket < 64 THEN bucket ELSE shiftleft(32L + (bucket - 64) % 32, 1 + (bucket - 64) div 32) END")
    ranked = sketch.withColumns({"value": value, "upto": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(by)})

    def quartile(rate: str, k: int) -> Column:
        return F.min(F.when((F.col("rate") == rate) & (F.col("upto") * 4 >= F.col("total") * k), F.col("value")))

    found = ranked.groupBy(*keys).agg(
        F.max("total").alias("n_docs"),
        *[quartile(r, k).alias(f"{r}_q{k}") for r in EVENTS for k in (1, 3)],
        *[quartile(r, 2).alias(f"{r}_q2") for r in ("words", "lines")],
    )
    made = [F.expr(f"{r}_q3 + {REACH} * greatest({r}_q3 - {r}_q1, {1000 * n} div {length}_q2)").alias(f"{r}_fence") for r, (n, length) in EVENTS.items()]
    return found.select(*keys, "n_docs", *made)


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and a fence for each rate, from the group's sketch or a merged one."""
    names = [f"{r}_fence" for r in EVENTS]

    def level(*keys: str, tag: str) -> DataFrame:
        found = fences(merge(sketch, *keys), *keys)
        return found.select(*keys, F.col("n_docs").alias(f"{tag}_docs"), *[F.col(n).alias(f"{tag}_{n}") for n in names])

    # The whole's sketch has one row a rate and bucket; it is one row here.
    joined = level("lang", "source", tag="own").join(level("lang", tag="lang"), "lang").join(F.broadcast(level(tag="all")))
    pick = lambda n: F.when(F.col("own_docs") >= MIN_DOCS, F.col(f"own_{n}")).when(F.col("lang_docs") >= MIN_DOCS, F.col(f"lang_{n}")).otherwise(F.col(f"all_{n}"))
    return joined.select("lang", "source", *[pick(n).alias(n) for n in names])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES, base_failed, kept, lang, source and the fences that held for the row."""
    began = common.mark()
    measured = common.materialize(measures(docs))
    limits = common.materialize(thresholds(common.materialize(sketches(measured))))
    common.discard_since(began, docs.sparkSession, measured, limits)
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    judged = measured.join(limits, ["lang", "source"], "left")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for name, rate in rates().items():
        within = within & F.when(F.col("n_words") > 0, rate <= F.col(f"{name}_fence")).otherwise(False)
    return judged.select("doc_id", *MEASURES[:5], base_failed.alias("base_failed"), (~base_failed & within).alias("kept"), "n_lines", "lang", "source", *[f"{r}_fence" for r in EVENTS])


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("lang", "source")


def oracle() -> str:
    """DuckDB SQL for op1_quality_rules."""
    rate = {"symbols": "1000 * n_symbols // n_words", "dup_lines": "1000 * n_dup_lines // n_lines", "repeats": "1000 * n_repeat_words // n_words", "word_length": "1000 * word_chars // n_words"}
    high = "(length(bin(value)) - 1)"
    bucket = f"CASE WHEN value < 64 THEN value ELSE 32 * {high} - 160 + (value >> ({high} - 5)) END"
    value = "CASE WHEN bucket < 64 THEN bucket ELSE (32 + (bucket - 64) % 32) << (1 + (bucket - 64) // 32) END"
    made = ", ".join(f"q3['{r}'] + {REACH} * greatest(q3['{r}'] - q1['{r}'], {1000 * n} // q2['{length}']) AS {r}_fence" for r, (n, length) in EVENTS.items())

    def level(name: str, keys: str) -> str:
        k = f"{keys}, " if keys else ""
        return f"""
{name}_counts AS (SELECT {k}rate, bucket, {value} AS v, count(*) AS n FROM bucketed GROUP BY ALL),
{name}_ranked AS (SELECT *, sum(n) OVER (PARTITION BY {k}rate ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {k}rate) AS total FROM {name}_counts),
{name}_quartiles AS (SELECT {k}rate, max(total) AS n_docs, min(v) FILTER (upto * 4 >= total) AS q1, min(v) FILTER (upto * 4 >= total * 2) AS q2, min(v) FILTER (upto * 4 >= total * 3) AS q3 FROM {name}_ranked GROUP BY {k}rate),
{name}_fences AS (SELECT {k}n_docs, {made} FROM (SELECT {k}max(n_docs) AS n_docs, {", ".join(f"map(list(rate), list(q{i})) AS q{i}" for i in (1, 2, 3))} FROM {name}_quartiles {"GROUP BY " + keys if keys else ""}))"""

    pick = ", ".join(f"CASE WHEN o.n_docs >= {MIN_DOCS} THEN o.{r}_fence WHEN l.n_docs >= {MIN_DOCS} THEN l.{r}_fence ELSE a.{r}_fence END AS {r}_fence" for r in EVENTS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT rid, p, words[p] AS a, words[p + 1] AS b, words[p + 2] AS c FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM w WHERE len(words) >= 3)),
again AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows) WHERE n >= 2),
repeated AS (SELECT rid, count(DISTINCT p + s) AS n FROM again, (VALUES (0), (1), (2)) AS t(s) GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN repeated ON w.rid = repeated.rid),
r AS (SELECT lang, source, {", ".join(f"{v} AS {k}" for k, v in rate.items())}, n_words AS words, n_lines AS lines FROM m WHERE n_words > 0),
bucketed AS (SELECT lang, source, rate, {bucket} AS bucket FROM (UNPIVOT r ON {", ".join(rate)}, words, lines INTO NAME rate VALUE value)),
{level("own", "lang, source")}, {level("lang", "lang")}, {level("all", "")},
t AS (SELECT o.lang, o.source, {pick} FROM own_fences o JOIN lang_fences l ON o.lang = l.lang CROSS JOIN all_fences a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
  NOT base_failed AND n_words > 0 AND {" AND ".join(f"{v} <= {k}_fence" for k, v in rate.items())} AS kept,
  {", ".join(f"{r}_fence::BIGINT AS {r}_fence" for r in EVENTS)}
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m) LEFT JOIN t USING (lang, source)
"""
