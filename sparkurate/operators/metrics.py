"""Counts, quotas and classification metrics. All come from one confusion table, however many rows there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import lookups, ordering


def confusion(rows: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """truth, pred, n, and the place of the pair's first row if rows have a ``place``."""
    first = [F.min("place").alias("first_place")] if "place" in rows.columns else []
    return rows.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"), *first)


def label_domain(confused: DataFrame, known: DataFrame) -> DataFrame:
    """label: the known ones, and every truth and prediction."""
    return known.select("label").union(confused.select("truth")).union(confused.select("pred")).distinct()


def per_class(confused: DataFrame, known: DataFrame) -> DataFrame:
    """label, tp, fp, fn, support, precision, recall, f1 of the whole domain; 0 where undefined."""
    hit = F.col("truth") == F.col("pred")
    both = F.explode(F.array(F.struct(F.col("truth").alias("label"), F.lit(True).alias("is_truth")), F.struct(F.col("pred").alias("label"), F.lit(False).alias("is_truth")))).alias("s")
    sides = confused.select("n", hit.alias("hit"), both)
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    truth = F.col("s.is_truth")
    sums = sides.groupBy(F.col("s.label").alias("label")).agg(total(truth & F.col("hit")).alias("tp"), total(~truth & ~F.col("hit")).alias("fp"), total(truth & ~F.col("hit")).alias("fn"), total(truth).alias("support"))
    whole = known.select("label").distinct().join(sums, "label", "full").select("label", *[F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in ("tp", "fp", "fn", "support")])
    rates = whole.withColumns({"precision": C.divide_or_zero(F.col("tp"), F.col("tp") + F.col("fp")), "recall": C.divide_or_zero(F.col("tp"), F.col("tp") + F.col("fn"))})
    return rates.withColumn("f1", C.divide_or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def macro(classes: DataFrame, known: DataFrame) -> DataFrame:
    """One row: accuracy, macro-F1 over known labels (unknown aside) and over the domain, figures of unknown."""
    marked = classes.join(lookups.small(known.select("label").distinct().withColumn("_known", F.lit(True))), "label", "left")
    in_known = F.col("_known") & (F.col("label") != V.UNKNOWN)
    of_unknown = lambda k: F.coalesce(F.max(F.when(F.col("label") == V.UNKNOWN, F.col(k))), F.lit(0.0))
    return marked.agg(
        C.divide_or_zero(F.sum("tp"), F.sum("support")).alias("accuracy"),
        C.divide_or_zero(F.sum(F.when(in_known, F.col("f1"))), F.count(F.when(in_known, 1))).alias("macro_f1_known"),
        C.divide_or_zero(F.sum("f1"), F.count("*")).alias("macro_f1_all"),
        *[of_unknown(k).alias(f"unknown_{k}") for k in ("precision", "recall", "f1")],
    )


def top_confusions(confused: DataFrame, known: DataFrame, n: int = 25) -> DataFrame:
    """The most frequent errors on known labels; ties keep the labels' order, then the first row's."""
    errors = confused.where("truth <> pred").join(lookups.small(known.select(F.col("label").alias("truth"), "label_place")), "truth")
    return errors.orderBy(F.desc("n"), "label_place", "first_place").limit(n).select("truth", "pred", "n")


def json_rates(scanned: DataFrame) -> DataFrame:
    """One row: num_examples, valid_json_rate, exact_json_match_rate of rows with valid and exact flags."""
    rate = lambda k: C.divide_or_zero(F.sum(F.col(k).cast("int")).cast("double"), F.count("*"))
    return scanned.agg(F.count("*").alias("num_examples"), rate("valid").alias("valid_json_rate"), rate("exact").alias("exact_json_match_rate"))


def quota_violations(rows: DataFrame, quotas: DataFrame, keys: tuple[str, ...] = ("split", "label_id")) -> DataFrame:
    """keys, found, quota where the count isn't the quota, either side missing included."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("found"))
    both = quotas.select(*keys, "quota").join(counts, list(keys), "full").select(*keys, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("quota", F.lit(0)).cast("long").alias("quota"))
    return both.where("found <> quota")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def status_summary(checks: DataFrame) -> DataFrame:
    """One row: passed, warned, failed, line."""
    counts = checks.agg(*[F.count_if(F.col("status") == s).alias(n) for n, s in (("passed", "PASS"), ("warned", "WARNING"), ("failed", "FAIL"))])
    return counts.withColumn("line", C.summary_line(F.col("passed"), F.col("warned"), F.col("failed")))


def suite_accuracy(rows: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """One row: correct, total, accuracy."""
    return rows.agg(F.count_if(F.col(truth) == F.col(pred)).alias("correct"), F.count("*").alias("total")).withColumn("accuracy", C.divide_or_zero(F.col("correct"), F.col("total")))


def kept_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: kept, removed, total."""
    marked = before.select(F.lit(0).alias("k")).union(after.select(F.lit(1).alias("k")))
    return marked.agg(F.sum("k").alias("kept"), F.count_if(F.col("k") == 0).alias("total")).select("kept", (F.col("total") - F.col("kept")).alias("removed"), "total")


def ordered_text(df: DataFrame, keys: list[str], order: str, value: str, separator: str) -> DataFrame:
    """keys, text: a group's values in order, joined; of equal places in value order. A hot key is dealt over many tasks."""
    return ordering.joined_text(df, keys, [F.col(order), F.col(value)], value, separator)
