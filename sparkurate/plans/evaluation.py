"""Evaluation of free-text answers against the truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import jsonscan
from sparkurate.operators import metrics
from sparkurate.session import scratch_folder


def scanned(results: DataFrame) -> DataFrame:
    """results (labels, response, images, place) with truth, pred, valid, exact; a missing text is empty.

    exact: both texts hold the same object, or none.
    """
    both = results.withColumns({"_t": jsonscan.scan(F.coalesce("labels", F.lit(""))), "_p": jsonscan.scan(F.coalesce("response", F.lit("")))})
    return both.withColumns({"truth": F.col("_t.label"), "pred": F.col("_p.label"), "valid": F.col("_p.valid"), "exact": F.col("_t.parsed").eqNullSafe(F.col("_p.parsed"))}).drop("_t", "_p")


def invalid_examples(rows: DataFrame, n: int = 50) -> DataFrame:
    """The first rows whose answer has no label: image, labels, response."""
    bad = rows.where(F.col("pred").isin("invalid_json", "missing_label"))
    return bad.orderBy("place").limit(n).select("place", F.coalesce(F.try_element_at("images", F.lit(1)), F.lit("")).alias("image"), "labels", "response")


def evaluate(results: DataFrame, known: DataFrame, mapping: dict[str, str] | None = None, top: int = 25, invalid: int = 50) -> DataFrame:
    """One row: rates, metrics, per_class map, top_confusions, invalid_examples.

    known: label, label_place of the supported labels. Labels collapse after the exact match.
    The rows are scanned once, to a written table; everything else comes from the confusion table.
    """
    spark, folder = results.sparkSession, scratch_folder(results.sparkSession)
    scanned(results).write.parquet(folder)
    rows = spark.read.parquet(folder)
    pairs = rows.withColumns({"truth": C.collapse(F.col("truth"), mapping), "pred": C.collapse(F.col("pred"), mapping)})
    confused = metrics.confusion(pairs)
    classes = metrics.per_class(confused, known)
    by_label = classes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", F.struct("precision", "recall", "f1", "support"))))).alias("per_class"))
    errors = metrics.top_confusions(confused, known, top).agg(F.collect_list(F.struct("truth", "pred", F.col("n").alias("count"))).alias("top_confusions"))
    bad = invalid_examples(rows, invalid).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "image", "labels", "response"))), lambda x: F.struct(x["image"].alias("image"), x["labels"].alias("labels"), x["response"].alias("response"))).alias("invalid_examples"))
    # Every part has one row.
    out = metrics.json_rates(rows)
    for part in (metrics.macro(classes, known), by_label, errors, bad):
        out = out.join(F.broadcast(part))
    return out
