"""Checks and subsets of a finished dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import lookups, metrics, sampling, splits


def violations(rows: DataFrame, labels: DataFrame, attribution: DataFrame, quotas: DataFrame, files: DataFrame | None = None, internal: bool = False, checked: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """check, key, n: every broken rule of split rows; an empty result is a valid dataset.

    internal=False is the strict mode: internal unknown labels are foreign and oversampled rows
    break a quota. internal=True allows those labels, counts unknown by public label and leaves
    repeated rows out of the counts, which is what the split builder writes.
    """
    rows = rows.where(F.col("split").isin(*checked))
    allowed = labels.select("label_id")
    if internal:
        allowed = allowed.union(rows.sparkSession.createDataFrame([(x,) for x in V.INTERNAL_UNKNOWN], "label_id string"))
    counted = rows.where("repeat_reason is null").withColumn("label_id", C.collapse(F.col("label_id"))) if internal else rows

    def found(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "key", "n")

    parts = [
        found("foreign_label", lookups.missing(rows, lookups.small(allowed), "label_id"), "label_id"),
        found("no_attribution", lookups.missing(rows, attribution, "photo_id"), "photo_id"),
        found("several_splits", splits.leaking(rows), "observation_id"),
        metrics.quota_violations(counted, quotas).where(F.col("split").isin(*checked)).select(F.lit("quota").alias("check"), F.concat_ws("/", "split", "label_id").alias("key"), (F.col("found") - F.col("quota")).alias("n")),
    ]
    if files is not None:
        parts.append(found("no_image", rows.withColumn("path", F.col("image_path")).join(files.select("path"), "path", "left_anti"), "image_path"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def malformed(examples: DataFrame) -> DataFrame:
    """Examples without messages or images; an error if there are no examples at all."""
    if examples.isEmpty():
        raise ValueError("there are no examples")
    return examples.where("messages is null or images is null")


def validate(found: DataFrame) -> None:
    """Raises an error that names the first violations."""
    first = found.orderBy("check", "key").limit(5).collect()
    if first:
        raise ValueError("; ".join(f"{r['check']}: {r['key']} ({r['n']})" for r in first))


def quota_table(spark: SparkSession, labels: list[str], known: dict[str, int], unknown: dict[str, int]) -> DataFrame:
    """split, label_id, quota: what each split has to have of each label."""
    rows = [(s, k, n) for s, n in known.items() for k in labels] + [(s, V.UNKNOWN, n) for s, n in unknown.items()]
    return spark.createDataFrame(rows, "split string, label_id string, quota long")


def smoke_subset(parts: dict[str, DataFrame], amounts: dict[str, int], place: str = "place") -> dict[str, DataFrame]:
    """The first rows of each split; dev only if it is there and wanted."""
    return {k: sampling.first_rows(parts[k], place, n) for k, n in amounts.items() if k != "dev" or (n > 0 and k in parts)}


def filter_missing(examples: DataFrame, files: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Examples whose images all exist; kept, removed, total."""
    kept = lookups.references_exist(examples, "images", files, key)
    return kept, metrics.kept_counts(examples, kept)


def test_examples(rows: DataFrame, root: str, n: int, allowed: list[str], mapping: dict[str, str], place: str = "place") -> DataFrame:
    """image, label: the first n examples with an image, paths resolved, labels collapsed."""
    image = F.try_element_at("images", F.lit(1))
    label = C.collapse_allowed(F.coalesce(C.assistant_label(F.col("messages")), F.lit(V.UNKNOWN)), allowed, mapping)
    return rows.where(F.trim(image) != "").orderBy(place).limit(n).select(C.resolve_path(image, root).alias("image"), label.alias("label"))


def self_test(catalog: DataFrame, prompt: str, adapter: DataFrame | None = None, required: list[str] | None = None) -> DataFrame:
    """name, status, details of the checks that need no model: size, uniqueness, parser, prompt, adapter files.

    catalog: label_id, kingdom. adapter: name, length of the files in its folder.
    """
    spark = catalog.sparkSession
    size = catalog.agg(F.count_if(F.col("kingdom") == "plants").alias("p"), F.count_if(F.col("kingdom") == "fungi").alias("f"), F.count_if(F.col("label_id") == V.UNKNOWN).alias("u"))
    right = (F.col("p") == 20) & (F.col("f") == 20) & (F.col("u") >= 1)

    def check(name: str, df: DataFrame, passed, failing: str = "FAIL") -> DataFrame:
        return df.select(F.lit(name).alias("name"), F.when(passed, "PASS").otherwise(failing).alias("status"), F.to_json(F.struct("*")).alias("details"))

    doubles = metrics.duplicates(catalog, "label_id").agg(F.count("*").alias("duplicates"))
    parsed = catalog.agg(F.count_if(C.label_mobile(F.concat(F.lit('{"label_id":"'), F.col("label_id"), F.lit('"}'))) != F.col("label_id")).alias("lost"))
    absent = catalog.agg(F.count_if(~F.lit(prompt).contains(F.col("label_id"))).alias("absent"))
    parts = [check("catalog_size", size, right), check("unique_labels", doubles, F.col("duplicates") == 0), check("parser_round_trip", parsed, F.col("lost") == 0), check("prompt_coverage", absent, F.col("absent") == 0)]
    if adapter is not None:
        wanted = spark.createDataFrame([(x,) for x in required or []], "name string")
        lacking = wanted.join(adapter.where("length > 0"), "name", "left_anti").agg(F.count("*").alias("lacking"))
        total = wanted.join(adapter, "name", "left").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        parts.append(check("adapter_files", lacking.join(F.broadcast(total)), F.col("lacking") == 0, "WARNING"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
