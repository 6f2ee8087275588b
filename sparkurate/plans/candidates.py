"""From raw metadata to selected candidates: one lazy plan, materialised by no step on the way.

Shuffles: (label, flag) for the caps, observation for the first photo and the join, (label,
observer) for the selection. Names and the manifest are broadcast, caps and ranks are bounded
before their shuffles, photos meet the pool in a semi join before they are ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import lookups, sampling
from sparkurate.session import written


def taxa(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """Plant and fungus taxa, with the label of those that the manifest names."""
    typed = raw.select(F.col("taxon_id").cast("string").alias("taxon_id"), F.coalesce("name", F.lit("")).alias("scientific_name"), C.kingdom_of_taxon(F.col("taxon_id").cast("string"), F.col("ancestry")).alias("kingdom"))
    return lookups.match_names(typed.where("kingdom is not null"), lookups.with_aliases(manifest))


def observations(raw: DataFrame, known_taxa: DataFrame) -> DataFrame:
    """Observations of good quality in the region, with their taxon and the priority flag."""
    typed = raw.select(
        F.col("observation_uuid").cast("string").alias("observation_id"), F.coalesce(F.col("observer_id").cast("string"), F.lit("unknown_observer")).alias("observer_id"), F.col("taxon_id").cast("string").alias("taxon_id"),
        F.lower(F.coalesce("quality_grade", F.lit(""))).alias("quality_grade"), C.to_double(F.col("latitude")).alias("latitude"), C.to_double(F.col("longitude")).alias("longitude"),
    )
    inside = typed.where(C.in_box(F.col("longitude"), F.col("latitude"), V.REGION) & F.col("quality_grade").isin(*V.QUALITY_GRADES)).drop("quality_grade")
    named = known_taxa.withColumns({"polish_name": F.coalesce("polish_name", F.lit(V.UNKNOWN_ENTRY[3])), "english_name": F.coalesce("english_name", F.lit(V.UNKNOWN))})
    return inside.join(named, "taxon_id").withColumn("is_poland", C.in_priority_region(F.col("longitude"), F.col("latitude")))


def pool(found: DataFrame, known_caps: tuple[int, int] = V.KNOWN_CAPS, unknown_caps: tuple[int, int] = V.UNKNOWN_CAPS, seed: int = V.SEED) -> DataFrame:
    """Capped observations: known ones by label and flag, the others by flag as unknown."""
    known = sampling.stratified_cap(found.where("label_id is not null"), ["label_id"], "is_poland", ["observation_id"], known_caps, seed)
    other = sampling.stratified_cap(found.where("label_id is null"), [], "is_poland", ["observation_id"], unknown_caps, seed)
    named = other.withColumns({"label_id": F.lit(V.UNKNOWN), "polish_name": F.lit(V.UNKNOWN_ENTRY[3]), "english_name": F.lit(V.UNKNOWN)})
    return known.unionByName(named).drop("rn")


def first_photos(raw: DataFrame, pooled: DataFrame) -> DataFrame:
    """The first photo of each pooled observation, if its licence is allowed; a later photo doesn't stand in."""
    typed = raw.select(
        F.col("observation_uuid").cast("string").alias("observation_id"), F.col("photo_id").cast("string").alias("photo_id"), F.lower(F.coalesce("extension", F.lit(""))).alias("extension"),
        C.license_sql(F.col("license")).alias("license_code"), F.coalesce(F.col("observer_id").cast("string"), F.lit("")).alias("photographer"), C.to_whole(F.col("position")).alias("position"),
    )
    order = [F.coalesce("position", F.lit(2**31 - 1)), C.to_whole(F.col("photo_id"), "bigint").asc_nulls_last(), F.col("photo_id").asc_nulls_last()]
    first = sampling.best_per_key(lookups.semi(typed.where("extension <> ''"), pooled, "observation_id"), "observation_id", order)
    allowed = first.where(F.col("license_code").isin(*V.ALLOWED_LICENSES))
    return allowed.select("observation_id", "photo_id", "license_code", "photographer", C.photo_url(F.col("photo_id"), F.col("extension")).alias("image_url"), C.photo_page(F.col("photo_id")).alias("source_url"))


def candidates(raw_taxa: DataFrame, raw_observations: DataFrame, raw_photos: DataFrame, manifest: DataFrame, **caps) -> DataFrame:
    """All five stages; the columns of schemas.CANDIDATE."""
    pooled = pool(observations(raw_observations, taxa(raw_taxa, manifest)), **caps)
    joined = pooled.join(first_photos(raw_photos, pooled), "observation_id")
    filled = joined.withColumns({"photographer": C.first_filled(F.col("photographer"), F.col("observer_id")), "country_code": F.lit("")})
    return filled.select(*schemas.CANDIDATE.names)


def select(found: DataFrame, manifest: DataFrame, per_label: int = V.POOL_PER_LABEL, unknown: int = V.UNKNOWN_POOL, seed: int = V.SEED, place: str | None = None, most_rows: int = V.UNKNOWN_CAPS[1]) -> tuple[DataFrame, DataFrame]:
    """Chosen candidates, and label_id, missing of each label that got less than its quota.

    Rows of a label are in the order of md5 keys; or, with place (a column of row numbers), in that of one seeded
    generator that shuffles each label's priority rows and then its others, label after label by
    the manifest's places. Observations with several observers are chosen by greedy rounds.
    """
    spark = found.sparkSession
    quotas = manifest.select("label_id", F.lit(per_label).alias("quota")).union(spark.range(1).select(F.lit(V.UNKNOWN), F.lit(unknown)))
    asked, order = found.join(lookups.small(quotas), "label_id"), None
    if place:
        labels = [r["label_id"] for r in manifest.orderBy("place").collect()] + [V.UNKNOWN]
        asked = asked.withColumn("_bucket", F.concat_ws("|", "label_id", F.col("is_poland").cast("string")))
        asked = written(sampling.seeded(asked, "_bucket", place, [f"{label}|{flag}" for label in labels for flag in ("true", "false")], most_rows, seed, name="_drawn"))
        order = [F.col("is_poland").desc(), F.col("_drawn")]
    choose = sampling.diverse_top if sampling.one_observer_each(asked, "observation_id", "observer_id") else sampling.greedy_top
    chosen = choose(asked, "label_id", "observation_id", "observer_id", "is_poland", ["photo_id", "observation_id"], F.col("quota"), seed=seed, order=order)
    return chosen.select(*found.columns), sampling.shortages(chosen, quotas)
