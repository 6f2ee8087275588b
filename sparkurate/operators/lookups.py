"""Joins with catalogs and key sets. Catalogs have some tens of rows: their broadcast is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V

#: More rows than this aren't a catalog; the join is left to Spark then.
CATALOG_ROWS = 10_000


def small(df: DataFrame, rows: int = CATALOG_ROWS) -> DataFrame:
    """df to broadcast if it is as small as a catalog, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_aliases(manifest: DataFrame, aliases: dict[str, tuple[str, ...]] | None = None, name: str = "scientific_name") -> DataFrame:
    """A row for each name and each synonym of a manifest."""
    aliases = V.ALIASES if aliases is None else aliases
    other = F.array().cast("array<string>")
    for own, synonyms in aliases.items():
        other = F.when(F.col(name) == own, F.array(*map(F.lit, synonyms))).otherwise(other)
    return manifest.withColumn(name, F.explode(F.concat(F.array(name), other)))


def match_names(taxa: DataFrame, manifest: DataFrame, name: str = "scientific_name") -> DataFrame:
    """Every taxon, with the manifest row of its name in any case where there is one."""
    right = manifest.select(F.lower(name).alias("_key"), "label_id", "polish_name", "english_name")
    return taxa.join(small(right), F.lower(taxa[name]) == F.col("_key"), "left").drop("_key")


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def missing(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def lookup_strict(df: DataFrame, catalog: DataFrame, key: str = "label_id") -> DataFrame:
    """Rows with their catalog entry; a label without one is an error when it is met."""
    right = small(catalog.withColumn("_found", F.lit(True)))
    checked = F.when(F.col("_found"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(key), F.lit("null")))).cast("string"))
    return df.join(right, key, "left").withColumn(key, checked).drop("_found")


def lookup_public(df: DataFrame, catalog: DataFrame, key: str = "label_id", mapping: dict[str, str] | None = None) -> DataFrame:
    """Rows with the entry of their public label, else the one of unknown, else built-in values."""
    names = schemas.MANIFEST.names[1:]
    right = small(catalog.select(F.col("label_id").alias("_public"), *[F.col(n).alias(f"_{n}") for n in names]))
    fallback = small(catalog.where(F.col("label_id") == V.UNKNOWN).agg(*[F.first(n).alias(f"_u_{n}") for n in names]))
    joined = df.withColumn("_public", C.collapse(F.col(key), mapping)).join(right, "_public", "left").join(fallback)
    built_in = dict(zip(names, ("unknown",) * 4, strict=True))
    return joined.select(*[df[c] for c in df.columns], *[F.coalesce(f"_{n}", f"_u_{n}", F.lit(built_in[n])).alias(n) for n in names])


def by_folded_key(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """A left join on a key in any case."""
    right = other.withColumnRenamed(key, "_key")
    return df.join(small(right), F.lower(df[key]) == F.lower(F.col("_key")), "left").drop("_key")


def map_of(df: DataFrame, key: str, value: str, fold: bool = False) -> DataFrame:
    """One row, one map of a catalog; the last value of a key holds."""
    k = F.lower(key) if fold else F.col(key)
    last = df.groupBy(k.alias("k")).agg(F.last(value).alias("v"))
    return last.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("map"))


def variants(df: DataFrame, names: list[str], name: str = "variant") -> DataFrame:
    """Every row once for each of a few variants given in code: an array, exploded, not a join."""
    return df.withColumn(name, F.explode(F.array(*map(F.lit, names))))


def attribute_failures(selected: DataFrame, failed: DataFrame) -> DataFrame:
    """label_id, missing: failed downloads (image_path) by the label of their record."""
    return failed.select("image_path").join(selected.select("label_id", "image_path"), "image_path").groupBy("label_id").agg(F.count("*").alias("missing"))


def references_exist(df: DataFrame, references: str, files: DataFrame, key: list[str]) -> DataFrame:
    """Rows all of whose references (an array; none is fine) are paths of files."""
    absent = df.select(*key, F.explode(references).alias("path")).join(files.select("path"), "path", "left_anti").select(*key).distinct()
    return df.join(absent, key, "left_anti")


def schema_difference(required: list[str], df: DataFrame) -> DataFrame:
    """column_name of each required column that df lacks."""
    spark: SparkSession = df.sparkSession
    have = F.array(*map(F.lit, df.columns)) if df.columns else F.array().cast("array<string>")
    return spark.range(1).select(F.explode(F.array_except(F.array(*map(F.lit, required)), have)).alias("column_name"))


def slot_table(spark: SparkSession, quotas: dict[str, int]) -> DataFrame:
    """split, low, high: the places that each quota covers."""
    rows, start = [], 0
    for name, n in quotas.items():
        rows.append((name, start + 1, start + n))
        start += n
    return spark.createDataFrame(rows, T.StructType([T.StructField("split", T.StringType()), T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())]))


