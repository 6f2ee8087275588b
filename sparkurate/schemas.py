"""Schemas of the curation tables. Raw metadata is read as strings and typed by projections."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The column names of the file formats.
TAXA = strings("taxon_id", "name", "ancestry")
OBSERVATIONS = strings("observation_uuid", "observer_id", "taxon_id", "quality_grade", "latitude", "longitude")
PHOTOS = strings("observation_uuid", "photo_id", "extension", "license", "observer_id", "position")
MANIFEST = strings("label_id", "kingdom", "scientific_name", "polish_name", "english_name")
RECORDS = strings(
    "label_id", "kingdom", "scientific_name", "polish_name", "english_name", "photo_id", "observation_id", "observer_id", "license_code",
    "photographer", "image_path", "source_url", "download_url", "latitude", "longitude", "country_code", "is_poland",
)
ATTRIBUTION = strings("photo_id", "observation_id", "label_id", "scientific_name", "photographer", "license_code", "source_url", "download_url")
SPLIT_RECORDS = T.StructType([*RECORDS.fields, *strings("source_label_id", "public_label_id", "split", "repeat_reason").fields])
MESSAGE = strings("role", "content")
EXAMPLES = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), T.StructField("images", T.ArrayType(T.StringType()))])
RESULTS = T.StructType([T.StructField("labels", T.StringType()), T.StructField("response", T.StringType()), T.StructField("images", T.ArrayType(T.StringType()))])
CATALOG_ENTRY = T.StructType([*MANIFEST.fields, T.StructField("public_label_id", T.StringType())])
LABEL_CATALOG = T.StructType(
    [
        T.StructField("supported_labels", T.ArrayType(T.StringType())),
        T.StructField("training_supported_labels", T.ArrayType(T.StringType())),
        T.StructField("collapse_to_public", T.MapType(T.StringType(), T.StringType())),
        T.StructField("by_id", T.MapType(T.StringType(), CATALOG_ENTRY)),
    ]
)
MEDIA = strings("label_id", "title", "description", "source_url", "image_file", "image_url", "search_query", "downloaded_at", "dataset_image_source")
DIAGNOSTIC = T.StructType(
    [
        *strings("profile", "status", "backend").fields,
        T.StructField("gpu_layers", T.IntegerType()),
        T.StructField("vision_gpu", T.BooleanType()),
        T.StructField("flash_attention", T.StringType()),
        *[T.StructField(n, T.IntegerType()) for n in ("image_min_tokens", "image_max_tokens")],
        T.StructField("force_response_prefix", T.BooleanType()),
        *[T.StructField(n, T.IntegerType()) for n in ("max_new_tokens", "n_past_after_prefill")],
        *[T.StructField(n, T.LongType()) for n in ("model_load_ms", "projector_load_ms", "prefill_ms", "generation_ms", "total_ms")],
        T.StructField("first_token_ids", T.ArrayType(T.IntegerType())),
        *strings("raw_text", "extracted_label_id", "normalized_text").fields,
    ]
)
CANDIDATE = T.StructType([*strings("label_id", "kingdom", "scientific_name", "polish_name", "english_name", "photo_id", "observation_id", "observer_id", "license_code", "photographer", "image_url", "source_url").fields, T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()), T.StructField("country_code", T.StringType()), T.StructField("is_poland", T.BooleanType())])
