"""Writers of the curation tables. A table is never written where it is read: to a new folder, then swapped."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.session import written


def as_table(df: DataFrame, name: str, stored: bool = False) -> DataFrame:
    """A named intermediate, replaced if there is one; with stored it is computed now, once for all who read it."""
    df = written(df) if stored else df
    df.createOrReplaceTempView(name)
    return df


def python_json(df: DataFrame) -> Column:
    """A row of strings and string arrays as one JSON object, with ", " and ": " between; nulls are null."""
    fields = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            items = F.array_join(F.transform(f.name, lambda x: F.coalesce(C.json_text(x), F.lit("null"))), ", ")
            value = F.concat(F.lit("["), items, F.lit("]"))
        else:
            value = C.json_text(F.col(f.name)) if isinstance(f.dataType, T.StringType) else F.lower(F.col(f.name).cast("string"))
        fields.append(F.concat(C.json_text(F.lit(f.name)), F.lit(": "), F.coalesce(value, F.lit("null"))))
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def record_rows(selected: DataFrame, image_root: str, failed: DataFrame | None = None) -> DataFrame:
    """records.csv rows of selected candidates: fixed decimals, flags as words, failed downloads left out.

    failed has image_path rows of downloads that failed and left no file.
    """
    row = selected.withColumns({"image_path": C.planned_path(image_root, F.col("label_id"), F.col("photo_id")), "download_url": C.promote_size(F.col("image_url"))})
    if failed is not None:
        row = row.join(failed.select("image_path"), "image_path", "left_anti")
    special = {"latitude": C.coordinate(F.col("latitude")), "longitude": C.coordinate(F.col("longitude")), "is_poland": C.flag_text(F.col("is_poland"))}
    return row.select(*[special.get(n, F.col(n)).alias(n) for n in schemas.RECORDS.names])


def attribution_rows(records: DataFrame) -> DataFrame:
    return records.select(*schemas.ATTRIBUTION.names)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_json_lines(df: DataFrame, path: str, spaced: bool = False) -> None:
    """One object a line, non-ASCII kept; null fields left out, or with spaced kept, and blanks after "," and ":"."""
    if spaced:
        df.select(python_json(df).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def rewrite_json_lines(df: DataFrame, path: str) -> None:
    """Replaces a plain folder that df itself may read by two renames; between them a reader finds nothing (write_version has no such gap)."""
    fresh, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").json(fresh)
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    files = jvm(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(jvm(old), True)
    if files.exists(jvm(path)):
        files.rename(jvm(path), jvm(old))
    files.rename(jvm(fresh), jvm(path))
    files.delete(jvm(old), True)


def write_version(df: DataFrame, path: str) -> str:
    """Replaces the data of a folder that df itself may read; returns where the new version is.

    Versions lie side by side below the folder, and a pointer file names the one that holds. The pointer is
    written under another name and takes the old one's place in one rename, so a reader of
    current_version() finds the old data or the new, whatever step fails. The version before stays for those who
    still read it; older ones go.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    before = current_version(spark, path)
    fresh = f"{path.rstrip('/')}/_versions/{name}"
    df.write.json(fresh)
    pointer = f"{path.rstrip('/')}/_current"
    write_text(name, f"{pointer}.{name}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(pointer)
    options = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(options, 1)
    overwrite[0] = options.OVERWRITE
    files, settings, _ = _place(path)
    hadoop.FileContext.getFileContext(files.getUri(), settings).rename(hadoop.Path(f"{pointer}.{name}"), place, overwrite)
    for status in files.listStatus(hadoop.Path(f"{path.rstrip('/')}/_versions")):
        if status.getPath().getName() not in (name, before.rpartition("/")[2]):
            files.delete(status.getPath(), True)
    return fresh


def current_version(spark: SparkSession, path: str) -> str:
    """Where the data of a folder is: the version that its pointer names, or the folder itself if it has none."""
    files, _, pointer = _place(f"{path.rstrip('/')}/_current")
    if not files.exists(pointer):
        return path
    return f"{path.rstrip('/')}/_versions/{read_text(spark, pointer.toString())}"


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    files, _, place = _place(path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def label_document(entries: DataFrame, internal_unknown: bool = True) -> str:
    """labels.json of a catalog's rows (label_id, kingdom, names, place): at most some tens of labels."""
    rows = [r.asDict() for r in entries.where(~F.col("label_id").isin(V.UNKNOWN, *V.INTERNAL_UNKNOWN)).orderBy("place").collect()]
    public = [{k: r[k] for k in schemas.MANIFEST.names} for r in rows] + [dict(zip(schemas.MANIFEST.names, V.UNKNOWN_ENTRY, strict=True))]
    internal = [dict(zip(schemas.MANIFEST.names, e, strict=True)) | {"public_label_id": V.UNKNOWN} for e in V.INTERNAL_ENTRIES] if internal_unknown else []
    names = [p["label_id"] for p in public]
    document = {
        "supported_labels": names,
        "training_supported_labels": [n for n in names if n != V.UNKNOWN or not internal_unknown] + [i["label_id"] for i in internal],
        "collapse_to_public": {i["label_id"]: V.UNKNOWN for i in internal},
        "by_id": {p["label_id"]: p for p in public + internal},
    }
    return json.dumps(document, ensure_ascii=False, indent=2)


def json_schema(labels: DataFrame) -> DataFrame:
    """One row: the JSON-Schema text that allows the labels (column label), sorted without regard to case."""
    ordered = labels.select("label").distinct().agg(F.transform(F.array_sort(F.collect_list(F.struct(F.upper("label").alias("k"), "label"))), lambda x: x["label"]).alias("labels"))
    start, end = '{"type":"object","properties":{"label_id":{"type":"string","enum":', '}},"required":["label_id"],"additionalProperties":false}'
    return ordered.select(F.concat(F.lit(start), F.to_json("labels"), F.lit(end)).alias("schema"))


def copied_files(pairs: DataFrame, out: str) -> DataFrame:
    """target, length of every distinct (source, target) pair, once copied to a folder by the tasks that hold them.

    Any file system that Arrow reaches will do, the source's and the target's may differ; bytes go in
    pieces. A file is written under a name of its own and then takes its place, so a task that is run twice, or
    dies half-way, leaves one whole file or none. A missing source is an error; a target that is
    already there is left alone.
    """
    base = out.rstrip("/")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened(path: str) -> tuple[fs.FileSystem, str]:
            return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)

        for batch in batches:
            lengths = []
            for source, target in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
                there, path = opened(f"{base}/{target}")
                found = there.get_file_info(path)
                if found.type == fs.FileType.NotFound:
                    here, own = opened(source)
                    there.create_dir(path.rpartition("/")[0])
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    with here.open_input_stream(own) as read, there.open_output_stream(part) as write:
                        while piece := read.read(1 << 20):
                            write.write(piece)
                    there.move(part, path)
                    found = there.get_file_info(path)
                lengths.append(found.size)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lengths, pa.int64())], names=["target", "length"])

    return written(pairs.distinct().repartition("target").mapInArrow(copy, "target string, length long"))


def bundle(examples: DataFrame, out: str, prefix: str = "") -> DataFrame:
    """Copies the examples' images to images/<folder>/<name> of a folder and points the examples there (see copied_files)."""
    images = examples.select(F.explode("images").alias("image")).select("image", C.portable_path(F.col("image")).alias("target"))
    # Images of one target: the first in path order is the one that comes.
    copied_files(images.groupBy("target").agg(F.min("image").alias("image")).select("image", "target"), out)
    return examples.withColumn("images", F.transform("images", lambda i: C.portable_path(i, prefix)))


def _place(path: str):
    """A path's Hadoop file system, configuration and path."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    place, settings = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    return place.getFileSystem(settings), settings, place


def copy_side_files(source: str, out: str, names: tuple[str, ...] = ("labels.json", "species_manifest.csv", "attribution.csv", "records.csv"), fall_back_to_parent: bool = True) -> list[str]:
    """Small files beside a dataset; one that is missing is looked for in the parent folder."""
    copied = []
    parent = source.rstrip("/").rpartition("/")[0]
    for name in names:
        for folder in (source, parent) if fall_back_to_parent else (source,):
            files, settings, place = _place(f"{folder.rstrip('/')}/{name}")
            if files.exists(place) and not files.getFileStatus(place).isDirectory():
                to, _, target = _place(f"{out.rstrip('/')}/{name}")
                to.mkdirs(target.getParent())
                stream = to.create(target, True)
                # Copies the bytes, and closes both.
                SparkSession.getActiveSession()._jvm.org.apache.hadoop.io.IOUtils.copyBytes(files.open(place), stream, settings, True)
                copied.append(name)
                break
    return copied


def write_summary(summary: DataFrame, path: str) -> str:
    """The evaluation's one row as an indented document; returns a digest rounded to four places."""
    row = json.loads(summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first()["j"])
    write_text(json.dumps(row, ensure_ascii=False, indent=2), path)
    return "\n".join(f"{k}: {v:.4f}" if isinstance(v, float) else f"{k}: {v}" for k, v in row.items() if isinstance(v, (int, float)))


def write_text(content: str, path: str) -> None:
    """A small text to a file of any file system that Spark writes; folders are made."""
    files, _, place = _place(path)
    files.mkdirs(place.getParent())
    stream = files.create(place, True)
    stream.write(bytearray(content.encode()))
    stream.close()
