"""Readers: discovery, untyped CSV, manifests, JSON lines, catalogs, inventories."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.session import written
from sparkurate.sources import lines

_SUFFIXES = (".csv", ".csv.gz", ".tsv", ".tsv.gz", ".parquet")
_SHARD_SUFFIXES = (".csv", ".csv.gz", ".parquet")


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def listed(spark: SparkSession, folder: str, deep: bool = False) -> list[str]:
    """Paths of the files in a folder of any file system that Spark reads, sorted."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    files, found = system.listFiles(place, deep), []
    while files.hasNext():
        found.append(re.sub(r"^file:/+", "/", files.next().getPath().toString()))
    return sorted(found)


def find_files(folder: str, stem: str, all_shards: bool = False, spark: SparkSession | None = None) -> list[str]:
    """Paths of a table's file by its stem: the folder itself comes before its subfolders.

    A whole file is preferred to shards (stem-*). Of several matches the first in order is
    taken, unless all_shards asks for every one.
    """
    wanted = [f"{stem}{s}" for s in _SUFFIXES] + [f"{stem}-*{s}" for s in _SHARD_SUFFIXES]
    for deep in (False, True):
        files = listed(spark or _session(), folder, deep)
        for pattern in wanted:
            found = [f for f in files if fnmatchcase(f.rpartition("/")[2], pattern)]
            if found:
                return found if all_shards else found[:1]
    raise FileNotFoundError(f"no file of the table {stem!r} in {folder}")


_SEPARATORS = ("\t", ",", ";", "|")


def _header(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).first()
    return first["value"].removeprefix("\ufeff") if first else ""


def _separator(header: str) -> str:
    return max(_SEPARATORS, key=header.count)


def sniff_delimiter(path: str, spark: SparkSession | None = None) -> str:
    """The separator that the header line has most of."""
    return _separator(_header(spark or _session(), path))


def _names(header: str, separator: str) -> tuple[str, ...]:
    return tuple(n.strip() for n in next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline=""), delimiter=separator), []))


def _shapes(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, bool]]:
    """file, header line, whether a record of it spans lines; one row a file meets the driver."""
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"))
    spans = [F.max(lines.opens(F.col("value"), s)).alias(f"spans{i}") for i, s in enumerate(_SEPARATORS)]
    found = rows.groupBy("file").agg(F.min_by("value", "at").alias("header"), *spans).orderBy("file").collect()
    return [(r["file"], r["header"], r[f"spans{_SEPARATORS.index(_separator(r['header']))}"]) for r in found]


def _parsed(records: DataFrame, names: tuple[str, ...], separator: str) -> DataFrame:
    """Columns of records given as text; those of another number of fields are dropped."""
    ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in (*names, "_malformed"))
    options = {"sep": separator, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = records.select(F.from_csv("value", F.lit(ddl), options).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col("r._malformed").isNull()).select(*[F.col("r").getField(n).alias(n) for n in names])


def read_untyped(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Every column a string; records of another number of fields are dropped. Parquet is read as such.

    Columns are chosen by each file's own header, so files may have more and in any order; a column that
    a file lacks is null in its rows. Quoted fields may hold line ends: files with such records are
    put together from lines in any splits (lines.records), all others are read as they are. A first
    look at the text tells which. A gzip file is one task: its rows are dealt out at once. The
    session's settings don't matter.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if paths[0].endswith(".parquet"):
        table = spark.read.parquet(*paths)
        names = schema.names if schema else table.columns
        return table.select(*[F.col(n).cast("string").alias(n) for n in names])
    plain: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    spanning: dict[str, list[str]] = {}
    for file, header, spans in _shapes(spark, paths):
        separator = _separator(header)
        if spans:
            spanning.setdefault(separator, []).append(file)
        else:
            plain.setdefault((separator, _names(header, separator)), []).append(file)
    # A pruned read would keep malformed rows: this one reads all columns, which are chosen after it.
    options = {"header": True, "mode": "DROPMALFORMED", "escape": '"', "multiLine": False, "columnPruning": False}
    tables = []
    for (separator, names), files in plain.items():
        table = spark.read.schema(schemas.strings(*names)).options(sep=separator, **options).csv(files)
        tables.append(table.repartition(spark.sparkContext.defaultParallelism) if any(f.endswith(".gz") for f in files) else table)
    for separator, files in spanning.items():
        records = written(lines.records(spark, files, separator))
        heads = records.groupBy("file").agg(F.min("place").alias("place"), F.min_by("value", "place").alias("header")).orderBy("file").collect()
        body = records.join(records.groupBy("file").agg(F.min("place").alias("head")), "file").where(F.col("place") > F.col("head"))
        by_names: dict[tuple[str, ...], list[str]] = {}
        for r in heads:
            by_names.setdefault(_names(r["header"], separator), []).append(r["file"])
        tables += [_parsed(body.where(F.col("file").isin(files_of)), names, separator) for names, files_of in by_names.items()]
    if not tables:
        return spark.createDataFrame([], schema or T.StructType([]))
    table = tables[0]
    for more in tables[1:]:
        table = table.unionByName(more, allowMissingColumns=True)
    if not schema:
        return table
    return table.select(*[F.col(n) if n in table.columns else F.lit(None).cast("string").alias(n) for n in schema.names])


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def read_manifest(spark: SparkSession, path: str, size: int = V.MANIFEST_SIZE) -> DataFrame:
    """label_id, kingdom (lower case), names, trimmed, and the place of each row; an error unless there are ``size``."""
    table = read_untyped(spark, path)
    missing = missing_columns(table, schemas.MANIFEST.names)
    if missing:
        raise ValueError(f"the manifest lacks the columns {missing}")
    trimmed = [C.strip(F.coalesce(F.col(n), F.lit(""))) for n in schemas.MANIFEST.names]
    table = table.select(*[(F.lower(c) if n == "kingdom" else c).alias(n) for n, c in zip(schemas.MANIFEST.names, trimmed, strict=True)])
    rows = table.limit(size + 1).collect()
    if len(rows) != size:
        raise ValueError(f"the manifest has {'more than ' if len(rows) > size else ''}{min(len(rows), size)} rows, not {size}")
    # Forty rows: a literal table, each with its place.
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], T.StructType([*schemas.MANIFEST.fields, T.StructField("place", T.IntegerType())]))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """records.csv as strings; an error if it has no rows."""
    table = read_untyped(spark, path)
    if table.isEmpty():
        raise ValueError(f"{path} has no records")
    return table


def read_attribution_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_untyped(spark, path).select("photo_id").distinct()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object a line; blank lines count for nothing."""
    return spark.read.schema(schema).json(path)


def read_json_lines_in_order(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """As read_json_lines, with file, line and place: the number of a row's line in its file, and over all files in path order."""
    rows = lines.numbered(spark, path).where(F.trim("value") != "")
    return rows.select("file", "line", "place", F.from_json("value", schema).alias("r")).select(*[F.col("r").getField(n).alias(n) for n in schema.names], "file", "line", "place")


def first_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType, n: int) -> DataFrame:
    """The first n rows in file order with their place; an error if there are fewer. Nothing is sorted."""
    rows = lines.first_lines(spark, path, n).select("place", F.from_json("value", schema).alias("r"))
    return rows.select(*[F.col("r").getField(c).alias(c) for c in schema.names], "place")


def read_json_lines_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As read_json_lines, but the first bad row is an error that names its file and line.

    First is by file, then by line; both passes are Spark's, so any file system will do.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")]
    lines = spark.read.text(path).select("value", *place)
    broken = lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull())
    first = broken.agg(F.min(F.struct("file", "block", "row")).alias("at")).first()["at"]
    if first:
        before = lines.where((F.col("file") == first["file"]) & ((F.col("block") < first["block"]) | ((F.col("block") == first["block"]) & (F.col("row") <= first["row"]))))
        local = re.sub(r"^file:/+", "/", first["file"])
        raise ValueError(f"bad JSON in {local} at line {before.count()}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_label_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row: supported_labels, training_supported_labels, collapse_to_public, by_id."""
    return spark.read.schema(schemas.LABEL_CATALOG).option("multiLine", True).json(path)


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """One row for each label of a catalog, its public label filled in."""
    rows = catalog.select("collapse_to_public", F.explode("by_id").alias("id", "e"))
    public = F.coalesce(F.col("e.public_label_id"), F.try_element_at("collapse_to_public", F.col("id")), F.col("id"))
    return rows.select(F.col("id").alias("label_id"), *[F.col(f"e.{n}").alias(n) for n in schemas.MANIFEST.names[1:]], public.alias("public_label_id"))


def supported_labels(catalog: DataFrame) -> DataFrame:
    """Both label lists of a catalog as one, whatever their case."""
    both = F.array_union(F.coalesce("supported_labels", F.array().cast("array<string>")), F.coalesce("training_supported_labels", F.array().cast("array<string>")))
    rows = catalog.select(F.posexplode(C.without_blanks(both)).alias("place", "label"))
    return rows.groupBy(F.lower("label").alias("folded")).agg(F.min_by("label", "place").alias("label")).select("label")


def read_media(spark: SparkSession, folder: str) -> DataFrame:
    """The folder's JSON documents by label in any case: malformed ones are skipped, the last file of a label holds.

    image_path is that of the document's image file in the folder, null if it isn't there. A
    folder that isn't there has no documents.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], T.StructType([*schemas.MEDIA.fields, T.StructField("image_path", T.StringType())]))
    table = spark.read.schema(schemas.MEDIA).options(multiLine=True, mode="DROPMALFORMED", pathGlobFilter="*.json").json(folder).withColumn("file", F.input_file_name())
    last = Window.partitionBy(F.lower("label_id")).orderBy(F.desc("file"))
    held = table.where(F.trim("label_id") != "").withColumn("n", F.row_number().over(last)).where("n = 1").drop("n", "file")
    files = inventory(spark, folder).select(F.col("path").alias("image_path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("_name"))
    return held.join(files, held["image_file"] == files["_name"], "left").drop("_name")


def inventory(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and length of every file under a folder; contents aren't read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(folder)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length")


def dealt_inventory(spark: SparkSession, folders: DataFrame, pattern: str = "*") -> DataFrame:
    """path and length of every file under the folders (column folder), listed by the tasks they are dealt to.

    No list of files is made on the driver, as inventory's index is. Folders are those of any file
    system that Arrow reaches; one that isn't there has no files. Files that are hidden to Spark (names that start with _ or .) are left out.
    """

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                remote = "://" in folder
                system, path = fs.FileSystem.from_uri(folder) if remote else (fs.LocalFileSystem(), folder)
                waiting = [path]
                while waiting:
                    found = system.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True))
                    shown = [f for f in found if not f.base_name.startswith(("_", "."))]
                    waiting += [f.path for f in shown if f.type == fs.FileType.Directory]
                    files = [f for f in shown if f.type == fs.FileType.File and fnmatchcase(f.base_name, pattern)]
                    start = folder.partition("://")[0] + "://" if remote else ""
                    yield pa.RecordBatch.from_arrays([pa.array([start + f.path for f in files], pa.string()), pa.array([f.size for f in files], pa.int64())], names=["path", "length"])

    dealt = folders.select("folder").distinct().repartition(spark.sparkContext.defaultParallelism * 4, "folder")
    return dealt.mapInArrow(listing, "path string, length long")


def first_existing(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """The first of candidates (place, path) that exists."""
    found = candidates.join(files.select("path"), "path", "left_semi")
    return found.agg(F.min_by("path", "place").alias("path"))


def literal_catalog(spark: SparkSession, entries: list[tuple[str, ...]]) -> DataFrame:
    """A catalog given in code: label_id, kingdom, names, place."""
    return spark.createDataFrame([(*e[:5], i) for i, e in enumerate(entries)], T.StructType([*schemas.MANIFEST.fields, T.StructField("place", T.IntegerType())]))
