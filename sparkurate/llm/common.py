"""Helpers shared by the training-data operators.

Conventions of every operator in this subpackage:

* a null text counts as an empty one unless the operator says otherwise;
* extra input columns are ignored: each operator selects what it needs by name;
* repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a maximal run of anything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
_ROOT = Path(__file__).resolve().parents[2]
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z only; other code points stay."""
    return text.translate(_ASCII_LOWER) if not text.isascii() else text.lower()


def fold(column: str = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id as text, modulo parts; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % F.lit(parts), F.lit(0))


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python workers.

    It is, where PYTHONPATH names its folder, or where workers start in that folder on this
    machine; else the session sends it to them.
    """
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    context = spark.sparkContext
    here = context.master.startswith("local") and not context.master.startswith("local-cluster") and Path.cwd() == _ROOT
    if str(_ROOT) in paths or here or getattr(context, "_sparkurate_shipped", False):
        return
    target = Path(tempfile.mkdtemp()) / "sparkurate.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted((_ROOT / "sparkurate").rglob("*.py")):
            out.write(source, source.relative_to(_ROOT))
    context.addPyFile(str(target))
    context._sparkurate_shipped = True


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; one is set only if none is and all is on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


class _Written(threading.local):
    """The tables that this thread's query has written: another thread's aren't its to remove."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_written = _Written()


def materialize(df: DataFrame) -> DataFrame:
    """Writes df once to the shared checkpoint folder and reads it back: the lineage ends there."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def broadcast_up_to(table: DataFrame, rows: int) -> DataFrame:
    """A materialised table, marked for broadcast if it has no more than so many rows."""
    return F.broadcast(table) if table.count() <= rows else table


def mark() -> int:
    """The place from which discard_since() removes tables."""
    return len(_written.paths)


def discard_since(place: int, spark: SparkSession, *keep: DataFrame) -> None:
    """Removes the tables written since mark(), but for those that a result still reads."""
    kept = {df._scratch for df in keep}
    for path in [p for p in _written.paths[place:] if p not in kept]:
        _remove(path, spark)


def discard(*tables: DataFrame) -> None:
    """Removes materialised tables that nothing reads any more."""
    for df in tables:
        _remove(df._scratch, df.sparkSession)


def _remove(path: str, spark: SparkSession) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _written.paths:
        _written.paths.remove(path)


def map_rows(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """mapInArrow with a per-task start(): it returns what turns one batch into one or more."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                made = step(batch)
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(run, schema)


def id_field(df: DataFrame, name: str = "doc_id") -> T.StructField:
    return T.StructField(name, df.schema[name].dataType)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def batch_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
