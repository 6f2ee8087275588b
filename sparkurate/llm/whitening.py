"""Whitening of embeddings by principal components, from moments merged pair by pair.

Three passes over the vectors, none of which moves them. In the first, each partition makes its
count, sums, mean and centred scatter batch by batch; treeReduce merges the partitions' moments
pairwise by Chan's formula, so what meets anywhere is a matrix of the dimension's square and
nothing that grows with the rows. The driver takes the eigenvectors. The second pass makes the
same moments of the whitened vectors, whose covariance has to be the identity; the greatest
difference is reported with every row. The third pass returns the rows.

Entries are shifted to integers first (floor(SCALE * entry) + OFFSET), so that counts and sums
are exact in any order of merging; the scatter is in double precision about each part's mean.

Edge cases: a vector that is null, empty or holds a null or a non-finite entry is dropped; the
others have to be of one length, else a ValueError names the lengths; repeated rows count and
come out each for itself; a null id stays null; an empty table, or one vector alone, gives no
rows, as nothing varies. Components without variance (under RANK of the greatest, as rounding
leaves it) can't be whitened and are left out. Entries of more than 2**52 / SCALE count as that.
deviation is decimal(38,0) in the operator; where a value needs more digits it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Of the greatest eigenvalue: what is below has no variance but that of rounding.
RANK = 1e-12
#: Entries that are looked at together: 32 MB as doubles.
ENTRIES = 1 << 22
_LARGEST = float(1 << 52)
MOMENTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("width", T.IntegerType()), T.StructField("sums", T.BinaryType()), T.StructField("mean", T.BinaryType()), T.StructField("scatter", T.BinaryType())])


@dataclass
class Moments:
    """Of n vectors: exact sums, mean and scatter about the mean."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray, sums: np.ndarray | None = None) -> Moments:
        mean = x.mean(axis=0)
        centred = x - mean
        # The computed mean is off by its rounding; the correction keeps the scatter that of the true mean.
        off = centred.sum(axis=0)
        scatter = centred.T @ centred - np.outer(off, off) / len(x)
        return Moments(len(x), x.sum(axis=0) if sums is None else sums, mean + off / len(x), scatter)

    def merge(self, other: Moments) -> Moments:
        """Chan's formula for two parts."""
        if not self.n or not other.n:
            return self if self.n else other
        if len(self.mean) != len(other.mean):
            raise ValueError(f"the vectors have different lengths: {len(self.mean)} and {len(other.mean)}")
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(n, self.sums + other.sums, self.mean + apart * (other.n / n), self.scatter + other.scatter + np.outer(apart, apart) * (self.n * (other.n / n)))

    def row(self) -> tuple[int, int, bytes, bytes, bytes]:
        return self.n, len(self.mean), self.sums.tobytes(), self.mean.tobytes(), self.scatter.tobytes()

    @staticmethod
    def read(row: T.Row, kind: str) -> Moments:
        return Moments(row.n, np.frombuffer(row.sums, kind), np.frombuffer(row.mean), np.frombuffer(row.scatter).reshape(row.width, row.width))


def nothing(kind: type = np.int64) -> Moments:
    return Moments(0, np.zeros(0, kind), np.zeros(0), np.zeros((0, 0)))


@dataclass
class Whitening:
    """What the fit list has taught: counts, exact sums, and the components that vary."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """Sum over the dimensions of (n * x - sums) ** 2, exact."""
        bound = float(np.abs(x).max(initial=0)) * self.n + float(np.abs(self.sums).max(initial=0))
        if bound * bound * x.shape[1] < 2.0**62:
            return [Decimal(v) for v in (np.square(self.n * x - self.sums)).sum(axis=1).tolist()]
        apart = float(np.abs(x - self.sums / self.n).max(initial=0) + 1) * self.n
        if bound < 2.0**62 and apart * apart * x.shape[1] < 2.0**62:
            return [Decimal(v) for v in (np.square(self.n * x - self.sums)).sum(axis=1).tolist()]
        sums = self.sums.tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [Decimal(v) if v < 10**38 else None for v in exact]


def vectors_of(column: pa.Array, entries: int = ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the usable rows and their integer entries, some rows at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    start = 0
    while start < len(column):
        upto = max(start + 1, start + int(np.searchsorted(np.cumsum(lengths[start:]), entries, side="right")))
        values = column.slice(start, upto - start).flatten()
        flat = values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        here = lengths[start:upto]
        row = np.repeat(np.arange(len(here)), here)
        good = (here > 0) & (np.bincount(row[~np.isfinite(flat)], minlength=len(here)) == 0)
        places = np.flatnonzero(good)
        if len(places):
            widths = np.unique(here[places])
            if len(widths) > 1:
                raise ValueError(f"the vectors have different lengths: {', '.join(map(str, widths.tolist()))}")
            kept = flat[good[row]].reshape(len(places), int(widths[0]))
            yield places + start, np.clip(np.floor(kept * SCALE), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET
        start = upto


def _reduced(vectors: DataFrame, fitted: Whitening | None) -> Moments:
    """The moments of all integer vectors, or of the whitened ones, by a tree over the partitions."""
    common.ship(vectors.sparkSession)

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = nothing(np.int64 if fitted is None else np.float64)
        for batch in batches:
            for _, x in vectors_of(batch.column(0)):
                found = found.merge(Moments.of(x.astype(np.float64), x.sum(axis=0)) if fitted is None else Moments.of(fitted.whiten(x)))
        yield pa.RecordBatch.from_pylist([dict(zip(MOMENTS.names, found.row(), strict=True))], schema=pa.schema([("n", pa.int64()), ("width", pa.int32()), ("sums", pa.binary()), ("mean", pa.binary()), ("scatter", pa.binary())]))

    kind = "int64" if fitted is None else "float64"
    parts = vectors.mapInArrow(of_partition, MOMENTS).rdd.map(lambda row: Moments.read(row, kind))
    return parts.treeReduce(lambda a, b: a.merge(b)) if parts.getNumPartitions() else nothing()


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening that all usable vectors of the column teach; None where nothing varies."""
    found = _reduced(vectors.select(column), None)
    if found.n < 2:
        return None
    covariance = found.scatter / found.n
    values, across = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > RANK * max(values.max(), 0.0)]
    if not len(order):
        return None
    across = across[:, order]
    across = across * np.where(across[np.abs(across).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return Whitening(found.n, found.sums, values[order], across, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> float:
    """The second pass: the largest absolute entry of the whitened vectors' covariance minus the identity."""
    found = _reduced(vectors.select(column), fitted)
    return float(np.abs(found.scatter / found.n - np.eye(len(fitted.values))).max())


def transform(vectors: DataFrame, fitted: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, whitened (array of double, a component each) and deviation of every usable row."""
    schema = T.StructType([common.id_field(vectors, key), T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.DecimalType(38, 0))])

    def start():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for places, x in vectors_of(batch.column(1)):
                white = fitted.whiten(x)
                offsets = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
                columns = [batch.column(0).take(pa.array(places)), pa.ListArray.from_arrays(offsets, white.ravel()), pa.array(fitted.deviations(x), pa.decimal128(38, 0))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return step

    return common.map_rows(vectors.select(key, column), start, schema)


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """Every usable row of embeddings and every component, with the figures of the fit."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    fitted = fit(vectors)
    if fitted is None:
        return spark.createDataFrame([], T.StructType([common.id_field(vectors, "vec_id"), *T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double").fields]))
    error = identity_error(vectors, fitted)
    explained = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    rows = transform(vectors, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
