"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of non-letters becomes one space, and the 1-, 2- and
3-grams of what remains are hashed into BUCKETS counters. Training sums the counters of a
language over a bounded, documented sample (MAX_TRAIN_DOCS documents a language in
expectation, chosen by a hash of the id, so the choice is the same in every run). The matrix
of log-probabilities is broadcast and has at most MATRIX cells (32 MB): up to 256 languages have
all BUCKETS counters; with more, neighbouring counters are one, as few as that needs. The driver
holds the languages' names and the matrix.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0; so is
everything if nothing can be learned. Null ids or languages are never trained on, null ids
are still predicted. Long texts are counted in overlapping pieces: counts add up.
Scoring takes a batch of texts as one sparse matrix, summed by rows against the broadcast one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

BUCKETS = 1 << 15
MAX_TRAIN_DOCS = 4000
#: Cells of the matrix, unless it has more languages than that.
MATRIX = 1 << 23
#: Up to so many languages' sample bounds are broadcast; beyond, a shuffled join.
BROADCAST_LANGUAGES = 100_000
SMOOTHING = 0.5
PIECE = 1 << 20
#: n-grams of a batch of texts that is scored at once.
CELLS = 1 << 18
_SAMPLE = 1 << 20
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For each code point of the lower planes, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray:
    """The bucket of each of the text's hashed n-grams; none if it has no letter."""
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[max(0, at - 2) : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letter_table()[codes]
        if not letter.any():
            continue
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of each run of non-letters stays, as a space
        line = np.empty(int(keep.sum()) + 2, np.uint64)
        line[0] = line[-1] = 32
        line[1:-1] = np.where(letter, codes, 32)[keep]
        two = line[:-1] * np.uint64(0x9E3779B1) + line[1:]
        three = two[:-1] * np.uint64(0x85EBCA77) + line[2:]
        made = np.concatenate([line[1:-1] * np.uint64(0xC2B2AE3D), two * np.uint64(0x27D4EB2F) + np.uint64(2), three * np.uint64(0x165667B1) + np.uint64(3)])
        made ^= made >> np.uint64(29)
        found.append(((made * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64))
    return np.concatenate(found)


def buckets_for(languages: int) -> int:
    """How many counters a language has, a power of two."""
    return 1 << (min(BUCKETS, max(1, MATRIX // max(1, languages))).bit_length() - 1)


def sparse_counts(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of texts as sparse rows: the first text, where each text's cells start, their buckets and counts.

    A batch has some CELLS n-grams, or one text.
    """
    first, held, size = 0, [], 0

    def batch():
        keys = np.sort(np.concatenate([g + i * buckets for i, g in enumerate(held)]))
        start = np.flatnonzero(np.diff(keys, prepend=-1))
        cells = keys[start]
        return first, np.searchsorted(cells, np.arange(len(held) + 1) * buckets), cells % buckets, np.diff(np.append(start, len(keys)))

    for text in texts:
        own = grams(text) // (BUCKETS // buckets) if text else np.zeros(0, np.int64)
        if len(own) > CELLS:  # a long text's n-grams are counted by themselves
            if held:
                yield batch()
                first, held, size = first + len(held), [], 0
            counted = np.bincount(own, minlength=buckets)
            used = np.flatnonzero(counted)
            yield first, np.array([0, len(used)]), used, counted[used]
            first += 1
            continue
        held.append(own)
        size += len(own)
        if size > CELLS:
            yield batch()
            first, held, size = first + len(held), [], 0
    if held:
        yield batch()


class Model:
    """Languages and their log-probabilities; scores a text's counts."""

    def __init__(self, languages: list[str], counts: np.ndarray, docs: np.ndarray) -> None:
        self.languages = languages
        mass = counts + SMOOTHING
        self.log_p = np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32).T.copy() if languages else np.zeros((counts.shape[1], 0), np.float32)
        self.prior = np.log((docs + 1.0) / (docs.sum() + len(languages))) if languages else np.zeros(0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: sparse counts times the matrix, a batch of texts at a time."""
        found: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.languages:
            return found
        for first, starts, buckets, n in sparse_counts(texts, len(self.log_p)):
            rows = np.flatnonzero(np.diff(starts))
            if not len(rows):
                continue
            sums = np.empty((len(rows), len(self.languages)))
            for low in range(0, len(self.languages), 16):  # some languages at a time: cells x 16 numbers are held
                part = self.log_p[buckets, low : low + 16].astype(np.float64) * n[:, None]
                sums[:, low : low + 16] = np.add.reduceat(part, starts[rows], axis=0)
            scores = sums + self.prior
            best = scores.argmax(axis=1)
            sure = 1.0 / np.exp(scores - scores[np.arange(len(rows)), best][:, None]).sum(axis=1)
            for row, k, p in zip(rows.tolist(), best.tolist(), sure.tolist(), strict=True):
                found[first + row] = self.languages[k], p
        return found


def train(docs: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """docs: doc_id, text, lang of the rows to learn from."""
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null and doc_id is not null")
    sizes = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    names = [k for k, _ in sizes]
    buckets = buckets_for(len(names))
    counts = np.zeros((len(names), buckets))
    if not names:
        return Model([], counts, np.zeros(0))
    bounds = docs.sparkSession.createDataFrame([(k, i, int(_SAMPLE * min(1.0, max_train_docs / n))) for i, (k, n) in enumerate(sizes)], "lang string, place int, bound long")
    if len(names) <= BROADCAST_LANGUAGES:
        bounds = F.broadcast(bounds)
    sample = rows.join(bounds, "lang").where(F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(_SAMPLE)) < F.col("bound"))
    schema = "place int, bucket int, n long"
    common.ship(docs.sparkSession)

    def count(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, text in zip(common.column_of(batch, "place").to_pylist(), common.texts_of(batch), strict=True):
                made = grams(text) // (BUCKETS // buckets)
                if len(made):
                    counted = np.bincount(made, minlength=buckets)
                    seen[place] = counted if place not in seen else seen[place] + counted
        for place, made in seen.items():
            used = np.flatnonzero(made)
            yield pa.RecordBatch.from_pydict({"place": pa.array([place] * len(used), pa.int32()), "bucket": pa.array(used, pa.int32()), "n": pa.array(made[used], pa.int64())})

    got = sample.select("text", "place").mapInArrow(count, schema).groupBy("place", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[got["place"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    return Model(names, counts, np.array([n for _, n in sizes], float))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([common.id_field(docs), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def start():
        known = shared.value

        def step(batch):
            made = known.predict(common.column_of(batch, "text").to_pylist())
            ids = common.column_of(batch, "doc_id")
            return pa.RecordBatch.from_arrays([ids, pa.array([a for a, _ in made], pa.string()), pa.array([b for _, b in made], pa.float64())], names=["doc_id", "lang_pred", "score"])

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = common.fold("doc_id", 4) == 2
    model = train(docs.where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: learns as the query does, from what came in; rejects ``und`` and doubtful texts."""
    model = train(docs.where(common.fold("doc_id", 4) != 2))
    shared = spark.sparkContext.broadcast(model)
    schema = docs.schema

    def start():
        known = shared.value

        def step(batch):
            made = known.predict(common.column_of(batch, "text").to_pylist())
            return batch.filter(pa.array([a != "und" and b >= 0.5 for a, b in made]))

        return step

    return common.map_rows(docs, start, schema)
