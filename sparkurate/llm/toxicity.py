"""Toxicity: maximum-scoring segments over token log-odds with Dirichlet priors.

Tokens are lower-cased runs of letters and digits. From a bounded, documented sample of
labelled documents (MAX_TRAIN_DOCS a class in expectation, chosen by a hash of the id) each
token, and each token's starts of STEMS letters, gets the log of its odds among toxic against
clean tokens (each counted once a document), with an informative Dirichlet prior: LEAST_PRIOR
and PRIOR times its background frequency. Log-odds of less than Z standard errors count as
none. A token without evidence that no clean document has takes the log-odds of its
longest stem with evidence; a stem's come from the tokens that have none of their own, or from
SPREAD or more that agree. Every occurrence of a token counts in the scan.

A text's scores are log-odds less DRIFT. One left-to-right pass finds all maximal scoring
segments. A candidate knows the last one before it that starts lower, so what a search has passed
over is never looked at again: time is linear in the tokens. Since every token without evidence
has the same score, only tokens with evidence are visited.

Under the null the best segment of m tokens is below S with probability exp(-K m exp(-lambda S)).
K and lambda are the most likely ones for the clean documents of the sample, where a document
without any segment counts as censored. A segment's normalised score is lambda S - log(K m);
it is significant if it is expected less than SIGNIFICANT times in a text, and all significant ones
are returned. A text's statistic is their sum, or else the best one's score; a logistic curve fitted
on the sample turns it into the score.

Edge cases: null and empty texts have no segments; with no toxic or no clean training row
every score is 0. Labels other than 0 and 1 are ignored; of several labels for a document
the largest holds, and of several texts of one id the least one is learned from.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

MAX_TRAIN_DOCS = 20_000
#: Lengths of a token's starts that are features too, longest first; the first one with evidence speaks.
STEMS = (7, 6, 5, 4)
#: From so many tokens with evidence of one sign on, these speak for their stem too.
SPREAD = 3
PRIOR = 1000.0
LEAST_PRIOR = 0.5
Z = 3.2
MOST = 30.0
DRIFT = 0.05
#: How often a segment may be expected in a clean text to be called significant.
SIGNIFICANT = 0.05
THRESHOLD = 0.7
FLUSH = 1 << 18
#: Tokens whose log-odds a task remembers, and their greatest length.
RECENT = 1 << 16
RECENT_LENGTH = 32
_SAMPLE = 1 << 20
_token = re.compile(r"[^\W_]+").findall


def maximal_segments(found: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment (first token, end, score) of tokens with evidence, others at -DRIFT."""
    # A candidate: first, end, total before it, total after it, the last candidate that starts lower.
    kept: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for i, s in found:
        total -= DRIFT * (i - at)
        at, left = i + 1, total
        total += s - DRIFT
        if s <= DRIFT:
            continue
        first, right, k = i, total, len(kept) - 1
        while True:
            while k >= 0 and kept[k][2] >= left:
                k = kept[k][4]
            if k < 0 or kept[k][3] >= right:
                break
            first, _, left, _, lower = kept[k]
            del kept[k:]
            k = lower
        kept.append((first, at, left, right, k))
    return [(a, b, right - left) for a, b, left, right, _ in kept]


@dataclass
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 0.0
    offset: float = -50.0
    decay: float = 1.0
    rate: float = 1.0

    def odds(self, token: str) -> float:
        """Log-odds of a token; 0 without evidence."""
        s = self.words.get(token)
        if s is None:
            for n in STEMS:
                s = self.stems.get(token[:n])
                if s is not None:
                    break
        return s or 0.0

    def evidence(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """Places and log-odds of the tokens that have any; the number of tokens."""
        tokens = _token(text.lower())
        known = self.__dict__.setdefault("_recent", {})
        found = []
        for i, t in enumerate(tokens):
            s = known.get(t)
            if s is None:
                s = self.odds(t)
                if len(t) <= RECENT_LENGTH:
                    if len(known) >= RECENT:
                        known.clear()
                    known[t] = s
            if s:
                found.append((i, s))
        return found, len(tokens)

    def segments(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Every maximal scoring segment and the number of tokens."""
        found, n = self.evidence(text)
        return maximal_segments(found), n

    def judged(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, list[tuple[int, int, float]]]:
        """The statistic of a text of n tokens with these segments, and the significant ones of them."""
        if not segments:
            return 0.0, []
        chance = math.log(self.rate * (n + 1))
        least = chance - math.log(SIGNIFICANT)
        sure = [x for x in segments if self.decay * x[2] > least]
        best = max(self.decay * x[2] for x in sure or segments) - chance
        return min(MOST, max(best, sum(self.decay * x[2] - chance for x in sure))), sure

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score from 0 to 1 and the significant segments."""
        statistic, sure = self.judged(*self.segments(text))
        x = self.slope * statistic + self.offset
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, x)))) if self.words or self.stems else 0.0, sure


def fit_extremes(best: np.ndarray, tokens: np.ndarray, texts: np.ndarray) -> tuple[float, float]:
    """lambda and K of the best segments' scores, each of so many texts and tokens in all; 0 is none.

    P(best <= x) = exp(-K tokens exp(-lambda x)). Texts without a segment are censored at the least
    score that any has. K has a closed form for each lambda; lambda is bisected.
    """
    some = best > 0
    n, censored = texts[some].sum(), tokens[~some].sum()
    if not n:
        return 1.0, 1.0 / max(1.0, censored)
    least = best[some].min()
    s, m, w = best[some] - least, tokens[some], texts[some]

    def rate(decay: float) -> float:
        return n / (censored + (m * np.exp(-decay * s)).sum())

    low, high = 1e-3, 50.0
    for _ in range(60):
        decay = math.sqrt(low * high)
        if n / decay - (w * s).sum() + rate(decay) * (m * s * np.exp(-decay * s)).sum() > 0:
            low = decay
        else:
            high = decay
    return high, rate(high) * math.exp(high * least)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a small ridge."""
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2), design.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic, of the rows to learn from alone."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, {})
    began = common.mark()
    bound = F.when(F.col("toxic") == 1, int(_SAMPLE * min(1.0, max_train_docs / sizes[1]))).otherwise(int(_SAMPLE * min(1.0, max_train_docs / sizes[0])))
    chosen = marked.where(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(_SAMPLE)) < bound)
    # 2 x max_train_docs ids in expectation; looked at before they are broadcast.
    chosen = common.broadcast_up_to(common.materialize(chosen), 4 * max_train_docs)
    found = docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id")
    sample = common.materialize(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))
    common.ship(docs.sparkSession)

    def rows(seen: dict[str, int]) -> pa.RecordBatch:
        n = np.fromiter(seen.values(), np.int64, len(seen))
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(n & 0xFFFFFFFF), pa.array(n >> 32)], names=["feature", "clean", "toxic"])

    def count(batches):
        seen: dict[str, int] = {}  # clean documents in the low 32 bits, toxic ones above
        for batch in batches:
            for text, toxic in zip(common.texts_of(batch), common.column_of(batch, "toxic").to_pylist(), strict=True):
                tokens = set(_token(text.lower()))  # a repeated line shall not make its words
                one = 1 << 32 if toxic else 1
                for key in {"w" + t for t in tokens} | {"s" + t[:n] for t in tokens for n in STEMS if len(t) >= n}:
                    seen[key] = seen.get(key, 0) + one
                if len(seen) > FLUSH:
                    yield rows(seen)
                    seen = {}
        yield rows(seen)

    features = common.materialize(sample.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n0, n1 = features.where("feature like 'w%'").agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n0 or not n1:
        return Model({}, {})

    def evidence(clean, toxic, log=F.log, root=F.sqrt):
        prior = LEAST_PRIOR + PRIOR / float(n0 + n1) * (clean + toxic)
        odds = log((toxic + prior) / (n1 + PRIOR - toxic - prior)) - log((clean + prior) / (n0 + PRIOR - clean - prior))
        return odds, root(1 / (toxic + prior) + 1 / (clean + prior))

    odds, error = evidence(F.col("clean"), F.col("toxic"))
    strong = features.where(F.abs(odds) >= Z * error).withColumn("odds", odds).toArrow().to_pylist()
    words = {r["feature"][1:]: r for r in strong if r["feature"][0] == "w"}
    under: dict[str, list[dict]] = {}
    for w, r in words.items():
        for n in STEMS:
            if len(w) >= n:
                under.setdefault(w[:n], []).append(r)
    stems: dict[str, float] = {}
    for stem in (r for r in strong if r["feature"][0] == "s"):
        known = under.get(stem["feature"][1:], [])
        spread = len(known) >= SPREAD and all((r["odds"] > 0) == (stem["odds"] > 0) for r in known)
        rest = [max(0, stem[k] - (not spread) * sum(r[k] for r in known)) for k in ("clean", "toxic")]
        odds, error = evidence(*rest, math.log, math.sqrt)
        if abs(odds) >= Z * error:
            stems[stem["feature"][1:]] = odds
    words = {w: r["odds"] for w, r in words.items()}
    if stems:  # what clean documents have of a stem's tokens stays out of it
        starts = docs.sparkSession.createDataFrame([(x,) for x in stems], "start string")
        tokens = features.where((F.col("feature").startswith("w")) & (F.col("clean") > 0)).select(F.substring("feature", 2, 1 << 30).alias("token"))
        under_one = tokens.withColumn("start", F.explode(F.array(*[F.substring("token", 1, n) for n in STEMS]))).join(F.broadcast(starts), "start", "left_semi")
        words = dict.fromkeys(under_one.select("token").toArrow()["token"].to_pylist(), 0.0) | words
    model = Model(words, stems)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        own = replace(shared.value)  # what it remembers goes with the task
        for batch in batches:
            best, tokens = [], []
            for text in common.texts_of(batch):
                segments, n = own.segments(text)
                best.append(max((x[2] for x in segments), default=0.0))
                tokens.append(n + 1)
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.float64()), pa.array(tokens, pa.int64()), common.column_of(batch, "toxic")], names=["best", "tokens", "toxic"])

    # Equal scores are counted together: most clean texts have none.
    clean = sample.where("toxic = 0").mapInArrow(measure, "best double, tokens long, toxic int").groupBy(F.round("best", 1).alias("best")).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).toArrow()
    model.decay, model.rate = fit_extremes(*[np.array(clean[k].to_pylist(), float) for k in ("best", "tokens", "n")])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def statistics(batches):
        own = replace(shared.value)  # what it remembers goes with the task
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([own.judged(*own.segments(t))[0] for t in common.texts_of(batch)], pa.float64()), common.column_of(batch, "toxic")], names=["x", "toxic"])

    points = sample.mapInArrow(statistics, "x double, toxic int").groupBy(F.round("x", 1).alias("x")).agg(F.sum("toxic").alias("ones"), F.count("*").alias("n")).toArrow().to_pydict()
    x = np.repeat(np.array(points["x"] * 2), np.array(points["ones"] + [n - o for n, o in zip(points["n"], points["ones"], strict=True)]))
    y = np.repeat([1.0, 0.0], [sum(points["ones"]), sum(points["n"]) - sum(points["ones"])])
    model.slope, model.offset = fit_logistic(x, y)
    common.discard_since(began, docs.sparkSession)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, segments array<struct<first, end, score>> (in tokens): the significant ones of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    segment = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([common.id_field(docs), T.StructField("score", T.DoubleType()), T.StructField("segments", T.ArrayType(segment))])
    arrow = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def start():
        own = replace(shared.value)  # what it remembers goes with the task

        def step(batch):
            made = [own.score(t) for t in common.texts_of(batch)]
            spans = [[{"first": a, "end": b, "score": s} for a, b, s in found] for _, found in made]
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), pa.array([s for s, _ in made], pa.float64()), pa.array(spans, arrow)], names=["doc_id", "score", "segments"])

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def _trained(spark, docs: DataFrame, sf_dir: str) -> Model:
    training = common.fold("doc_id", 3) != 1
    return train(docs.where(training), spark.read.parquet(f"{sf_dir}/labels.parquet").where(training))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = common.fold("doc_id", 3) == 1
    scored = score(docs, _trained(spark, docs, sf_dir))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("segments").alias("n_segments"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of a score of THRESHOLD or more go."""
    shared = spark.sparkContext.broadcast(_trained(spark, docs, sf_dir))

    def start():
        own = replace(shared.value)  # what it remembers goes with the task
        return lambda batch: batch.filter(pa.array([own.score(t)[0] < THRESHOLD for t in common.texts_of(batch)]))

    return common.map_rows(docs, start, docs.schema)
