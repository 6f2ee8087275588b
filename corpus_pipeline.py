"""The corpus pipeline: toxicity, language, near duplicates, mixing, tokens.

Each stage takes the session, the documents that the stage before it kept and the folder of
tables, and returns a DataFrame; run() writes each stage's result as Parquet to the session's
shared checkpoint folder and reads it again as the next one's documents. Toxic documents go,
then those without a language, then all but one of each group of near duplicates; mixing draws
what is left by target weights, every document at least once; the last stage encodes each drawn
document to byte-level BPE ids, decodes them, and returns digests of both.

Texts go to Python in batches of at most BATCH bytes while the stages run, unless the session's are
smaller: many stages share the executors, and what one stage's batches took isn't all given back.

SQL can't express the trained and iterative stages; tests/llm holds them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkurate.llm import bpe, common, langid, mixing, neardup, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("language_id", langid.stage),
    ("near_dedup", neardup.stage),
    ("source_mixing", mixing.stage),
    ("byte_bpe", bpe.stage),
]
ORACLE_SQL = None
#: Bytes of a batch of rows on the way to Python and back.
BATCH = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    before = spark.conf.get(_BATCH_KEY)
    spark.conf.set(_BATCH_KEY, min(BATCH, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)))
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for _, stage in STAGES[:-1]:
            began = common.mark()
            kept = common.materialize(stage(spark, docs, sf_dir))
            common.discard_since(began, spark, kept)
            if hasattr(docs, "_scratch"):
                common.discard(docs)
            docs = kept
    finally:
        spark.conf.set(_BATCH_KEY, before)
    return STAGES[-1][1](spark, docs, sf_dir)
