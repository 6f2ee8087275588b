"""Token counts of a sentencepiece model: Arrow batches in, lengths only out.

Texts longer than SPLIT characters are cut at safe boundaries: one ASCII space between two
ASCII letters or digits. No piece of the model has its space mark inside, so no merge crosses
such a space, and the mark that the space would give is the one put before the next part; both
are looked up in the model, and texts of a model where they don't hold are encoded whole.
Parts are encoded in batches of about BATCH_BYTES bytes, so that a batch's memory doesn't
depend on the number or length of its texts. A text without a boundary is encoded whole.

Null and empty texts have 0 bytes and 0 tokens. Ids may be null or repeat; rows stay.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkurate.llm import common

SPLIT = 8192
BATCH_BYTES = 1 << 18
LIMIT = 4096
_SAFE = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
_loaded: dict[str, object] = {}


def processor(path: str):
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = "▁"
        splits = not any(mark in model.id_to_piece(i).lstrip(mark) for i in range(model.get_piece_size()))
        # The model has to put the mark before a text, as it does for a space between words.
        probes = [("a", "b"), ("0", "Z"), ("the end", "x9"), ("Z", "a b")]
        splits = splits and all(model.encode(f"{x} {y}") == model.encode(x) + model.encode(y) for x, y in probes)
        _loaded[path] = (model, splits)
    return _loaded[path]


def safe_parts(text: str, split: int = SPLIT) -> list[str]:
    """Parts of about split characters whose token counts add up to the text's."""
    parts, at = [], 0
    while len(text) - at > split:
        found = _SAFE.search(text, at + split)
        if not found:
            break
        parts.append(text[at : found.start()])
        at = found.end()
    parts.append(text[at:])
    return parts


def count_texts(texts: list[str], path: str) -> list[int]:
    model, splits = processor(path)
    counts = [0] * len(texts)
    waiting: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for owner, ids in zip(owners, model.encode(waiting, num_threads=1), strict=True):
            counts[owner] += len(ids)
        waiting.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        for part in safe_parts(text) if splits else [text]:
            if part:
                waiting.append(part)
                owners.append(i)
                held += len(part) if part.isascii() else len(part.encode())
                if held >= BATCH_BYTES:
                    flush()
    if waiting:
        flush()
    return counts


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text."""
    schema = T.StructType([common.id_field(docs), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def start():
        def step(batch):
            column = pc.fill_null(common.column_of(batch, "text"), "")
            n = count_texts(column.to_pylist(), path)
            return pa.RecordBatch.from_arrays(
                [common.column_of(batch, "doc_id"), pc.binary_length(column).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
