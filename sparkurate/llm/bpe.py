"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings (hash and displace: one
displacement for each bucket of about four keys, as many slots as keys) finds a whole pre-token's
slot, which holds the token and its id. Tier two: misses are merged with a heap over linked bytes, always the
lowest rank first and the leftmost on ties, O(n log n) for n bytes, so very long pre-tokens
are fine. A two-generation cache, bounded in entries and their length, keeps the results of recent
pre-tokens.

The tables that each worker builds depend on the vocabulary alone (tens of thousands of
entries); only the path of its file is sent. A null text is an empty one and has no ids.
Decoding joins the tokens' bytes; an id outside the vocabulary raises an error.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkurate.llm import common

#: Entries of a generation of the cache, and the bytes of the longest pre-token in it.
CACHE = 300_000
CACHED_BYTES = 64
PRIME = (1 << 31) - 1
_loaded: dict[tuple[str, str], Codec] = {}


class PerfectHash:
    """Minimal perfect hash of distinct byte strings; find() returns the key's value, from its slot, or -1."""

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        import xxhash

        self._digest = xxhash.xxh3_64_intdigest
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        hashes = np.array([self._digest(k) for k in keys], np.uint64)
        low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.int64) | 1
        bucket = low % self.buckets
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        taken = np.zeros(n, bool)
        self.shift = [0] * self.buckets
        slot_of = np.full(n, -1, np.int64)
        tries = np.arange(256, dtype=np.int64)
        sizes = np.diff(starts)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[starts[b] : starts[b + 1]]
            if len(own) < 2:
                break
            base = 0
            while True:
                slots = (low[own][None, :] // self.buckets + (base + tries)[:, None] * high[own][None, :]) % PRIME % n
                free = ~taken[slots].any(axis=1)
                for row in np.flatnonzero(free):
                    if len(set(slots[row].tolist())) == len(own):
                        break
                else:
                    base += 256
                    if base > 1 << 24:
                        raise ValueError("two keys have one hash")
                    continue
                break
            taken[slots[row]] = True
            slot_of[own] = slots[row]
            self.shift[b] = base + int(row)
        rest = iter(np.flatnonzero(~taken))
        for b in np.flatnonzero(sizes == 1):  # a bucket of one key names its slot
            own, slot = order[starts[b]], int(next(rest))
            slot_of[own] = slot
            self.shift[b] = -1 - slot
        self.keys: list[bytes] = [b""] * n
        self.values: list[int] = [0] * n
        for key, value, slot in zip(keys, values, slot_of.tolist(), strict=True):
            self.keys[slot], self.values[slot] = key, value

    def find(self, key: bytes) -> int:
        if not self.n:
            return -1
        h = self._digest(key)
        low = h & 0xFFFFFFFF
        shift = self.shift[low % self.buckets]
        slot = -1 - shift if shift < 0 else (low // self.buckets + shift * (h >> 32 | 1)) % PRIME % self.n
        return self.values[slot] if self.keys[slot] == key else -1


class Codec(dict):
    """The vocabulary; as a dict, the recent pre-tokens with their ids packed as int32."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.known = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.split = regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode()
            rank = self.known.find(raw)
            packed = np.array([rank] if rank >= 0 else self.merge(raw), "<i4").tobytes()
            if len(raw) > CACHED_BYTES:
                return packed
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed

    def merge(self, raw: bytes) -> list[int]:
        """Ids of a piece that is no token itself."""
        ranks, n = self.ranks, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        joined: list[int | None] = [ranks.get(raw[i : i + 2]) for i in range(n)]
        joined[-1] = None
        heap = [r * n + i for i, r in enumerate(joined) if r is not None]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if joined[i] != rank:
                continue
            middle = end[i]
            stop = end[i] = end[middle]
            joined[middle] = joined[i] = None
            if stop < n:
                before[stop] = i
                r = ranks.get(raw[i : end[stop]])
                if r is not None:
                    joined[i] = r
                    heappush(heap, r * n + i)
            p = before[i]
            if p >= 0:
                r = joined[p] = ranks.get(raw[p:stop])
                if r is not None:
                    heappush(heap, r * n + p)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[raw[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.split(text))), "<i4")

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, token_ids array<int> of every whole text."""
    schema = T.StructType([common.id_field(docs), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def start():
        own = codec(path, pattern)

        def step(batch):
            made = [own.encode(t) for t in common.texts_of(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made), pa.int32()))
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), ids], names=["doc_id", "token_ids"])

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, content binary: the bytes that token_ids (null: none) stand for."""
    schema = T.StructType([common.id_field(encoded), T.StructField("content", T.BinaryType())])

    def start():
        own = codec(path, pattern)

        def step(batch):
            made = [own.decode(ids or []) for ids in common.column_of(batch, "token_ids").to_pylist()]
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), pa.array(made, pa.binary())], names=["doc_id", "content"])

        return step

    return common.map_rows(encoded.select("doc_id", "token_ids"), start, schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes every whole text, decodes the ids, and returns digests of both."""
    schema = T.StructType([common.id_field(docs), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def start():
        own = codec(path, pattern)
        sha = hashlib.sha256
        decimal = {i: str(i) for i in own.tokens}

        def step(batch):
            n, ids_sha, decoded_sha = [], [], []
            for text in common.texts_of(batch):
                ids = own.encode(text).tolist()
                n.append(len(ids))
                ids_sha.append(sha(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(sha(own.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return common.map_rows(docs.select("doc_id", "text"), start, schema)


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return stage(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the digests of every document that came in."""
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
