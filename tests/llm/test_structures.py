"""Prefix trie, whitening and fingerprints against brute-force versions."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkurate.llm import prefixtrie, queries, syncmers, whitening

from ..conftest import DATA

# --- op11 ------------------------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def spec_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [s[2:] for s in sorted(steps, key=lambda s: s[:2])] for c, steps in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: tuple(own.get(c - c % 100, [])[: heads[c]] + steps[heads[c] :]) for c, steps in own.items()}


def spec_trie(sequences):
    members = defaultdict(list)
    for conv, steps in sequences.items():
        for d in range(len(steps) + 1):
            members[steps[:d]].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(p))))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def chats(seed, n=400):
    """Many equal starts, whole copies, a hot conversation, long ones, empty ones."""
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(3 * n), n):
        kind = rng.random()
        size = 3 if kind < 0.3 else rng.randrange(1, 8) if kind < 0.95 else rng.randrange(30, 60)
        for turn in range(size):
            text = "hot" if kind < 0.3 else None if rng.random() < 0.1 else "".join(rng.choice("aé\U0001f600") for _ in range(rng.randrange(0, 3)))
            rows.append((conv, None if turn == 0 and rng.random() < 0.2 else turn, rng.choice(["user", None, ""]) if kind > 0.3 else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "block_turns"), [(1, 100_000), (2, 60), (3, 15)])
def test_trie_matches_brute_force(spark, seed, block_turns):
    rows = chats(seed)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefixtrie.trie(prefixtrie.rebuilt(turns), block_turns).select(NODE).collect()
    assert Counter(map(tuple, got)) == spec_trie(spec_rebuilt(rows))


def test_trie_query_on_the_tables(spark):
    turns = spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.queries()["op11_prefix_trie"](spark, f"{DATA}/sf0.01").select(NODE).collect()
    assert Counter(map(tuple, got)) == spec_trie(spec_rebuilt(map(tuple, turns)))


def test_trie_edges(spark):
    ddl = "conv_id long, turn long, role string, text string"
    assert prefixtrie.trie(prefixtrie.rebuilt(spark.createDataFrame([], ddl))).collect() == []
    rows = [(None, 1, "a", "nobody's"), (7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (100, 0, "us", "erx")]
    got = prefixtrie.trie(prefixtrie.sequences(spark.createDataFrame(rows, ddl))).select(NODE).collect()
    assert Counter(map(tuple, got)) == spec_trie({7: (("", ""), ("user", "x"), ("user", "x")), 100: (("us", "erx"),)})


def test_shared_turns():
    rng = random.Random(4)
    for _ in range(500):
        a, b = ([rng.choice("ab") for _ in range(rng.randrange(0, 40))] for _ in range(2))
        b = a[: rng.randrange(0, 40)] + b[: rng.randrange(0, 3)]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefixtrie.shared(*("".join(x * prefixtrie.WIDTH for x in s).encode() for s in (a, b))) == want


# --- op12 ------------------------------------------------------------------------------------


def spec_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    values, across = np.linalg.eigh(np.cov(x.T, bias=True))
    order = np.argsort(-values)[:8]
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    deviations = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return (x - x.mean(axis=0)) @ across[:, order] / np.sqrt(values[order]), values[order] / values.sum(), deviations


def test_whitening_matches_one_decomposition(spark):
    table = spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet")
    want, explained, deviations = spec_whitening([r.embedding for r in table.orderBy("vec_id").collect()])
    got = queries.queries()["op12_embedding_whitening"](spark, f"{DATA}/sf0.01").orderBy("vec_id", "component").collect()
    assert [r.component for r in got[:8]] == list(range(1, 9)) and len(got) == want.size
    white = np.array([r.whitened for r in got]).reshape(want.shape)
    assert np.abs(white - want * np.sign((white * want).sum(axis=0))).max() < 1e-9
    assert np.allclose([r.explained for r in got[:8]], explained, rtol=1e-9)
    assert [r.deviation for r in got[::8]] == deviations and {r.n for r in got} == {len(want)} and max(r.identity_error for r in got) < 1e-9


def test_moments_merge_in_any_order():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 6)) * 3 + 1e8
    parts = [whitening.Moments.of(p) for p in np.split(x, [1, 2, 90, 400])]
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        merged = whitening.nothing()
        for k in order:
            merged = merged.merge(parts[k])
        assert merged.n == 500 and np.allclose(merged.scatter / 500, np.cov(x.T, bias=True), rtol=1e-7, atol=1e-7)


def test_whitening_edges(spark):
    ddl = "vec_id long, embedding array<float>"
    bad = [(1, None), (2, [1.0, None]), (3, [float("inf"), 0.0]), (4, [])]
    assert whitening.fit(spark.createDataFrame(bad, ddl)) is None
    assert whitening.fit(spark.createDataFrame([*bad, (5, [1.0, 2.0])], ddl)) is None
    assert whitening.fit(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], ddl)) is None
    flat = spark.createDataFrame([*bad, (5, [1.0, 2.0]), (None, [3.0, 2.0]), (5, [1.0, 2.0])], ddl)
    fitted = whitening.fit(flat)
    assert fitted.n == 3 and len(fitted.values) == 1 and whitening.identity_error(flat, fitted) < 1e-12
    rows = whitening.transform(flat, fitted).collect()
    assert Counter(r.vec_id for r in rows) == {5: 2, None: 1} and {int(r.deviation) for r in rows} == {2048**2, 4096**2}
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], ddl))


def test_deviations_beyond_64_bits():
    fitted = whitening.Whitening(10**9, np.array([10**14 * 3]), np.ones(1), np.ones((1, 1)), 1.0)
    x = np.array([[300_001], [5 * 10**8]])
    assert [int(v) for v in fitted.deviations(x)] == [(10**9 * int(v) - 3 * 10**14) ** 2 for v in x[:, 0]]


# --- op13 ------------------------------------------------------------------------------------


def long_of(value):
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


def hash_of(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=seed % (1 << 64)).intdigest()
    return long_of(seed)


def spec_anchors(text, k=syncmers.K, s=syncmers.S):
    units = [hash_of(u) for u in re.findall(r"[0-෿]{1,32}|[^ \t\n\x0b\f\r]", text)]
    mers = []
    for i in range(len(units) - s + 1):
        h = units[i]
        for j in range(1, s):
            h = long_of(h << 1) ^ units[i + j]
        mers.append(h)
    inner, found = k - s + 1, []
    for i in range(len(units) - k + 1):
        window = mers[i : i + inner]
        if min(window) in (window[0], window[-1]):
            found.append((i, hash_of(*[mers[i + j] for j in sorted({*range(0, inner - 1, s), inner - 1})]) % (1 << 32)))
    return found or [(0, hash_of(text) % (1 << 32))]


def spec_likeness(a, b):
    a, b = ({(h, i // syncmers.DRIFT) for i, h in x} for x in (a, b))
    return len(a & b) / max(len(a), len(b))


def spec_fingerprints(rows):
    """(id, text) in order: edited text, both fingerprints, both likenesses."""
    out = []
    for j, (i, text) in enumerate(rows):
        following = rows[(j + 1) % len(rows)][1]
        moved = len(text) // 3
        edited = text[: len(text) - moved] + following[:moved]
        own, other = spec_anchors(text), spec_anchors(edited)
        said = [" ".join(f"{(p + 1 << 32) + h:X}" for p, h in x) for x in (own, other)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *said, spec_likeness(own, other), spec_likeness(own, spec_anchors(following))))
    return sorted(out, key=str)


def test_fingerprints_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = queries.queries()["op13_document_fingerprints"](spark, f"{DATA}/sf0.01").collect()
    assert sorted(map(tuple, got), key=str) == spec_fingerprints(rows)


def test_buckets_of_any_size(spark, monkeypatch):
    """Few rows a bucket, bounds of two levels, half of the rows of one id."""
    monkeypatch.setattr(syncmers, "LEVEL", 4)
    rng = random.Random(6)
    rows = [(7 if i % 2 else rng.randrange(-50, 50), f"text {rng.randrange(60)} of {i % 7}") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "no id"), (None, None)], "doc_id long, text string")
    got, _ = syncmers.with_next(docs, bucket_rows=8)
    got = got.where("NOT _sync_ghost").select("_sync_id", "_sync_text", "_sync_next").collect()
    ordered = sorted([*rows, (None, "no id"), (None, "")], key=lambda r: (r[0] is not None, r[0] or 0, hash_of(r[1])), reverse=True)
    want = [(i, t, ordered[(j + 1) % len(ordered)][1]) for j, (i, t) in enumerate(ordered)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_fingerprints_of_odd_texts(spark):
    rng = random.Random(7)
    texts = ["", "x" * 5000, "one", "中文没有空格的文本" * 9, "a b " * 40, " ".join(str(rng.randrange(99)) for _ in range(4000)), "\U0001f600 ." * 12, "no" + "y" * 40 + "space" * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("*", F.lit("clash").alias("found"))
    got = {r.doc_id: [(a >> 32, a & 0xFFFFFFFF) for a in r.a] for r in docs.select("doc_id", syncmers.anchors(F.col("text"), piece=64).alias("a")).collect()}
    for i in (0, 2, 3, 4, 5, 6):
        assert got[i] == spec_anchors(texts[i]), i
    assert len(got[1]) > 5 and len(got[7]) > 100
    assert spark.createDataFrame([], "doc_id long, text string").transform(syncmers.fingerprints).collect() == []


def test_anchors_are_context_free(spark):
    """What an insertion leaves alone keeps its anchors."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(500)]
    texts = [" ".join(words), " ".join([*words[:100], "three", "new", "words", *words[100:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    a, b = ({x & 0xFFFFFFFF for x in r.a} for r in docs.orderBy("doc_id").select(syncmers.anchors(F.col("text")).alias("a")).collect())
    assert len(a & b) >= 0.95 * len(a)
