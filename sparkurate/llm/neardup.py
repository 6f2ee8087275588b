"""Near duplicates by chosen-path set similarity join.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Documents of equal
sets are one class from the start; the least id stands for it. Each class has a signature of
HASHES minwise values. In each of several independent trees a node picks one or two of the
places of the signature, by a hash of the node; a child holds the node's members that have
the same value there. Nodes of up to LIMIT members are compared exhaustively: first the
signatures (a pair at the threshold agrees in less than the threshold less SLACK of the places
with probability 8e-9 at 85 per cent and 2e-8 at 80), then the full sets. Larger nodes branch on.

A pair of similarity t stays together in a child of a node with probability t + t (1 - t) / 2 and is
parted in a tree, however deep, with (1 - t) (2 - t) / t**2: 0.24 at 85 per cent, 0.38 at 80.
There are as many trees as bring the product under MISS, if trees were independent: 8 at 85 per cent,
12 at 80. But all draw from the same places: by a review's calculation for 85 per cent a pair
at the threshold is missed with 2.7e-5 after 4 levels, 1.9e-4 after 8 and 3.9e-4 after 12.

Groups of thousands of near copies: after STAR_LEVEL levels a large node is also cut into
chunks of under LIMIT that share PIVOTS members, each compared exhaustively. Nodes that are
connected after that need nothing more. Where FEW members or less are outside a node's largest
component they are compared with all members, in pairs of chunks; other nodes branch on. What
is still large after MAX_LEVELS is compared that way too, so that no case is dropped. No task ever gets more than two
chunks, and no pairs are emitted: a node's links leave as one star for each component.

Edge cases: null and empty texts have an empty set and are linked with nothing. Rows without
an id never stand for others; a row without an id whose set nobody with an id has is kept.
Rows of one id count as one document. Ids of any type will do; the least one is least in its
type's order. Ids that aren't whole numbers are known by 64-bit hashes inside. Words are
lower-cased in A-Z alone.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

SHINGLE = 5
THRESHOLD = 85  # per cent
STAGE_THRESHOLD = 80  # the pipeline's
HASHES = 64
SLACK = 0.3
MISS = 2e-5
LIMIT = 2048
LIMIT_SHINGLES = 1 << 20
STAR_LEVEL = 4
PIVOTS = 4
FEW = 64
MAX_LEVELS = 12
#: Up to so many ids (8 bytes each) are broadcast to pick texts; beyond, a shuffled join.
BROADCAST_IDS = 1_000_000
_words = re.compile(rb"[^\x20\x09-\x0D]+").findall
_U = np.uint64
_random = np.random.default_rng(20240607)
_FACTORS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * _U(2) + _U(1)
_STEPS = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_ROOTS = _random.integers(1, 1 << 63, 64, dtype=np.uint64)
_EMPTY = np.zeros(0, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; fewer words than five are one shingle."""
    import xxhash

    words = _words(text.encode().lower())
    n = len(words)
    if not n:
        return _EMPTY
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < SHINGLE:
        return _mix((h * _STEPS[:n]).sum(keepdims=True) + _U(n))
    total = h[: n - SHINGLE + 1] * _STEPS[0]
    for k in range(1, SHINGLE):
        total = total + h[k : n - SHINGLE + 1 + k] * _STEPS[k]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES minwise values, uint32."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 8192):
        least = np.minimum(least, (_FACTORS[:, None] * shingles[None, at : at + 8192]).min(axis=1))
    return (least >> _U(32)).astype(np.uint32)


def trees_for(threshold: int) -> int:
    """How many trees part a pair at the threshold (per cent) with MISS at most; 70 is the least that will do."""
    parted = (100 - threshold) * (200 - threshold) / max(threshold, 1) ** 2
    trees = 1 if threshold >= 100 else math.ceil(math.log(MISS) / math.log(parted)) if parted < 1 else math.inf
    if trees > len(_ROOTS):
        raise ValueError(f"a similarity of {threshold} per cent needs more than {len(_ROOTS)} trees")
    return trees


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, rep (the id as a number, or its hash), text."""
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    number = F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    return docs.select("doc_id", number.alias("rep"), "text")


def features(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, n_shingles, two hashes of the whole set, signature (null for an empty set)."""
    schema = T.StructType([common.id_field(docs), T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()), T.StructField("signature", T.BinaryType())])

    def start():
        def step(batch):
            n, a, b, signatures = [], [], [], []
            for text in common.texts_of(batch):
                s = shingle_set(text)
                n.append(len(s))
                a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                b.append(int(np.bitwise_xor.reduce(_mix(s)).view(np.int64)) if len(s) else 0)
                signatures.append(signature(s).tobytes() if len(s) else None)
            return pa.RecordBatch.from_arrays([common.column_of(batch, "doc_id"), common.column_of(batch, "text_key"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(signatures, pa.binary())], names=schema.names)

        return step

    return common.map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), start, schema)


def children(nodes: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (node, member) rows: the rows' places and the child nodes that they go to, one or two each."""
    picks = _mix(nodes)
    places, made = [], []
    first = (picks % _U(HASHES)).astype(np.int64)
    second = ((picks >> _U(8)) % _U(HASHES)).astype(np.int64)
    rows = np.arange(len(nodes))
    for which, take in ((first, np.ones(len(nodes), bool)), (second, ((picks >> _U(20)) & _U(1) == 1) & (first != second))):
        own = rows[take]
        value = signatures[own, which[own]].astype(np.uint64)
        places.append(own)
        made.append(_mix(nodes[own] ^ _mix(value | (which[own].astype(np.uint64) + _U(1)) << _U(32))))
    return np.concatenate(places), np.concatenate(made)


_ROWS = T.StructType([T.StructField("node", T.LongType()), T.StructField("rep", T.LongType()), T.StructField("n", T.LongType())])


def branch(members: DataFrame, trees: int = 0) -> DataFrame:
    """members: rep, n, signature and, below the roots, node. Returns the children's node, rep, n."""
    rooted = "node" not in members.columns

    def start():
        def step(batch):
            signatures = np.frombuffer(b"".join(common.column_of(batch, "signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            rep, n = (common.column_of(batch, k).to_numpy(zero_copy_only=False) for k in ("rep", "n"))
            starts = [np.full(len(rep), r, np.uint64) for r in _ROOTS[:trees]] if rooted else [common.column_of(batch, "node").to_numpy(zero_copy_only=False).view(np.uint64)]
            for nodes in starts:
                place, child = children(nodes, signatures)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(rep[place]), pa.array(n[place])], names=_ROWS.names)

        return step

    return common.map_rows(members, start, _ROWS)


def linked(sizes: np.ndarray, size: int, shared: np.ndarray, threshold: int) -> np.ndarray:
    return 100 * shared >= threshold * (sizes + size - shared)


def components_of(ids: list[int], sets: list[np.ndarray], threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Exhaustive comparison: (least id of its component, id) of every member linked with another.

    From each member reached, only members not reached yet are compared: their links suffice
    for the components.
    """
    m = len(ids)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(int(element.max()) + 1, bool)
    free = np.ones(m, bool)
    links = []
    owners, elements, held = owner, element, m
    for seed in range(m):
        if not free[seed]:
            continue
        free[seed] = False
        group, todo = [seed], [seed]
        while todo:
            left = int(free.sum())
            if not left:
                break
            if left < held // 2:
                keep = free[owners]
                owners, elements, held = owners[keep], elements[keep], left
            i = todo.pop()
            own = element[starts[i] : starts[i + 1]]
            mark[own] = True
            shared = np.bincount(owners[mark[elements]], minlength=m)
            mark[own] = False
            new = np.flatnonzero(free & linked(sizes, int(sizes[i]), shared, threshold))
            free[new] = False
            group.extend(new.tolist())
            todo.extend(new.tolist())
        least = min(ids[i] for i in group)
        links.extend((least, ids[i]) for i in group if ids[i] != least)
    return links


def _alike(table: pa.Table, threshold: int) -> pa.Table:
    """The members of a node whose signature is near another's."""
    least = (threshold / 100 - SLACK) * HASHES
    signatures = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, HASHES)
    keep = np.zeros(len(signatures), bool)
    for i in range(len(signatures) - 1):
        near = (signatures[i + 1 :] == signatures[i]).sum(axis=1) >= least
        if near.any():
            keep[i] = True
            keep[i + 1 :] |= near
    return table.select(["node", "rep"]).filter(pa.array(keep))


def _links(table: pa.Table, threshold: int) -> pa.Table:
    found = components_of(table["rep"].to_pylist(), [np.frombuffer(b, np.uint64) for b in table["shingles"].to_pylist()], threshold)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def compare(nodes: DataFrame, signatures: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Links a, b (stars around the least rep) found in small nodes (node, rep), confirmed on full sets; docs is identified()."""
    began = common.mark()
    near = common.materialize(nodes.join(signatures.select("rep", "signature"), "rep").select("node", "rep", "signature").groupBy("node").applyInArrow(lambda t: _alike(t, threshold), "node long, rep long"))
    wanted = common.materialize(near.select("rep").distinct())
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def start():
        def step(batch):
            sets = [shingle_set(t).tobytes() for t in common.texts_of(batch)]
            return pa.RecordBatch.from_arrays([common.column_of(batch, "rep"), pa.array(sets, pa.binary())], names=["rep", "shingles"])

        return step

    picked = docs.select("rep", "text").join(wanted, "rep", "left_semi")
    sets = common.map_rows(picked, start, T.StructType([T.StructField("rep", T.LongType()), T.StructField("shingles", T.BinaryType())]))
    sets = common.materialize(sets.where(F.length("shingles") > 0))
    links = common.materialize(near.join(sets, "rep").select("node", "rep", "shingles").groupBy("node").applyInArrow(lambda t: _links(t, threshold), "a long, b long").distinct())
    common.discard_since(began, docs.sparkSession, links)
    return links


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reachable) of every id in links; large and small stars in turn."""
    began = common.mark()
    edges = common.materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = common.materialize(small.distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    common.discard_since(began, edges.sparkSession, edges)
    out = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out._scratch = edges._scratch
    return out


def _sizes(rows: DataFrame) -> DataFrame:
    """Nodes of two members or more with a hash of their members; ``large``: they branch on."""
    stats = rows.groupBy("node").agg(F.count("*").alias("members"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y"))
    large = (F.col("members") > LIMIT) | ((F.col("total") > LIMIT_SHINGLES) & (F.col("members") > 2))
    return common.materialize(stats.where("members > 1").withColumn("large", large))


def _chunks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows of large nodes with a chunk number each; chunks have about LIMIT / 2 members."""
    parts = F.ceil(F.greatest(F.col("members") / (LIMIT // 2), F.col("total") / (LIMIT_SHINGLES // 2))).cast("int")
    return rows.join(sizes.withColumn("parts", parts).drop("large", "x", "y", "total"), "node").withColumn("chunk", F.expr("pmod(xxhash64(node, rep), parts)"))


def _star_nodes(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Small nodes: the chunks of large ones, each with the node's pivots."""
    chunked = _chunks(rows, sizes)
    order = [F.min_by("rep", F.xxhash64(F.lit(k), "node", "rep")).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = rows.groupBy("node").agg(*order).select("node", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("rep"))
    spread = pivots.join(sizes.select("node"), "node").join(chunked.select("node", "chunk").distinct(), "node")
    name = F.xxhash64("node", "chunk").alias("node")
    return chunked.select(name, "rep").union(spread.select(name, "rep")).distinct()


def _rest_nodes(rows: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """Small nodes for large ones that never got small: members outside the largest component against all."""
    # The rest is cut into chunks of its own, as few as its size needs.
    marked = _chunks(rows, sizes).join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("rest", F.coalesce("component", "rep") != F.col("body"))
    marked = common.materialize(marked.withColumn("i", F.when(F.col("rest"), F.expr("pmod(xxhash64(node, rep, 1), cast(ceil(parts * outside / members) as int))"))))
    with_rest = marked.where("rest").select("node", "i").distinct()
    every = marked.select("node", F.col("chunk").alias("j")).distinct()
    name = F.xxhash64("node", "i", "j").alias("node")
    theirs = marked.where("rest").select("node", "rep", "i").join(every, "node").select(name, "rep")
    ours = marked.select("node", "rep", F.col("chunk").alias("j")).join(with_rest, "node").select(name, "rep")
    return theirs.union(ours).distinct()


def _bodies(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """node, its largest component, and how many members are outside of it, where there are any."""
    parts = rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left").groupBy("node", F.coalesce("component", "rep").alias("component")).agg(F.count("*").alias("c"))
    found = parts.groupBy("node").agg(F.max_by("component", F.struct("c", "component")).alias("body"), (F.sum("c") - F.max("c")).alias("outside"))
    return found.where("outside > 0")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key (xxhash64 of the text) of every row; sets are linked from a similarity of threshold per cent on."""
    began = common.mark()
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    docs = identified(docs)
    known = common.materialize(features(docs))
    rep = F.min(F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")))
    classes = known.where("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b").agg(rep.alias("rep"), F.min("doc_id").alias("own"), F.first("signature").alias("signature"))
    classes = common.materialize(classes)
    signatures = classes.where("rep is not null").select("rep", F.col("n_shingles").alias("n"), "signature")

    rows = common.materialize(branch(signatures, trees_for(threshold)))
    found, links, labels = [], [], None
    for level in range(1, MAX_LEVELS + 1):
        sizes = _sizes(rows)
        found.append((rows, sizes.where("not large")))
        large = sizes.where("large")
        if large.isEmpty():
            break
        rows = common.materialize(rows.join(large.select("node"), "node"))
        if level == STAR_LEVEL:
            links.append(compare(_star_nodes(rows, large), signatures, docs, threshold))
            labels = components(links[0])
        if labels is not None:
            mixed = common.materialize(large.join(_bodies(rows, labels), "node"))
            settled = mixed if level == MAX_LEVELS else mixed.where(F.col("outside") <= FEW)
            if not settled.isEmpty():
                links.append(compare(_rest_nodes(rows, settled, labels), signatures, docs, threshold))
            if level == MAX_LEVELS:
                break
            rows = rows.join(mixed.where(F.col("outside") > FEW).select("node"), "node")
        rows = common.materialize(branch(rows.select("node", "rep", "n").join(signatures.select("rep", "signature"), "rep")))

    # Nodes of the same members, in other trees or on other levels, are compared once.
    leaves = found[0][1]
    for _, more in found[1:]:
        leaves = leaves.union(more)
    chosen = common.materialize(leaves.groupBy("members", "x", "y").agg(F.min("node").alias("node")).select("node"))
    members = found[0][0]
    for more, _ in found[1:]:
        members = members.union(more)
    links.append(compare(members.select("node", "rep").join(chosen, "node"), signatures, docs, threshold))
    every = links[0]
    for more in links[1:]:
        every = every.union(more)
    labels = components(every)
    common.discard_since(began, docs.sparkSession, known, classes, labels)
    named = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("n_shingles", "set_a", "set_b", "own", F.coalesce("component", "rep").alias("_class"))
    if not whole:  # a component's name is its least id, not its least hash
        named = named.join(named.groupBy("_class").agg(F.min("own").alias("_least")), "_class", "left").drop("_class").withColumnRenamed("_least", "_class")
    joined = known.drop("signature").join(named, ["n_shingles", "set_a", "set_b"], "left")
    own = F.col("doc_id").cast("long") if whole else F.col("doc_id")
    component = F.coalesce(F.col("_class"), own)
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(own == component, component.isNull()).alias("kept"), "text_key")


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates (80 per cent) the document of the least id stays, with all its rows.

    What goes are rows, by id and text: a text that duplicates nothing stays, also where another text of
    its id goes. A row without an id goes if another row has its set.
    """
    found = near_duplicates(docs, STAGE_THRESHOLD)
    gone = common.materialize(found.where("not kept").select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_text")).distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_text"]), "left_anti")
