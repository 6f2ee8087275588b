"""The prefix trie of conversations, as a Cartesian tree over the LCP array of the sorted ones.

A conversation is the sequence of its turns; a turn is known by 16 bytes of the SHA-256 of its
role and text, so that texts are never shuffled. The conversations' keys (their turns' bytes, one
after the other) are dealt out by ranges and sorted within: a range is a block of the sorted
array. LCP[i] is the number of turns that conversation i shares with the one before it.

Within a block one scan with a stack finds the nearest smaller value on both sides of every LCP: what
stands on the stack above LCP[i] ends before i, what is left is the nearest smaller on the
left. Entries of equal LCP are one entry, so equal-LCP nodes are merged as they come; depths
between two entries are filled up when a conversation opens them, at depths LCP[i] + 1 to its length.
A node is then (its first place, its depth), and its members are the places up to the next smaller LCP.
Nodes within a block come out whole, with the sums over their interval.

A node across blocks comes out in pieces: one where it is opened, and one in each block up to the
first whose block minimum is under its depth. There are no more pieces than a block's ends have
depths. A window over the pieces of a depth gives each piece its node (the nearest block on the left
whose minimum is smaller has opened it); sums over pieces and over blocks make these nodes whole.

conversations are grouped by id once (16 bytes and a length a turn). What is held at once is a block,
that is BLOCK_TURNS turns or one conversation; hashes of hot nodes' ids run over packed
chunks, never over a list of all.

Edge cases: rows without conv_id are no conversation's; turns of one number are in the order of
their role's and text's hash, repeated ones stay; null roles and texts are empty ones; equal conversations
share all nodes; a conversation without turns is a member of the root; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

WIDTH = 16
BLOCK_TURNS = 100_000
#: Ids that are packed into one chunk of text before they are hashed.
CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
NODE, PIECE, ENDS = 0, 1, 2
#: Kinds of pieces: the later part of a node that an earlier block has opened, and the first part.
LATER, FIRST = 0, 1
_ARROW = {
    "what": pa.int32(), "block": pa.int64(), "depth": pa.int64(), "kind": pa.int32(), "start": pa.int64(), "conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved": pa.int64(),
    "last_chars": pa.int64(), "closed": pa.bool_(), "parent_conv_id": pa.int64(), "parent_kind": pa.int32(), "ends": pa.string(), "chunk": pa.int32(),
}
_SPARK = {pa.int32(): T.IntegerType(), pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.string(): T.StringType()}
FOUND = T.StructType([T.StructField(name, _SPARK[kind]) for name, kind in _ARROW.items()])


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and steps (turn hash and code points, in order) of each conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # The role's length in front keeps (a, bc) and (ab, c) apart.
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    step = F.struct(F.col("turn"), F.substring(F.unhex(F.sha2(F.encode(said, "UTF-8"), 256)), 1, WIDTH).alias("mark"), F.char_length(text).alias("chars"))
    grouped = turns.where("conv_id IS NOT NULL").select("conv_id", step.alias("step")).groupBy("conv_id").agg(F.array_sort(F.collect_list("step"), _by_turn).alias("steps"))
    return grouped.select("conv_id", F.transform("steps", lambda s: F.struct(s["mark"].alias("mark"), s["chars"].alias("chars"))).alias("steps"))


def _by_turn(a, b):
    """Null turns first, then by number, then by hash."""
    turn = F.when(a["turn"].eqNullSafe(b["turn"]), 0).when(a["turn"].isNull(), -1).when(b["turn"].isNull(), 1).when(a["turn"] < b["turn"], -1).otherwise(1)
    return F.when(turn != 0, turn).when(a["mark"] < b["mark"], -1).when(a["mark"] > b["mark"], 1).otherwise(0)


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first h turns replaced by those of its group's first; h = crc32(id) % most."""
    own = common.materialize(sequences(conversations))
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("steps", 1, max(1, most - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h}).join(heads, "base", "left")
    none = F.slice("steps", 1, 0)
    head = F.coalesce(F.slice("head", 1, F.col("h")), none)
    return joined.select("conv_id", F.concat(head, F.slice("steps", F.col("h") + 1, F.greatest(F.size("steps"), F.lit(1)))).alias("steps"))


def shared(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from the start."""
    most = min(len(a), len(b)) // WIDTH
    low = 0
    # Doubling, then halving: long keys are compared by slices.
    step = 1
    while low + step <= most and a[low * WIDTH : (low + step) * WIDTH] == b[low * WIDTH : (low + step) * WIDTH]:
        low, step = low + step, step * 2
    high = min(most, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


class Entry:
    """An open node, or the part of it in this block."""

    __slots__ = ("chars", "children", "conv_id", "ends", "kind", "leaves", "saved", "slots", "start")

    def __init__(self, kind: int, start: int, chars: int) -> None:
        self.kind, self.start, self.chars = kind, start, chars
        self.conv_id: int | None = None
        self.children = self.leaves = self.saved = 0
        self.ends: list[int] = []
        self.slots: list[int] = []  # rows of its children that wait for its conv_id


def scan(block: int, before: bytes | None, keys: list[bytes], chars: list[list[int]], ids: list[int]) -> list[list]:
    """The rows of FOUND of a block of sorted conversations; before is the last key of the block before."""
    rows: list[list] = []
    stack: list[Entry] = []
    first_place = block << 40

    def close(entry: Entry, depth: int, at: int, whole: bool, closed: bool) -> None:
        """Takes the deepest entry off: a row, and its sums to the node above."""
        parent = stack[-1] if stack else None
        n = at - (entry.start if entry.kind == FIRST else 0)
        row = [NODE if whole else PIECE, block, depth, entry.kind, first_place + entry.start, entry.conv_id, n, entry.children, entry.leaves, entry.saved, entry.chars, closed, None, parent.kind if parent else None, None, None]
        if whole:
            row[8] = entry.leaves or 1
            row[9] = entry.saved + (n - 1) * entry.chars
            row[14] = hashlib.sha256(",".join(map(str, entry.ends)).encode()).hexdigest() if entry.ends else NOTHING
        elif entry.ends:
            for k in range(0, len(entry.ends), CHUNK):
                rows.append([ENDS, block, depth, entry.kind, first_place + entry.start, *[None] * 9, ",".join(map(str, entry.ends[k : k + CHUNK])), k // CHUNK])
        if parent:
            parent.leaves += row[8]
            parent.saved += row[9]
            if entry.conv_id is not None and (parent.conv_id is None or entry.conv_id < parent.conv_id):
                parent.conv_id = entry.conv_id
            parent.slots.append(len(rows))
        if whole:
            for slot in entry.slots:
                rows[slot][12] = entry.conv_id
        rows.append(row)

    last = before
    for at, key in enumerate(keys):
        common_turns = -1 if last is None else shared(last, key)
        if at == 0:
            stack = [Entry(LATER, 0, 0) for _ in range(common_turns + 1)]
        while len(stack) > common_turns + 1:
            entry = stack.pop()
            close(entry, len(stack), at, entry.kind == FIRST, True)
        for depth in range(len(stack), len(chars[at]) + 1):
            if stack:
                stack[-1].children += 1
            stack.append(Entry(FIRST, at, chars[at][depth - 1] if depth else 0))
        top = stack[-1]
        top.ends.append(ids[at])
        top.conv_id = ids[at] if top.conv_id is None else min(top.conv_id, ids[at])
        last = key
    while stack:
        entry = stack.pop()
        close(entry, len(stack), len(keys), False, False)
    return rows


def _scan_blocks(blocks: DataFrame, befores: DataFrame) -> DataFrame:
    common.ship(blocks.sparkSession)
    schema = pa.schema(list(_ARROW.items()))

    def run(own: pa.Table, other: pa.Table) -> pa.Table:
        if not own.num_rows:
            return schema.empty_table()
        own = own.sort_by("place")
        before = other.column("before")[0].as_py() if other.num_rows else None
        keys = own.column("key").to_pylist()
        rows = scan(own.column("block")[0].as_py(), before, keys, own.column("chars").to_pylist(), own.column("conv_id").to_pylist())
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return blocks.groupBy("block").cogroup(befores.groupBy("block")).applyInArrow(run, FOUND)


def _digests(chunks: DataFrame) -> DataFrame:
    """start, depth, ends_sha256: chunks of a node in order, hashed as they come."""
    schema = T.StructType.fromDDL("start long, depth long, ends_sha256 string")
    common.ship(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for start, depth, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if (start, depth) != node:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (start, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=schema.names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([digest.hexdigest()])], names=schema.names)

    return chunks.repartition("start", "depth").sortWithinPartitions("start", "depth", "block", "chunk").select("start", "depth", "ends").mapInArrow(run, schema)


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a node of conversations (conv_id, steps): see op11_prefix_trie for its columns."""
    spark = conversations.sparkSession
    keyed = conversations.select("conv_id", F.array_join(F.transform("steps", lambda s: F.hex(s["mark"])), "").alias("hexed"), F.transform("steps", lambda s: s["chars"]).alias("chars"))
    keyed = common.materialize(keyed.select("conv_id", F.unhex("hexed").alias("key"), "chars"))
    turns = keyed.agg(F.coalesce(F.sum(F.size("chars") + 1), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-turns // block_turns), min(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // 1000))
    dealt = keyed.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    # The id that Spark gives a row is its partition and its place there.
    ordered = common.materialize(dealt.withColumn("_at", F.monotonically_increasing_id()).select("conv_id", "key", "chars", F.shiftright("_at", 33).alias("block"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("place")))
    lasts = ordered.groupBy("block").agg(F.max_by("key", "place").alias("last"))
    befores = lasts.select("block", F.lag("last").over(Window.orderBy("block")).alias("before")).where("before IS NOT NULL")
    found = common.materialize(_scan_blocks(ordered, befores))

    pieces = found.where(F.col("what") == PIECE)
    along = Window.partitionBy("depth").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("node", F.last(F.when(F.col("kind") == FIRST, F.col("start")), ignorenulls=True).over(along))
    placed = common.materialize(placed.drop("what", "start", "ends", "chunk"))
    nodes = placed.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.max("last_chars").alias("last_chars"),
        *[F.max(F.when(F.col("kind") == FIRST, F.col(c))).alias(c) for c in ("block", "parent_kind")],
    )
    # What nodes across blocks add themselves: to those above them that were opened in the same block, and to those whose later parts go on behind it.
    own_leaves, own_saved = F.when(F.col("n_children") == 0, 1).otherwise(0), (F.col("n_convs") - 1) * F.col("last_chars")
    nodes = nodes.withColumns({"own_leaves": own_leaves, "own_saved": own_saved})
    deeper = Window.partitionBy("block").orderBy(F.col("depth").desc())
    nodes = common.materialize(nodes.withColumns({"deeper_leaves": F.sum("own_leaves").over(deeper), "deeper_saved": F.sum("own_saved").over(deeper)}))
    sums = nodes.groupBy("block").agg(F.sum("own_leaves").alias("block_leaves"), F.sum("own_saved").alias("block_saved"))
    onward = placed.where((F.col("kind") == LATER) & ~F.col("closed")).join(sums, "block").groupBy("node", "depth").agg(F.sum("block_leaves").alias("later_leaves"), F.sum("block_saved").alias("later_saved"))
    zero = F.lit(0)
    nodes = nodes.join(onward, ["node", "depth"], "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.col("deeper_leaves") + F.coalesce("later_leaves", zero),
            "saved": F.col("saved") + F.col("deeper_saved") + F.coalesce("later_saved", zero),
        }
    )
    digests = _digests(found.where(F.col("what") == ENDS).join(placed.select("block", "depth", "kind", "node"), ["block", "depth", "kind"]).select(F.col("node").alias("start"), "depth", "block", "chunk", "ends"))
    nodes = nodes.join(digests.withColumnRenamed("start", "node"), ["node", "depth"], "left").withColumn("ends", F.coalesce("ends_sha256", F.lit(NOTHING)))

    columns = ["block", "depth", "conv_id", "parent_conv_id", "parent_kind", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    across = nodes.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns)
    everything = found.where(F.col("what") == NODE).select(columns).unionByName(across)
    # A parent across blocks is known by the piece that stood above the node in its block.
    ids = placed.join(nodes.select("node", "depth", F.col("conv_id").alias("above")), ["node", "depth"]).select(F.col("block").alias("_b"), (F.col("depth") + 1).alias("_d"), F.col("kind").alias("_k"), "above")
    waiting = F.col("parent_conv_id").isNull()
    joined = everything.join(ids, (F.col("block") == F.col("_b")) & (F.col("depth") == F.col("_d")) & (F.col("parent_kind") == F.col("_k")) & waiting, "left")
    return joined.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie(rebuilt(turns))
