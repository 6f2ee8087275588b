"""Language-model scores by a weighted backoff automaton over all n-grams of the training texts.

Tokens are words with A-Z lower-cased and one end a text. The automaton's states are the empty
context, the words and the bigrams that training has; an arc is an n-gram of order 1 to 3. In a
state h seen n times, the arc of a token seen c times after it has the probability
(c + m * below) / (n + m), and the failure arc, which leads to the state without its first word,
has the weight m / (n + m); below is the token's probability there. In the empty context it is
(c + 0.5) / (N + 0.5 * (V + 1)), with one class for all unknown tokens. In every state
probabilities sum to 1. No n-gram is left out, however rare. An order's m is what makes the
failure arcs, over all training tokens, expect as many tokens as come up there once only: those
that would be new if they were left out. It is solved from the counts' histograms by octave.

The model is never in one place. Texts go in chunks of CHUNK bytes, which are cut once and
written. A chunk asks for the counts of its own distinct n-grams: it sends each bucket of the hash
space the keys there and how often its own training texts have them. A bucket adds up what all
chunks sent and answers each with the whole corpus's counts, so it counts and looks up in one
shuffle. A chunk with its answers builds the part of the automaton that its texts can reach, and
traverses it from left to right: each step takes the next token's arc, by way of failure arcs where
the state has none, adds the weights and carries on with the state that the arc leads to. Lanes of
the chunk's texts take their steps side by side. What a task holds is a chunk or a bucket, whose
number grows with the corpus; no table is broadcast or collected. A common n-gram is a row's part
for each chunk in its bucket, so a bucket has as many rows as there are chunks.

A state of an automaton of order 3 depends on the last two tokens alone. So a part of a text starts
in the empty context two tokens early, doesn't count these, and then carries the same state as a
traversal of the whole text. Lanes are such parts, and a text longer than CHUNK goes in several
chunks, whose sums are added by row.

Keys are hashes of 62 bits and the order: of 10^9 n-grams any two agree with probability 0.1. They
travel sorted, as differences in byte planes, in some 5.5 bytes. Questions and scores both read the
chunks that were written, so neither another split of the input nor a lost executor parts them.

Edge cases: a null or empty text is one end. With no training row every token is unknown, and
the unknown class has probability 1. Rows are scored each for itself, whatever their id. A word
isn't cut: one longer than CHUNK needs some 100 bytes of memory for a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

#: Bytes of text in a chunk.
CHUNK = 4 << 20
#: Bytes of text for each bucket: some million keys.
BUCKET = 4 << 20
#: Tokens of a lane: a longer text is traversed in several, side by side.
LANE = 1024
#: Tokens of context that a state remembers.
_MEMORY = 2
_BLOCK = 1 << 20
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BYTES[65:91] = _BYTES[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_END = _mixed(np.array([10], _U))[0]
_END_KEY = _END & ~_U(3) | _U(1)
#: Places in a bucket's statistics: training tokens, distinct ones, n-grams seen once by order;
#: then, for contexts of one and two words, how often those of each octave come up and how many they are.
_TOKENS, _DISTINCT, _ONCE, _OCTAVES = 0, 1, {2: 2, 3: 3}, {2: 4, 3: 132}
_STATISTICS = 260


def _powers(n: int) -> np.ndarray:
    found = np.full(n, 0x9E3779B185EBCA87, _U)
    found[0] = 1
    return np.cumprod(found, out=found)


def _blocks(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of some _BLOCK bytes that end in a blank: no word is cut."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _BLOCK)
        if end < len(raw):
            blank = np.flatnonzero(_BLANK[raw[at:end]])
            if len(blank):
                end = at + int(blank[-1]) + 1
            else:
                end = len(raw)
                for start in range(at + _BLOCK, len(raw), _BLOCK):
                    blank = np.flatnonzero(_BLANK[raw[start : start + _BLOCK]])
                    if len(blank):
                        end = start + int(blank[0]) + 1
                        break
        yield at, end
        at = end


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, A-Z lower-cased, and where it starts."""
    raw = np.frombuffer(text, np.uint8)
    hashes, places = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    powers = _powers(64)
    for at, end in _blocks(raw):
        part = raw[at:end]
        edges = np.flatnonzero(np.diff(_BLANK[part], prepend=True, append=True))
        first, last = edges[0::2], edges[1::2]
        if not len(first):
            continue
        size = last - first
        starts = np.cumsum(size) - size
        inside = np.arange(int(starts[-1] + size[-1])) - np.repeat(starts, size)
        if size.max() > len(powers):
            powers = _powers(int(size.max()))
        hashes.append(_mixed(np.add.reduceat(_BYTES[part[inside + np.repeat(first, size)]] * powers[inside], starts)))
        places.append(first + at)
    return np.concatenate(hashes), np.concatenate(places)


class Traversal:
    """The n-grams of some texts or parts of them, in order; with their counts, the automaton's path.

    leads tells how many first tokens of a part are another's, closed whether an end follows it.
    keys are the distinct n-grams, sorted; one, two and three have the places among them of each
    token as a word, as the end of a bigram (-1 for a first token) and of a trigram.
    """

    def __init__(self, texts: list[bytes], leads: np.ndarray | None = None, closed: np.ndarray | None = None) -> None:
        leads = np.zeros(len(texts), np.int64) if leads is None else leads
        closed = np.ones(len(texts), bool) if closed is None else closed
        hashes, at = words(b"\n".join(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(sizes + 1) - sizes - 1
        upto = np.searchsorted(at, np.append(begins[1:], np.iinfo(np.int64).max))
        tokens = np.insert(hashes, upto[closed], _END)
        n_tokens = np.diff(upto, prepend=0) + closed
        starts = np.cumsum(n_tokens) - n_tokens
        n = len(tokens)
        self.parts, self.part = len(texts), np.repeat(np.arange(len(texts)), n_tokens)
        inside = np.arange(n) - starts[self.part]
        self.counted = inside >= leads[self.part]
        self.inside = inside
        bigram, trigram = np.flatnonzero(inside >= 1), np.flatnonzero(inside >= 2)
        two = np.zeros(n, _U)
        two[1:] = _mixed(tokens[:-1] * _U(0xC2B2AE3D27D4EB4F) + tokens[1:])
        three = _mixed(two[trigram - 1] * _U(0x165667B19E3779F9) + tokens[trigram])
        keys = np.concatenate([tokens, two[bigram], three])
        keys &= ~_U(3)
        keys[:n] |= _U(1)
        keys[n : n + len(bigram)] |= _U(2)
        keys[n + len(bigram) :] |= _U(3)
        del hashes, at, tokens, two, three
        order = np.argsort(keys)
        in_order = keys[order]
        new = np.append(True, in_order[1:] != in_order[:-1])[: len(in_order)]
        self.keys = in_order[new]
        del in_order, keys
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        self.one, self.two, self.three = place[:n], np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.two[bigram], self.three[trigram] = place[n : n + len(bigram)], place[n + len(bigram) :]

    def own_counts(self, train: np.ndarray) -> np.ndarray:
        """How often the parts that are marked have each key, others' tokens not counted."""
        marked = train[self.part] & self.counted
        found = np.zeros(len(self.keys), np.int64)
        for places in (self.one, self.two, self.three):
            found += np.bincount(places[marked & (places >= 0)], minlength=len(self.keys))
        return found.astype(_U)

    def scores(self, counts: np.ndarray, total: int, distinct: int, mass: dict[int, float]) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score and score of each part, from the counts of the keys."""
        model = Automaton(self, counts, total, distinct, mass)
        of = self.part[self.counted]
        known, base, path = counts[self.one] > 0, model.root[self.one], model.walk(self)
        sums = [np.bincount(of, x[self.counted], minlength=self.parts) for x in (known, base, path)]
        return np.bincount(of, minlength=self.parts), sums[0].astype(np.int64), sums[1], sums[2]


class Automaton:
    """The states and arcs that a traversal's n-grams can reach.

    State 0 is the empty context, state k + 1 the context that is key k. root has the weight
    (log10) of each word's arc out of state 0, into the state it leads to. Other arcs are sorted by
    state and word. fail and lost have the state and weight of each state's failure arc.
    """

    def __init__(self, path: Traversal, counts: np.ndarray, total: int, distinct: int, mass: dict[int, float]) -> None:
        c, order, n = counts.astype(float), path.keys & _U(3), len(counts)
        word, context, shorter = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for places, before, tail in ((path.two, path.one, path.one), (path.three, path.two, path.two)):
            ends = np.flatnonzero(places >= 0)
            word[places[ends]] = path.one[ends]
            context[places[ends]] = before[ends - 1]
            shorter[places[ends]] = tail[ends]
        p = (c + 0.5) / (total + 0.5 * (distinct + 1))
        self.root, self.into = np.log10(p), np.where(c > 0, word + 1, 0)
        self.fail, self.lost = np.zeros(n + 1, np.int64), np.zeros(n + 1)
        for k in (2, 3):
            these = np.flatnonzero(order == k)
            p[these] = (c[these] + mass[k] * p[shorter[these]]) / (c[context[these]] + mass[k])
            states = np.flatnonzero(order == k - 1)
            self.lost[states + 1] = np.log10(mass[k]) - np.log10(c[states] + mass[k])
        bigrams = np.flatnonzero(order == 2)
        self.fail[bigrams + 1] = shorter[bigrams] + 1
        arcs = np.flatnonzero((order > 1) & (c > 0))
        self.words = n
        keys = (context[arcs] + 1) * n + word[arcs]
        by = np.argsort(keys)
        self.arcs = np.append(keys[by], np.iinfo(np.int64).max)
        arcs = arcs[by]
        self.weight = np.log10(p[arcs])
        self.target = np.where(order[arcs] == 2, arcs, shorter[arcs]) + 1

    def walk(self, path: Traversal) -> np.ndarray:
        """The log10 probability of each token on the way from left to right through its part."""
        made = np.zeros(len(path.one))
        begins = np.flatnonzero(path.inside % LANE == 0)
        ends = np.append(begins[1:], len(made))
        early = np.minimum(path.inside[begins], _MEMORY)
        begins = begins - early
        longest = np.argsort(begins - ends, kind="stable")
        begins, early, size = begins[longest], early[longest], (ends - begins)[longest]
        state, falling = np.zeros(len(begins), np.int64), -size
        for step in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(falling, -step))
            at = begins[:active] + step
            word, now = path.one[at], state[:active]
            gained, after, lost = self.root[word], self.into[word], np.zeros(active)
            left = np.flatnonzero(now)
            while len(left):
                arc = now[left] * self.words + word[left]
                place = np.searchsorted(self.arcs, arc)
                hit = self.arcs[place] == arc
                taken, place = left[hit], place[hit]
                gained[taken], after[taken] = self.weight[place], self.target[place]
                left = left[~hit]
                lost[left] += self.lost[now[left]]
                now[left] = self.fail[now[left]]
                left = left[now[left] > 0]
            own = early[:active] <= step
            made[at[own]] = (gained + lost)[own]
            state[:active] = after
        return made


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as byte planes, each left out if it is zero, compressed if that is shorter, or as it is.

    Two bits a plane say which; then come the compressed planes' sizes, then the planes.
    """
    kinds, sizes, made = 0, [], []
    for k, plane in enumerate(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)):
        if plane.any():
            raw = plane.tobytes()
            small = pa.Codec("zstd", 1).compress(raw, asbytes=True)
            shorter = len(small) + 4 < len(raw)
            kinds |= (2 if shorter else 1) << 2 * k
            sizes += [len(small)] * shorter
            made.append(small if shorter else raw)
    return b"".join([kinds.to_bytes(2, "little"), np.array(sizes, "<u4").tobytes(), *made])


def unpacked(blob: bytes, n: int) -> np.ndarray:
    kinds = [int.from_bytes(blob[:2], "little") >> 2 * k & 3 for k in range(8)]
    at = 2 + 4 * kinds.count(2)
    sizes = iter(np.frombuffer(blob[2:at], "<u4").tolist())
    planes = np.zeros((8, n), np.uint8)
    for plane, kind in zip(planes, kinds, strict=True):
        if kind:
            end = at + (n if kind == 1 else next(sizes))
            plane[:] = np.frombuffer(blob[at:end] if kind == 1 else pa.Codec("zstd").decompress(blob[at:end], n, asbytes=True), np.uint8)
            at = end
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8").astype(_U, copy=False)


def text_parts(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about so many bytes, cut at blanks, and how many first words are the one before's."""
    if len(text) <= size:
        yield text, 0
        return
    raw, at, lead, words_before = np.frombuffer(text, np.uint8), 0, b"", 0
    while at < len(text):
        end = len(text)
        for start in range(at + size, len(text), _BLOCK):
            blank = np.flatnonzero(_BLANK[raw[start : start + _BLOCK]])
            if len(blank):
                end = start + int(blank[0]) + 1
                break
        part = text[at:end]
        yield lead + part, words_before
        last = (lead + part).rsplit(None, _MEMORY)[-_MEMORY:]
        lead, words_before, at = b" ".join(last) + b" ", len(last), end


def chunk_table(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """chunk, ids, row, lead, closed, train, sizes, texts: the texts and parts of texts of each chunk, compressed.

    row is the same for all parts of one row. A task numbers its chunks and rows, so the table has to be written once.
    """
    id_type = rows.schema["doc_id"].dataType
    kinds = {"ids": id_type, "row": T.LongType(), "lead": T.LongType(), "closed": T.BooleanType(), "train": T.BooleanType(), "sizes": T.LongType()}
    schema = T.StructType([T.StructField("chunk", T.LongType()), *[T.StructField(k, T.ArrayType(t)) for k, t in kinds.items()], T.StructField("texts", T.BinaryType())])

    def run(batches):
        task = TaskContext.get().partitionId()
        number, row, size, ids, held, texts = task << 32, task << 40, 0, [], [], []

        def closed_chunk():
            blob = pa.Codec("zstd", 6).compress(b"".join(texts), asbytes=True)
            whole = pa.concat_arrays(ids)
            columns = [whole, *(pa.array(x) for x in zip(*held, strict=True)), pa.array([len(t) for t in texts], pa.int64())]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), c) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array([number]), *lists, pa.array([blob], pa.binary())], names=schema.names)

        for batch in batches:
            names, marks = common.column_of(batch, "doc_id"), common.column_of(batch, "train").to_pylist()
            for i, text in enumerate(common.column_of(batch, "text")):
                row += 1
                parts = list(text_parts(text.as_py() or b"", chunk))
                for k, (part, lead) in enumerate(parts):
                    ids.append(names.slice(i, 1))
                    held.append((row, lead, k == len(parts) - 1, marks[i]))
                    texts.append(part)
                    size += len(part) + 1
                    if size >= chunk:
                        yield closed_chunk()
                        number, size, ids, held, texts = number + 1, 0, [], [], []
        if texts:
            yield closed_chunk()

    return rows.mapInArrow(run, schema)


def _traversal(texts: pa.Scalar, sizes: pa.Scalar, lead: pa.Scalar, closed: pa.Scalar) -> Traversal:
    """The traversal of a written chunk."""
    ends = np.cumsum(sizes.values.to_numpy())
    whole = pa.Codec("zstd").decompress(texts.as_py(), int(ends[-1]), asbytes=True) if ends[-1] else b""
    parts = [whole[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]
    return Traversal(parts, lead.values.to_numpy(), closed.values.to_numpy(zero_copy_only=False))


def asked(chunks: DataFrame, bits: int) -> DataFrame:
    """chunk, bucket, n, keys, counts: what each chunk asks each bucket, and its own counts."""
    names = ["chunk", "bucket", "n", "keys", "counts"]

    def run(batches):
        for batch in batches:
            for number, train, *rest in zip(*(common.column_of(batch, k) for k in ("chunk", "train", "texts", "sizes", "lead", "closed")), strict=True):
                path = _traversal(*rest)
                counts = path.own_counts(train.values.to_numpy(zero_copy_only=False))
                bucket = (path.keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(path.keys), np.int64)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(first[1:], len(bucket))
                made = [(number.as_py(), int(bucket[a]), int(b - a), packed(np.diff(path.keys[a:b], prepend=_U(0))), packed(counts[a:b])) for a, b in zip(first, ends, strict=True)]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=names)

    return chunks.mapInArrow(run, "chunk long, bucket long, n long, keys binary, counts binary")


def statistics(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What distinct keys and their counts add to the corpus's statistics."""
    found = np.zeros(_STATISTICS, np.int64)
    order, seen = keys & _U(3), counts > 0
    found[_TOKENS], found[_DISTINCT] = counts[order == 1].sum(), (seen & (order == 1)).sum()
    for k in (2, 3):
        found[_ONCE[k]] = ((order == k) & (counts == 1)).sum()
        own = counts[seen & (order == k - 1) & (keys != _END_KEY)].astype(np.int64)
        octave = np.frexp(own.astype(float))[1] - 1
        found[_OCTAVES[k] : _OCTAVES[k] + 128 : 2] = np.bincount(octave, own, minlength=64).astype(np.int64)
        found[_OCTAVES[k] + 1 : _OCTAVES[k] + 128 : 2] = np.bincount(octave, minlength=64)
    return found


def masses(found: np.ndarray) -> dict[int, float]:
    """Each order's m, between e^-6 and e^30, by bisection."""
    solved = {}
    for k in (2, 3):
        tokens, types = found[_OCTAVES[k] : _OCTAVES[k] + 128].reshape(64, 2).T.astype(float)
        left = tokens / np.maximum(types, 1) - 1
        low, high = -6.0, 30.0
        for _ in range(60):
            middle = (low + high) / 2
            m = np.exp(middle)
            if (tokens * m / (left.clip(0) + m)).sum() < found[_ONCE[k]]:
                low = middle
            else:
                high = middle
        solved[k] = float(np.exp(high))
    return solved


def _answered(table: pa.Table) -> pa.Table:
    """Each chunk's answer from one bucket; the bucket's statistics on its first row."""
    sizes = table["n"].to_numpy()
    keys = np.concatenate([np.cumsum(unpacked(k.as_py(), n), dtype=_U) for k, n in zip(table["keys"], sizes, strict=True)])
    counts = np.concatenate([unpacked(c.as_py(), n) for c, n in zip(table["counts"], sizes, strict=True)])
    order = np.argsort(keys)
    in_order = keys[order]
    first = np.flatnonzero(np.diff(in_order, prepend=~in_order[:1]))
    sums = np.add.reduceat(counts[order], first)
    counts[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
    made = [packed(x) for x in np.split(counts, np.cumsum(sizes)[:-1])]
    once = [statistics(in_order[first], sums).tolist()] + [None] * (len(sizes) - 1)
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "n": table["n"], "counts": pa.array(made, pa.binary()), "statistics": pa.array(once, pa.list_(pa.int64()))})


def answers(chunks: DataFrame, text_bytes: int, bucket: int = BUCKET) -> DataFrame:
    """chunk, bucket, n, counts: the whole corpus's counts for each chunk; statistics: once a bucket."""
    bits = max(0, -(-text_bytes // bucket) - 1).bit_length()
    return asked(chunks, bits).groupBy("bucket").applyInArrow(_answered, "chunk long, bucket long, n long, counts binary, statistics array<long>")


def score(docs: DataFrame, train: str, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    train names the boolean column that marks the rows to learn from; null is not one.
    """
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select("doc_id", F.coalesce(F.col(train), F.lit(False)).alias("train"), F.col("text").cast("binary").alias("text"))
    began = common.mark()
    chunks = common.materialize(chunk_table(rows, chunk))
    text_bytes = chunks.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    found = common.materialize(answers(chunks, text_bytes, bucket))
    sums = np.zeros(_STATISTICS, np.int64)
    for r in found.select(F.posexplode("statistics").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect():
        sums[r["at"]] = r["x"]
    total, distinct, mass = int(sums[_TOKENS]), int(sums[_DISTINCT]), masses(sums)
    names = ["doc_id", "row", "n_tokens", "n_known", "base_score", "score"]

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for ids, row, *rest in zip(*(left[k] for k in ("ids", "row", "texts", "sizes", "lead", "closed")), strict=True):
            got = sorted(zip(right["bucket"].to_pylist(), right["n"].to_pylist(), right["counts"].to_pylist(), strict=True))
            counts = np.concatenate([unpacked(c, n) for _, n, c in got]) if got else np.zeros(0, _U)
            path = _traversal(*rest)
            if len(counts) != len(path.keys):
                raise ValueError(f"{len(counts)} answers to {len(path.keys)} questions of a chunk")
            made.append(pa.table([ids.values, row.values, *path.scores(counts, total, distinct, mass)], names=names))
        return pa.concat_tables(made)

    schema = T.StructType([common.id_field(docs), *[T.StructField(k, T.LongType()) for k in ("row", "n_tokens", "n_known")], *[T.StructField(k, T.DoubleType()) for k in ("base_score", "score")]])
    parts = chunks.drop("train").groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(scored, schema)
    sums = [F.sum(k).alias(k) for k in ("n_tokens", "n_known")]
    logs = [F.sum(k).alias(k) for k in ("base_score", "score")]
    # The sums are written, so that neither chunks nor answers stay for a result that is read later.
    whole = common.materialize(parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums, F.lit(total).cast("long").alias("train_tokens"), *logs).drop("row"))
    common.discard_since(began, spark, whole)
    return whole


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = common.fold("doc_id", 5) == 1
    scored = score(docs.select("doc_id", "text", (~held_out).alias("_lm_train")), "_lm_train")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
