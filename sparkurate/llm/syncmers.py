"""Document fingerprints of closed syncmers, with DataFrame and SQL functions only.

A text is a sequence of units: runs of up to RUN characters from "0" to U+0DFF (the alphabets of the
scripts with spaces), and every other character but white space one by one. A k-mer of units
is an anchor if the least hash of its inner s-mers is that of the first or the last of
them. Whether it is depends on nothing outside the k-mer, so anchors are context-free: the part of
a text that an edit leaves alone keeps all of its anchors, wherever it moves, and any K - S + 1
neighbouring k-mers have one at least (a text of fewer may have none).

A fingerprint is the sequence of anchors, each a place (in units) and 32 bits of the k-mer's
hash. Two fingerprints are matched by position: anchors match that have the same hash in the same
stretch of DRIFT units, so that what has moved by d units loses about d / DRIFT of its matches.
The likeness is the number of matches over the larger number of anchors, each counted once.

The next document by descending id is a neighbour in a window over a bucket of ids. Buckets are
cut at quantiles of a mergeable sketch of the ids, so they have about equal numbers of rows; they
only deal out the work. The first document of each bucket is also sent to the bucket
before it, where it follows the last one. Texts are shuffled once.

Edge cases: a null text is an empty one; a text without a closed syncmer has one anchor, the hash of
the whole text, at place 0 (so two empty texts are alike); a null id comes after all others; rows of
one id are in the order of a hash of their texts, and where they are more than a bucket's
share they are dealt over several; equal rows follow each other and give equal results; a single
document is its own next one; an empty table gives an empty result. Ids are integers. A long text is
read in pieces of PIECE characters, cut at white space; what is held of all of it is a hash a unit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Units in a k-mer and in its inner s-mers.
K, S = 8, 2
RUN = 32
#: One range is the fastest class that the regular expressions have.
UNIT = rf"[0-\x{{DFF}}]{{1,{RUN}}}|\S"
PIECE = 1 << 14
DRIFT = 1024
#: Rows in a bucket of neighbours, and the root of the most buckets.
BUCKET_ROWS, LEVEL = 1024, 256
_HASH = (1 << 32) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def unit_hashes(text: Column, piece: int = PIECE) -> Column:
    """A hash of each unit, in order."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{piece}}}(?!\S)|.{{1,{piece}}}"), F.lit(0))
    return F.flatten(F.transform(pieces, lambda part: F.transform(F.regexp_extract_all(part, F.lit(UNIT), F.lit(0)), lambda unit: F.xxhash64(unit))))


def anchors(text: Column, k: int = K, s: int = S, piece: int = PIECE) -> Column:
    """place << 32 | hash of each closed syncmer, in the order of places; of a text without one its own hash."""
    inner = k - s + 1

    def of_units(units: Column) -> Column:
        def mer(first: Column, i: Column) -> Column:
            """The s-mer's hash: its units' hashes, each turned by its place."""
            for j in range(1, s):
                first = F.shiftleft(first, 1).bitwiseXOR(F.get(units, i + j))
            return first

        def chosen(mers: Column) -> Column:
            def code(first: Column, i: Column) -> Column:
                last = F.get(mers, i + (inner - 1))
                closed = last.isNotNull()
                for j in range(inner - 2, 0, -1):  # the nearest is looked at first; most stop there
                    between = F.get(mers, i + j)
                    closed = ((between >= first) | (between >= last)) & closed
                whole = F.xxhash64(first, *[F.get(mers, i + j) for j in sorted({*range(s, inner - 1, s), inner - 1} - {0})])
                return F.when(closed, F.shiftleft(i.cast("long"), 32).bitwiseOR(whole.bitwiseAND(F.lit(_HASH))))

            return F.filter(F.transform(mers, code), lambda anchor: anchor.isNotNull())

        return F.when(F.size(units) >= k, let(F.transform(units, mer), chosen)).otherwise(F.array().cast("array<long>"))

    whole = F.array(F.xxhash64(text).bitwiseAND(F.lit(_HASH)))
    return let(let(unit_hashes(text, piece), of_units), lambda found: F.when(F.size(found) > 0, found).otherwise(whole))


def rendered(found: Column) -> Column:
    """The fingerprint as text: of each anchor its place, counted from 1, and eight digits of its hash, in hexadecimal."""
    return F.array_join(F.transform(found, lambda a: F.hex(a + F.lit(1 << 32))), " ")


def likeness(one: Column, other: Column, drift: int = DRIFT) -> Column:
    """Anchors that match by hash and stretch of places over the larger number of anchors, 0 to 1; null where either is null."""

    def placed(found: Column) -> Column:
        """hash << 31 | stretch, each once. drift is a power of two."""
        return F.array_distinct(F.transform(found, lambda a: F.shiftleft(a.bitwiseAND(F.lit(_HASH)), 31).bitwiseOR(F.shiftrightunsigned(a, 31 + drift.bit_length()))))

    return let(placed(one), lambda a: let(placed(other), lambda b: F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))))


def _held(values: list, kind: str = "long") -> Column:
    """An array from one literal, however many values there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _bucket(key: Column, tie: Column, bounds: list[int]) -> Column:
    """The number of bounds that the id reaches; where several are equal to it, a part of them by its tie."""
    tops = bounds[LEVEL - 1 :: LEVEL]

    def reached(strict: bool) -> Column:
        def below(bound: Column) -> Column:
            return bound < key if strict else bound <= key

        top = F.size(F.filter(_held(tops), below)) if tops else F.lit(0)
        rest = F.slice(_held(bounds), top * LEVEL + 1, LEVEL - 1)
        return top * LEVEL + F.size(F.filter(rest, below))

    if not bounds:
        return F.lit(0)
    least, most = reached(True), reached(False)
    share = F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(1 << 63))), 33) / F.lit(float(1 << 31))
    return F.when(most - least < 2, most).otherwise(least + F.floor(share * (most - least + 1)).cast("int"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """key, _sync_text, _sync_next (the next document's text by descending id; after the last the first's) and the window.

    Rows with _sync_ghost are copies of a bucket's first one; whoever has used the window drops them.
    """
    ids = docs.select(F.col(key).alias("id"))
    counted = ids.agg(F.count("*").alias("n")).first()["n"]
    parts = min(-(-counted // bucket_rows), LEVEL * LEVEL) if counted else 1
    bounds = []
    if parts > 1:
        found = ids.agg(F.percentile_approx("id", _held([i / parts for i in range(1, parts)], "double"), F.lit(max(10_000, 4 * parts))).alias("at")).first()["at"]
        bounds = sorted(found or [])
    tie = F.xxhash64("_sync_text")
    rows = docs.select(F.col(key).alias("_sync_id"), F.coalesce(F.col(text), F.lit("")).alias("_sync_text")).withColumn("_sync_tie", tie)
    rows = rows.withColumn("_sync_bucket", F.when(F.col("_sync_id").isNull(), -1).otherwise(_bucket(F.col("_sync_id"), F.col("_sync_tie"), bounds)))
    # One row a bucket: its first document, and the bucket before, to which a copy goes.
    order = F.struct(F.col("_sync_id"), F.col("_sync_tie"))
    firsts = rows.groupBy("_sync_bucket").agg(F.max(order).alias("first"))
    falling = Window.orderBy(F.col("_sync_bucket").desc())
    firsts = firsts.withColumn("copy_to", F.coalesce(F.lag("_sync_bucket").over(falling), F.min("_sync_bucket").over(Window.partitionBy())))
    firsts = F.broadcast(firsts.select(F.col("_sync_bucket").alias("_sync_b"), F.col("first._sync_id").alias("_sync_i"), F.col("first._sync_tie").alias("_sync_t"), "copy_to"))
    same = (F.col("_sync_bucket") == F.col("_sync_b")) & F.col("_sync_id").eqNullSafe(F.col("_sync_i")) & (F.col("_sync_tie") == F.col("_sync_t"))
    sent = rows.join(firsts, same, "left").withColumn("_sync_to", F.explode(F.expr("if(copy_to IS NULL, array(struct(_sync_bucket AS bucket, false AS ghost)), array(struct(_sync_bucket AS bucket, false AS ghost), struct(copy_to AS bucket, true AS ghost)))")))
    sent = sent.select("_sync_id", "_sync_text", "_sync_tie", F.col("_sync_to.bucket").alias("_sync_bucket"), F.col("_sync_to.ghost").alias("_sync_ghost"))
    # The work comes after the shuffle: as many tasks as buckets, not as few as their bytes would take.
    sent = sent.repartition(max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_sync_bucket")
    by = Window.partitionBy("_sync_bucket").orderBy("_sync_ghost", F.col("_sync_id").desc_nulls_last(), F.col("_sync_tie").desc())
    return sent.withColumn("_sync_next", F.lead("_sync_text").over(by)), by


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """key, n_chars, edited (the text), found and found_edited (their anchors), near_edited and near_next of every row.

    The edited text has the last third of the code points replaced by the start of the next document.
    """
    rows, by = with_next(docs, key, text, bucket_rows)
    length = F.char_length("_sync_text")
    moved = F.floor(length / 3).cast("int")
    edited = F.concat(F.left("_sync_text", length - moved), F.left("_sync_next", moved))
    rows = rows.select(F.col("_sync_id").alias(key), *["_sync_" + n for n in ("bucket", "ghost", "id", "tie")], length.cast("long").alias("n_chars"), F.when(~F.col("_sync_ghost"), edited).alias("edited"), anchors(F.col("_sync_text")).alias("found"))
    rows = rows.withColumn("_sync_found_next", F.lead("found").over(by)).where("NOT _sync_ghost")
    rows = rows.withColumn("found_edited", anchors(F.col("edited")))
    return rows.select(key, "n_chars", "edited", "found", "found_edited", likeness(F.col("found"), F.col("found_edited")).alias("near_edited"), likeness(F.col("found"), F.col("_sync_found_next")).alias("near_next"))


def op13_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document and its edited text."""
    rows = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), rendered(F.col("found")).alias("fingerprint"), rendered(F.col("found_edited")).alias("edited_fingerprint"), "near_edited", "near_next")
