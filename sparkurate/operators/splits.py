"""Splits: largest-remainder allocation and the split builder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import ordering, sampling
from sparkurate.session import written


def allocate(capacities: dict[str, int], need: int) -> dict[str, int]:
    """Shares of need in proportion to capacities, whole and exact.

    Floors first; what is left goes one each to the largest fractions (of equal ones the larger
    capacity, then the earlier key) that have room.
    """
    have = sum(capacities.values())
    if need > have:
        raise ValueError(f"{need} rows are needed, {have} are there")
    if not need:
        return dict.fromkeys(capacities, 0)
    shares = {k: divmod(need * c, have) for k, c in capacities.items()}
    given = {k: whole for k, (whole, _) in shares.items()}
    for k in sorted(capacities, key=lambda k: (-shares[k][1], -capacities[k])):
        if sum(given.values()) == need:
            break
        given[k] += given[k] < capacities[k]
    if sum(given.values()) != need:
        raise ValueError(f"{need} rows can't be dealt over {capacities}")
    return given


def allocation(capacities: DataFrame, need: int, key: str = "label", capacity: str = "capacity") -> DataFrame:
    """allocate() on a table of any number of keys: key, capacity, share; ties in key order.

    Two sums of the whole table, and a place by fraction among the keys that have room; no window of all keys.
    """
    have = capacities.agg(F.coalesce(F.sum(capacity), F.lit(0)).alias("have")).first()["have"]
    share = F.expr(f"{need}L * {capacity} div {max(have, 1)}L")
    base = capacities.select(key, capacity, share.alias("share"), (F.lit(need).cast("long") * F.col(capacity) - share * F.lit(have)).alias("_fraction"), (share < F.col(capacity)).alias("_room"))
    left = need - (base.agg(F.sum("share").alias("given")).first()["given"] or 0)
    placed = ordering.numbered(base, [F.desc("_room"), F.desc("_fraction"), F.desc(capacity), F.col(key)], "_place")
    return placed.select(key, capacity, (F.col("share") + (F.col("_room") & (F.col("_place") <= left)).cast("long")).alias("share"))


def effective_labels(records: DataFrame) -> DataFrame:
    """source_label_id keeps the label, label_id tells unknown apart by kingdom, public_label_id collapses it again."""
    effective = C.unknown_subclass(F.col("label_id"), F.col("kingdom"))
    return records.withColumns({"source_label_id": F.col("label_id"), "_effective": effective}).withColumn("label_id", F.col("_effective")).drop("_effective").withColumn("public_label_id", C.collapse(F.col("label_id")))


def leaking(rows: DataFrame, key: str = "observation_id", split: str = "split") -> DataFrame:
    """Keys in more than one split; two extremes an aggregate, no self-join."""
    return rows.groupBy(key).agg(F.min(split).alias("_a"), F.max(split).alias("_b")).where("_a <> _b").select(key)


def build_splits(records: DataFrame, known: list[str], known_quotas: dict[str, int] | None = None, unknown_quotas: dict[str, int] | None = None, extra: int = V.EXTRA_HARD_NEGATIVES, seed: int = V.SEED, ids: tuple[str, ...] = ("observation_id", "photo_id"), place: str | None = None, most_rows: int = V.UNKNOWN_CAPS[1]) -> DataFrame:
    """Annotated rows of all splits; hard negatives again in train.

    The order within a label is that of md5 keys; or, with place (the column of a row's number in
    its file), that of one seeded generator which shuffles label after label, as sampling.seeded does.

    Known labels are cut at the quotas. Unknown rows are dealt split by split in proportion to
    what the splits before have left of each subclass: counts of three subclasses meet the
    driver, the rows stay where they are. Shortages raise one error, a key in two splits another.
    """
    known_quotas = known_quotas or V.KNOWN_QUOTAS
    unknown_quotas = unknown_quotas or V.UNKNOWN_QUOTAS
    rows = effective_labels(records)
    wanted = rows.where(F.col("label_id").isin(*known, *V.INTERNAL_UNKNOWN))
    counts = {r["label_id"]: r["n"] for r in wanted.groupBy("label_id").agg(F.count("*").alias("n")).collect()}
    need = sum(known_quotas.values())
    short = [f"{k}: {counts.get(k, 0)} of {need}" for k in known if counts.get(k, 0) < need]
    left = {k: counts[k] for k in V.INTERNAL_UNKNOWN if counts.get(k)}
    if not left:
        short.append("no unknown rows")
    if short:
        raise ValueError("too few rows: " + "; ".join(short))
    dealt: dict[str, dict[str, int]] = {k: {} for k in left}
    for split, amount in unknown_quotas.items():
        for k, n in allocate(left, amount).items():
            dealt[k][split] = n
            left[k] -= n
    order = [sampling.order_key(*ids, seed=seed), *[F.col(i) for i in ids]]
    if place:
        rows = written(sampling.seeded(rows, "label_id", place, [*known, *V.INTERNAL_UNKNOWN], most_rows, seed, name="_drawn"))
        order = [F.col("_drawn")]
    cut = sampling.slices(rows.where(F.col("label_id").isin(*known)), ["label_id"], order, known_quotas)
    for k, quotas in dealt.items():
        cut = cut.unionByName(sampling.slices(rows.where(F.col("label_id") == k), ["label_id"], order, quotas))
    cut = cut.where("split is not null")
    leaks = leaking(cut, ids[0]).limit(5).collect()
    if leaks:
        raise ValueError(f"in more than one split: {[r[0] for r in leaks]}")
    train = cut.where("split = 'train'").withColumn("repeat_reason", F.lit(None).cast("string"))
    if place:
        again = sampling.seeded(train, "label_id", "_drawn", sorted(V.HARD_NEGATIVES), most_rows, seed, sample=extra, name="_again") if extra > 0 else train.limit(0)
        both = train.unionByName(again.withColumn("repeat_reason", F.lit("hard_negative_oversample")), allowMissingColumns=True)
        return both.unionByName(cut.where("split <> 'train'"), allowMissingColumns=True).drop("_drawn", "_again")
    train = sampling.oversample(train, "label_id", V.HARD_NEGATIVES, list(ids), extra, seed)
    return train.unionByName(cut.where("split <> 'train'"), allowMissingColumns=True)


def in_slots(df: DataFrame, slots: DataFrame, place: str = "rn") -> DataFrame:
    """Rows with the slot whose bounds (low, high) hold their place; slots are a handful, given in code."""
    return df.join(F.broadcast(slots), F.col(place).between(F.col("low"), F.col("high")))
