"""Places in a total order, greedy rounds and seeded draws against plain loops."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkurate.functions import values as V
from sparkurate.operators import metrics, ordering, sampling, splits
from sparkurate.plans import candidates

from .test_pipeline_parts import greedy


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_places_and_sums(spark, ranges):
    rng = random.Random(11)
    rows = [(i, rng.choice([1, 1, 1, 2, None]), rng.randrange(9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, k int, v int")
    order = [F.col("k").desc_nulls_last(), F.col("id")]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = ordering.numbered(frame, order, "place", ranges).orderBy("place").collect()
    assert [(r.place, r.id, r.k, r.v) for r in got] == [(n + 1, *r) for n, r in enumerate(want)]
    sums = ordering.running_sum(frame, order, "v", "total", ranges).collect()
    assert {r.id: r.total for r in sums} == {r[0]: sum(x[2] for x in want[: n + 1]) for n, r in enumerate(want)}
    assert ordering.numbered(frame.limit(0), order).collect() == []


@pytest.mark.parametrize("ranges", [1, 13])
def test_text_of_a_hot_key(spark, ranges):
    rng = random.Random(12)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(500), rng.choice(["x", "y\n", "", None])) for _ in range(400)] + [("none", 1, None)]
    frame = spark.createDataFrame(rows, "k string, place int, v string")
    got = ordering.joined_text(frame, ["k"], [F.col("place"), F.col("v")], "v", "|", ranges).collect()
    want = defaultdict(list)
    for k, place, v in rows:
        want[k] += [(place, v)] if v is not None else []
    assert {r.k: r.text for r in got} == {k: "|".join(v for _, v in sorted(x)) for k, x in want.items()}
    assert {r.k for r in metrics.ordered_text(frame, ["k"], "place", "v", "|").collect()} == set(want)


def rivals(seed, labels="abcd", n=60):
    """Observations of several observers, a hot observer, nulls."""
    rng, rows = random.Random(seed), []
    for label in labels:
        for _ in range(rng.randrange(1, n)):
            rows.append((label, len(rows), rng.choice([None, *range(15)]), rng.choice([None, 0, 0, 0, *range(8)]), rng.random() < 0.4))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_greedy_rounds(spark, seed):
    rows = rivals(seed)
    frame = spark.createDataFrame(rows, "label string, id int, observation int, observer int, flag boolean")
    quotas = {"a": 3, "b": 40, "c": 5, "d": 0}
    frame = frame.withColumn("quota", F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col("label")])
    by_label = defaultdict(list)
    for r in frame.orderBy(F.desc("flag"), sampling.order_key("id"), "id").collect():
        by_label[r.label].append((r.id, r.observation, r.observer))
    want = {i for label, v in by_label.items() for i in greedy(v, quotas[label], 2)}
    got = sampling.greedy_top(frame, "label", "observation", "observer", "flag", ["id"], F.col("quota"))
    assert sorted(r.id for r in got.collect()) == sorted(want) and set(frame.columns) <= set(got.columns)
    assert sampling.greedy_top(frame.limit(0), "label", "observation", "observer", "flag", ["id"], 5).collect() == []
    with pytest.raises(ValueError):
        sampling.greedy_top(frame, "label", "observation", "observer", "flag", ["id"], 0)


def test_long_chains_of_rivals(spark):
    """Each row waits for the one before: as many rounds as it takes, the loop's choice all the same."""
    rows = [("a", i, (i + 1) // 2, 100 + i // 2, True) for i in range(12)]
    frame = spark.createDataFrame(rows, "label string, id int, observation int, observer int, flag boolean")
    got = sampling.greedy_top(frame, "label", "observation", "observer", "flag", [], 50, per_observer=1, order=[F.col("id")])
    assert sorted(r.id for r in got.collect()) == greedy([(i, o, w) for _, i, o, w, _ in rows], 50, 1)


def test_seeded_draws(spark):
    sizes = {"a": 40, "b": 0, "c": 1, "d": 25, "other": 9}
    rows = [(b, i, f"{b}{i}") for b, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "bucket string, place int, name string").repartition(5)
    for sample in (None, 7):
        generator, want = random.Random(23), []
        for b in "abcd":
            names = [f"{b}{i}" for i in range(sizes[b])]
            if sample:
                names = generator.sample(names, min(sample, len(names)))
            else:
                generator.shuffle(names)
            want += [(b, n + 1, name) for n, name in enumerate(names)]
        got = sampling.seeded(frame, "bucket", "place", list("abcd"), 40, 23, sample).collect()
        assert sorted((r.bucket, r.drawn, r.name) for r in got) == sorted(want)
    with pytest.raises(ValueError, match="more than 39 rows"):
        sampling.seeded(frame, "bucket", "place", list("abcd"), 39)


def test_splits_by_one_generator(spark):
    """The splits as a loop that shuffles label after label makes them."""
    rows = [("PLANT_01", "plants", f"k{i}", f"p{i}") for i in range(30)] + [("unknown", "fungi" if i % 7 == 0 else "plants", f"u{i}", f"q{i}") for i in range(80)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "label_id string, kingdom string, observation_id string, photo_id string, place int")
    known, unknown = {"train": 12, "val": 6, "test": 4}, {"train": 20, "val": 9, "test": 5}
    got = splits.build_splits(frame, ["PLANT_01"], known, unknown, extra=5, place="place")

    buckets = defaultdict(list)
    for label, kingdom, observation, _ in rows:
        buckets[label if label != "unknown" else {"fungi": "UNK_NON_TARGET_FUNGUS", "plants": "UNK_NON_TARGET_PLANT"}[kingdom]].append(observation)
    generator, want = random.Random(V.SEED), Counter()
    for label in ("PLANT_01", *V.INTERNAL_UNKNOWN):
        generator.shuffle(buckets[label])
    train, start = buckets["PLANT_01"][:12], 0
    for name, n in known.items():
        want.update((name, "PLANT_01", o, None) for o in buckets["PLANT_01"][start : start + n])
        start += n
    for name, n in unknown.items():
        shares = splits.allocate({k: len(buckets[k]) for k in V.INTERNAL_UNKNOWN if buckets[k]}, n)
        for label, share in shares.items():
            want.update((name, label, o, None) for o in buckets[label][:share])
            buckets[label] = buckets[label][share:]
    want.update(("train", "PLANT_01", o, "hard_negative_oversample") for o in random.Random(V.SEED).sample(train, 5))
    assert Counter((r.split, r.label_id, r.observation_id, r.repeat_reason) for r in got.collect()) == want
    assert "_drawn" not in got.columns


def test_selection_by_one_generator(spark):
    """Priority rows are shuffled first, then the others, label after label; observations have several observers."""
    rng = random.Random(13)
    manifest = spark.createDataFrame([("L2", 0), ("L1", 1)], "label_id string, place int")
    rows = [(rng.choice(["L1", "L2", "unknown"]), f"o{rng.randrange(30)}", f"w{rng.randrange(9)}", rng.random() < 0.3, f"p{i}", i) for i in range(150)]
    frame = spark.createDataFrame(rows, "label_id string, observation_id string, observer_id string, is_poland boolean, photo_id string, row int")
    chosen, missing = candidates.select(frame, manifest, per_label=10, unknown=40, place="row")
    generator, want, short = random.Random(V.SEED), set(), {}
    for label, quota in (("L2", 10), ("L1", 10), ("unknown", 40)):
        first, rest = ([r for r in rows if r[0] == label and r[3] == flag] for flag in (True, False))
        generator.shuffle(first)
        generator.shuffle(rest)
        picked = greedy([(r[4], r[1], r[2]) for r in first + rest], quota, 2)
        want |= set(picked)
        short |= {label: quota - len(picked)} if len(picked) < quota else {}
    assert {r.photo_id for r in chosen.collect()} == want and chosen.columns == frame.columns
    assert {r.label_id: r.missing for r in missing.collect()} == short
