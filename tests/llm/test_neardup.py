import random
import re

import numpy as np
import pytest

from sparkurate.llm import neardup

DDL = "doc_id long, text string, source string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, threshold=85):
    """Components by comparing all pairs of sets of words in plain tuples."""
    sets = [(i, shingles(t or "")) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: find(i) for i, _ in sets}, {i: len(s) for i, s in sets}


def corpus(seed, groups=6, copies=60, alone=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(2000)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(copies):
            edited = list(base)
            for _ in range(rng.randrange(0, 5)):
                edited[rng.randrange(120)] = rng.choice(words)
            rows.append((n, " ".join(edited), "hot"))
            n += 1
    for _ in range(alone):
        rows.append((n, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))), "other"))
        n += 1
    rng.shuffle(rows)
    return rows


def check(spark, rows, threshold=85):
    want, sizes = brute(rows, threshold)
    got = neardup.near_duplicates(spark.createDataFrame(rows, DDL), threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], sizes[r.doc_id], want[r.doc_id] == r.doc_id)


def test_components_match_brute_force(spark):
    check(spark, corpus(1))


def test_other_thresholds(spark):
    rows = corpus(3, groups=4, copies=40, alone=30)
    assert brute(rows, 80)[0] != brute(rows)[0]
    check(spark, rows, 80)


def test_trees_follow_the_threshold():
    assert [neardup.trees_for(t) for t in (100, 90, 85, 80)] == [1, 6, 8, 12]
    for t in (0, 50, 68):
        with pytest.raises(ValueError):
            neardup.trees_for(t)


@pytest.mark.parametrize(("star", "levels", "few"), [(1, 2, 8), (2, 3, 0)])
def test_large_nodes_lose_no_link(spark, monkeypatch, star, levels, few):
    for name, value in (("LIMIT", 16), ("STAR_LEVEL", star), ("MAX_LEVELS", levels), ("FEW", few)):
        monkeypatch.setattr(neardup, name, value)
    check(spark, corpus(2, groups=2, copies=90, alone=20))


def test_edge_cases(spark):
    long = " ".join(f"x{k % 977}y{k}" for k in range(30_000))
    rows = [(1, None, None), (2, "", "a"), (3, "one two", "a"), (4, "ONE two", None), (5, " \t\n", "a"), (6, long, "a"), (7, long + " tail", "a"), (7, long + " tail", "a")]
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, DDL)).collect()}
    assert got == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (5, 5, True), (6, 6, True), (7, 6, False)}
    assert neardup.near_duplicates(spark.createDataFrame([], DDL)).collect() == []
    assert neardup.near_duplicates(spark.createDataFrame([(None, "a b c d e f", None), (9, "a b c d e f", None)], DDL)).count() == 2


def test_exhaustive_comparison():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:-5], np.arange(200, 300, dtype=np.uint64), a[15:]]
    assert neardup.components_of([5, 3, 4, 9], sets) == [(3, 5), (3, 9)]


def test_ids_of_any_type(spark):
    """String ids: the least one in string order names a component."""
    rows = [(f"d{i:03}", t, s) for i, t, s in corpus(7, groups=2, copies=20, alone=10)] + [(None, "a b c d e f", "x"), ("zz", None, None)]
    want, _ = brute([r for r in rows if r[0] is not None])
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string, source string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_query_holds_its_contract(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = corpus(9, groups=3, copies=25, alone=25) + [(5000, None, None), (5001, "", "a"), (5002, "One two", "a"), (5003, "one\ttwo", "b"), (5004, "x" * 100_000, "b")]
    docs = spark.createDataFrame(rows, DDL)
    for name in ("rep", "n", "signature", "own", "node", "_class", "component"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, sizes = brute(rows)
    got = neardup.op6_near_duplicates(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.component_id, r.n_shingles, r.kept) for r in got) == sorted((i, want[i], sizes[i], want[i] == i) for i, *_ in rows)
    want, _ = brute(rows, 80)
    left = neardup.stage(spark, docs, "")
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i in want if want[i] == i}


def test_stage_drops_rows_not_ids(spark):
    """Texts that duplicate nothing stay, whatever other text has their id; rows without an id are dropped like others."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "y"), (3, c, "y"), (None, a, "z"), (None, "nobody has this text at all", "z"), (2, None, None), (4, "", None)]
    left = neardup.stage(spark, spark.createDataFrame(rows, DDL), "").collect()
    assert sorted(map(tuple, left), key=str) == sorted([r for r in rows if r not in ((2, a, "x"), (None, a, "z"))], key=str)
