"""Sources, sinks, splits, candidates, evaluation and checks end to end on small tables."""

import gzip
import json
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import lookups, metrics, rendering, sampling, splits
from sparkurate.plans import candidates, dataset, evaluation
from sparkurate.sources import readers, sinks

MANIFEST = [(f"{p}_{i:02d}", k, f"{p.title()} species{i}", f"pl{p}{i}", f"en{p}{i}") for p, k in (("PLANT", "plants"), ("FUN", "fungi")) for i in range(1, 21)]


def manifest_file(folder: Path) -> str:
    path = folder / "manifest.csv"
    path.write_text("label_id,kingdom,scientific_name,polish_name,english_name\n" + "\n".join(",".join(("  " + m[0], m[1].upper(), *m[2:])) for m in MANIFEST) + "\n", encoding="utf-8")
    return str(path)


# --- sources and sinks -----------------------------------------------------------------------


def test_find_files(tmp_path):
    deep = tmp_path / "sub"
    deep.mkdir()
    (deep / "taxa.csv").write_text("x")
    assert readers.find_files(str(tmp_path), "taxa") == [str(deep / "taxa.csv")]
    for name in ("taxa-2.csv", "taxa-1.csv"):
        (tmp_path / name).write_text("x")
    assert readers.find_files(str(tmp_path), "taxa") == [str(tmp_path / "taxa-1.csv")]
    assert len(readers.find_files(str(tmp_path), "taxa", all_shards=True)) == 2
    with pytest.raises(FileNotFoundError):
        readers.find_files(str(tmp_path), "photos")


def test_untyped_csv(spark, tmp_path):
    text = "taxon_id\tname\tancestry\textra\n1\tA\t\tx\n2\tB\n3\tC\t1/2\tx\ty\n4\tD\t5\tz\n"
    (tmp_path / "t.tsv").write_text(text)
    with gzip.open(tmp_path / "t.tsv.gz", "wt") as file:
        file.write(text)
    for name in ("t.tsv", "t.tsv.gz"):
        table = readers.read_untyped(spark, str(tmp_path / name), schemas.TAXA)
        assert sorted(map(tuple, table.collect())) == [("1", "A", None), ("4", "D", "5")]
    table.write.parquet(str(tmp_path / "t.parquet"))
    assert readers.read_untyped(spark, str(tmp_path / "t.parquet"), schemas.TAXA).count() == 2


def test_manifest(spark, tmp_path):
    path = manifest_file(tmp_path)
    rows = rendering.manifest_list(readers.read_manifest(spark, path))
    assert rows == MANIFEST
    with pytest.raises(ValueError, match="40"):
        readers.read_manifest(spark, path, size=41)
    (tmp_path / "bad.csv").write_text("label_id,kingdom\na,b\n")
    with pytest.raises(ValueError, match="polish_name"):
        readers.read_manifest(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "empty.csv").write_text(",".join(schemas.RECORDS.names) + "\n")
    with pytest.raises(ValueError):
        readers.read_records(spark, str(tmp_path / "empty.csv"))


def test_json_lines(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"labels":"a","response":"b","images":["i"]}\n\n{"labels":"ł"}\n', encoding="utf-8")
    bad.write_text('{"labels":"a"}\n\n{"labels":\n', encoding="utf-8")
    assert readers.read_json_lines(spark, str(good), schemas.RESULTS).count() == 2
    assert readers.read_json_lines_strict(spark, str(good), schemas.RESULTS).count() == 2
    with pytest.raises(ValueError, match="line 3"):
        readers.read_json_lines_strict(spark, str(bad), schemas.RESULTS)
    out = str(tmp_path / "out")
    sinks.write_json_lines(readers.read_json_lines(spark, str(good), schemas.RESULTS), out)
    sinks.rewrite_json_lines(spark.read.schema(schemas.RESULTS).json(out).where("labels = 'ł'"), out)
    assert [r.labels for r in spark.read.schema(schemas.RESULTS).json(out).collect()] == ["ł"]


def test_label_catalog_round_trip(spark, tmp_path):
    entries = readers.literal_catalog(spark, MANIFEST)
    sinks.write_text(sinks.label_document(entries), str(tmp_path / "labels.json"))
    catalog = readers.read_label_catalog(spark, str(tmp_path / "labels.json"))
    row = catalog.first()
    assert len(row.supported_labels) == 41 and len(row.training_supported_labels) == 43 and set(row.collapse_to_public) == set(V.INTERNAL_UNKNOWN)
    rows = {r.label_id: r.public_label_id for r in readers.catalog_entries(catalog).collect()}
    assert len(rows) == 44 and rows[V.UNKNOWN_PLANT] == "unknown" and rows["FUN_01"] == "FUN_01"
    assert readers.supported_labels(catalog).count() == 44
    assert json.loads(sinks.label_document(entries, internal_unknown=False))["collapse_to_public"] == {}
    enum = json.loads(sinks.json_schema(readers.supported_labels(catalog)).first()["schema"])["properties"]["label_id"]["enum"]
    assert enum == sorted(enum, key=str.upper) and len(enum) == 44


def test_media_and_files(spark, tmp_path):
    folder = tmp_path / "media"
    folder.mkdir()
    (folder / "a.json").write_text('﻿{"label_id":"FUN_01","title":"old"}', encoding="utf-8")
    (folder / "b.json").write_text('{\n"label_id":"fun_01",\n"title":"new","image_file":"a.png"}', encoding="utf-8")
    (folder / "c.json").write_text("{broken", encoding="utf-8")
    (folder / "d.json").write_text('{"label_id":"FUN_02","image_file":"none.png"}', encoding="utf-8")
    (folder / "a.png").write_bytes(b"png")
    got = {(r.label_id, r.title, r.image_path) for r in readers.read_media(spark, str(folder)).collect()}
    assert got == {("fun_01", "new", str(folder / "a.png")), ("FUN_02", None, None)}
    assert readers.read_media(spark, str(folder / "none")).collect() == []
    files = readers.inventory(spark, str(folder))
    assert files.count() == 5 and files.agg(F.sum("length")).first()[0] > 0
    tries = spark.createDataFrame([(0, "/none"), (1, str(folder / "b.json")), (2, str(folder / "a.json"))], "place int, path string")
    assert readers.first_existing(tries, files).first().path == str(folder / "b.json")


def test_bundle(spark, tmp_path):
    source = tmp_path / "raw" / "FUN_01"
    source.mkdir(parents=True)
    (source / "1.jpg").write_bytes(b"x")
    examples = spark.createDataFrame([(1, [str(source / "1.jpg")])], "id int, images array<string>")
    out = sinks.bundle(examples, str(tmp_path / "out"), "pre")
    assert out.first().images == ["pre/images/FUN_01/1.jpg"] and (tmp_path / "out/images/FUN_01/1.jpg").read_bytes() == b"x"
    with pytest.raises(Exception, match="none.jpg"):
        sinks.bundle(spark.createDataFrame([(1, ["/x/none.jpg"])], "id int, images array<string>"), str(tmp_path / "out"))
    (tmp_path / "raw" / "records.csv").write_text("r")
    assert sinks.copy_side_files(str(source), str(tmp_path / "side")) == ["records.csv"]


# --- candidates ------------------------------------------------------------------------------


def test_candidate_chain(spark):
    manifest = readers.literal_catalog(spark, MANIFEST)
    taxa = spark.createDataFrame([("10", "plant SPECIES1", "1/47126"), ("11", "Fun species1", "47170/2"), ("12", "Other", "47126"), ("13", "Animal", "9"), ("47170", "Fungi", None)], schemas.TAXA)
    seen = [("o1", "u1", "10", "Research", "52.0", "20.0"), ("o2", None, "11", "needs_id", "40", "10"), ("o3", "u1", "10", "casual", "52", "20"), ("o4", "u1", "10", "research", "x", "20"), ("o5", "u1", "12", "verifiable", "34.0", "-32.0"), ("o6", "u1", "13", "research", "50", "20"), ("o7", "u2", "10", "research", "52", "20")]
    photos = [("o1", "2", "JPG", "CC-BY", "p", "1"), ("o1", "3", "jpg", "CC0", "", "0"), ("o2", "4", "png", "cc_by_nc", None, None), ("o5", "5", "", "CC0", "p", "0"), ("o5", "6", "jpg", "CC0", "p", "2"), ("o7", "7", "jpg", "all-rights-reserved", "p", "0"), ("o7", "8", "jpg", "CC0", "p", "1")]
    found = candidates.candidates(taxa, spark.createDataFrame(seen, schemas.OBSERVATIONS), spark.createDataFrame(photos, schemas.PHOTOS), manifest)
    rows = {r.observation_id: r for r in found.collect()}
    assert set(rows) == {"o1", "o2", "o5"}  # o7's first photo isn't licensed; its second doesn't stand in
    assert (rows["o1"].label_id, rows["o1"].photo_id, rows["o1"].photographer, rows["o1"].is_poland) == ("PLANT_01", "3", "u1", True)
    assert (rows["o2"].label_id, rows["o2"].observer_id, rows["o2"].license_code, rows["o2"].is_poland) == ("FUN_01", "unknown_observer", "CC-BY-NC", False)
    assert (rows["o5"].label_id, rows["o5"].polish_name) == ("unknown", "nieznane")
    chosen, short = candidates.select(found, manifest, per_label=1, unknown=2)
    assert chosen.count() == 3 and {r.label_id: r.missing for r in short.collect()}["unknown"] == 1
    records = sinks.record_rows(chosen, "/images")
    first = records.where("observation_id = 'o1'").first()
    assert (first.latitude, first.is_poland, first.image_path) == ("52.000000", "true", "/images/PLANT_01/3.jpg")
    assert sinks.attribution_rows(records).columns == schemas.ATTRIBUTION.names
    failed = records.select("image_path").limit(1)
    assert sinks.record_rows(chosen, "/images", failed).count() == 2
    assert lookups.attribute_failures(records, failed).first().missing == 1


def greedy(rows, quota, per_observer):
    """The selection as a loop: flagged first, one an observation, few an observer."""
    chosen, seen, used = [], set(), Counter()
    for r in rows:
        if len(chosen) < quota and r[1] not in seen and used[r[2]] < per_observer:
            chosen.append(r[0])
            seen.add(r[1])
            used[r[2]] += 1
    return chosen


def test_diverse_top_is_greedy(spark):
    rng, rows = random.Random(5), []
    for label in "abcdefgh":
        for _ in range(rng.randrange(1, 40)):
            observation = rng.randrange(25)
            rows.append((label, len(rows), observation, observation % 7, rng.random() < 0.4))
    frame = spark.createDataFrame(rows, "label string, id int, observation int, observer int, flag boolean")
    ordered = frame.orderBy(F.desc("flag"), sampling.order_key("id"), "id").collect()
    by_label = defaultdict(list)
    for r in ordered:
        by_label[r.label].append((r.id, r.observation, r.observer))
    want = {i for v in by_label.values() for i in greedy(v, 6, 2)}
    assert {r.id for r in sampling.diverse_top(frame, "label", "observation", "observer", "flag", ["id"], 6).collect()} == want
    assert sampling.one_observer_each(frame, "observation", "observer")
    with pytest.raises(ValueError):
        sampling.diverse_top(frame, "label", "observation", "observer", "flag", ["id"], 0)


def test_first_rows_and_newest(spark):
    frame = spark.range(5).withColumnRenamed("id", "place")
    assert sampling.first_rows(frame, "place", 3).count() == 3
    for n in (0, 6):
        with pytest.raises(ValueError):
            sampling.first_rows(frame, "place", n)
    files = spark.createDataFrame([("a.gguf", 1, [1, 2, 3]), ("b-MMPROJ.gguf", 2, [4])], "name string, place int, ids array<int>")
    assert sampling.first_with(files, "name", ("mmproj", "projector"), "place").first().name == "b-MMPROJ.gguf"
    assert files.select(sampling.first_items("ids", 2).alias("x")).first().x == [1, 2]
    paths = spark.createDataFrame([("run/checkpoint-9",), ("run/checkpoint-10",), ("run/x",)], "p string")
    assert sampling.newest(paths, "p").first().p == "run/checkpoint-10"
    assert sampling.newest(paths.union(spark.createDataFrame([("last/checkpoint-1",)], "p string")), "p").first().p == "last/checkpoint-1"


# --- splits ----------------------------------------------------------------------------------


def split_records(spark):
    rows = [("PLANT_01", "plants", f"k{i}", f"p{i}", f"/img/{i}.jpg") for i in range(410)]
    rows += [("unknown", "fungi" if i % 7 == 0 else "plants", f"u{i}", f"q{i}", f"/img/u{i}.jpg") for i in range(3200)]
    return spark.createDataFrame(rows, "label_id string, kingdom string, observation_id string, photo_id string, image_path string")


def test_split_golden(spark):
    built = splits.build_splits(split_records(spark), ["PLANT_01"], extra=10).cache()
    assert {r.split: r["count"] for r in built.groupBy("split").count().collect()} == {"train": 2310, "val": 450, "test": 450, "dev": 20}
    counts = {(r.split, r.label_id): r["count"] for r in built.where("public_label_id = 'unknown'").groupBy("split", "label_id").count().collect()}
    assert counts[("train", V.UNKNOWN_PLANT)] == 1714 and counts[("train", V.UNKNOWN_FUNGUS)] == 286 and counts[("val", V.UNKNOWN_FUNGUS)] == 57 and counts[("dev", V.UNKNOWN_PLANT)] == 9
    assert built.where("repeat_reason is not null").count() == 10 and splits.leaking(built).isEmpty()
    assert built.where("source_label_id = 'unknown'").count() == 2810
    labels, attribution = spark.createDataFrame([("PLANT_01",), ("unknown",)], "label_id string"), built.select("photo_id")
    quotas = dataset.quota_table(spark, ["PLANT_01"], {"train": 300, "val": 50, "test": 50}, {"train": 2000, "val": 400, "test": 400})
    assert dataset.violations(built, labels, attribution, quotas, internal=True).isEmpty()
    strict = dataset.violations(built, labels, attribution, quotas)
    assert {r.check for r in strict.collect()} == {"foreign_label", "quota"}
    with pytest.raises(ValueError, match="foreign_label"):
        dataset.validate(strict)
    built.unpersist()


def test_split_errors(spark):
    with pytest.raises(ValueError, match="PLANT_02"):
        splits.build_splits(split_records(spark), ["PLANT_01", "PLANT_02"])
    twice = split_records(spark).withColumn("observation_id", F.lit("same"))
    with pytest.raises(ValueError, match="more than one split"):
        splits.build_splits(twice, ["PLANT_01"])


# --- rendering and evaluation ----------------------------------------------------------------


def test_examples(spark):
    rows = spark.createDataFrame([("PLANT_01", "/i/1.jpg"), ("unknown", "/i/2.jpg"), (V.UNKNOWN_FUNGUS, "/i/3.jpg")], "label_id string, image_path string")
    catalog = rendering.catalog_rows(MANIFEST, internal=True)
    said = [json.loads(r.messages[2].content) for r in rendering.examples(rows, catalog).orderBy("images").collect()]
    assert said[0] == {"label_id": "PLANT_01", "kingdom": "plants", "scientific_name": "Plant species1", "polish_name": "plPLANT1"} and said[2]["label_id"] == V.UNKNOWN_FUNGUS
    short = rendering.examples(rows, catalog, "strict_label_only_with_taxonomy", "label_only", collapse=True).orderBy("images").collect()
    assert short[2].messages[2].content == '{"label_id": "unknown"}' and "Allowed labels:" in short[0].messages[0].content
    assert rendering.ablation(rows, MANIFEST).groupBy("variant").count().count() == 3
    with pytest.raises(Exception, match="unknown label"):
        rendering.examples(spark.createDataFrame([("DOG", "x")], "label_id string, image_path string"), catalog).collect()
    with pytest.raises(FileNotFoundError):
        rendering.examples(rows, catalog, files=spark.createDataFrame([("/i/1.jpg",)], "path string"))
    assert lookups.lookup_strict(rows, readers.literal_catalog(spark, catalog).select("label_id", "kingdom")).count() == 3


def spec_metrics(truth, pred, known):
    domain = sorted({*known, *truth, *pred})
    pairs = Counter(zip(truth, pred, strict=True))
    out = {}
    for label in domain:
        tp = pairs[label, label]
        p_all, t_all = sum(n for (_, p), n in pairs.items() if p == label), sum(n for (t, _), n in pairs.items() if t == label)
        p, r = (tp / p_all if p_all else 0.0), (tp / t_all if t_all else 0.0)
        out[label] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, t_all)
    return out


def test_evaluation(spark):
    rng, known = random.Random(3), ["A", "B", "C", "unknown", "Z"]
    texts = ['{"label_id": "%s"}', 'so {"label_id":"%s"}', "{}", "no", '{"label_id": ""}', '{"label_id": "UNK_OTHER_OR_AMBIGUOUS"}']
    rows = [(f'{{"label_id": "{rng.choice("ABC")}"}}' if rng.random() < 0.8 else '{"label_id": "UNK_NON_TARGET_PLANT"}', rng.choice(texts).replace("%s", rng.choice("ABCQ")), [f"i{k}"], k) for k in range(300)]
    frame = spark.createDataFrame(rows, "labels string, response string, images array<string>, place long")
    out = evaluation.evaluate(frame, spark.createDataFrame([(k, i) for i, k in enumerate(known)], "label string, label_place int")).first()
    pairs = [(r.truth, r.pred) for r in evaluation.scanned(frame).collect()]
    collapsed = [tuple("unknown" if x.startswith("UNK_") else x for x in p) for p in pairs]
    truth, pred = zip(*collapsed, strict=True)
    want = spec_metrics(truth, pred, known)
    assert set(out.per_class) == set(want)
    for k, v in want.items():
        assert tuple(out.per_class[k]) == pytest.approx(v)
    assert out.accuracy == pytest.approx(sum(t == p for t, p in collapsed) / 300)
    assert out.macro_f1_known == pytest.approx(sum(want[k][2] for k in "ABCZ") / 4) and out.macro_f1_all == pytest.approx(sum(v[2] for v in want.values()) / len(want))
    assert out.unknown_recall == pytest.approx(want["unknown"][1])
    assert out.num_examples == 300 and out.valid_json_rate == pytest.approx(sum("{" in r[1] for r in rows) / 300)
    errors = Counter(p for p in collapsed if p[0] != p[1] and p[0] in known)
    assert [e["count"] for e in out.top_confusions] == sorted(errors.values(), reverse=True)[:25]
    bad = [r for r, p in zip(rows, pairs, strict=True) if p[1] in ("invalid_json", "missing_label")]
    assert [e.image for e in out.invalid_examples] == [r[2][0] for r in bad[:50]]


def test_evaluation_of_nothing(spark):
    empty = spark.createDataFrame([], "labels string, response string, images array<string>, place long")
    out = evaluation.evaluate(empty, spark.createDataFrame([("A", 0)], "label string, label_place int")).first()
    assert (out.num_examples, out.valid_json_rate, out.accuracy, out.macro_f1_known, out.top_confusions) == (0, 0.0, 0.0, 0.0, [])


def test_self_test_and_subsets(spark):
    catalog = readers.literal_catalog(spark, rendering.catalog_rows(MANIFEST))
    prompt = rendering.mobile_prompt([m[0] for m in MANIFEST] + ["unknown"])
    adapter = spark.createDataFrame([("a.bin", 5), ("b.bin", 0)], "name string, length long")
    checks = dataset.self_test(catalog, prompt, adapter, ["a.bin", "b.bin"])
    assert metrics.status_summary(checks).first().line == "4 PASS / 1 WARN / 0 FAIL"
    rows = spark.createDataFrame([(0, [], [("assistant", "{}")]), (1, ["a.jpg"], [("user", "x"), ("Assistant", '{"label_id":"PLANT_01"}')])], "place long, images array<string>, messages array<struct<role string, content string>>")
    assert [tuple(r) for r in dataset.test_examples(rows, "/d", 5, ["PLANT_01", "unknown"], {}).collect()] == [("/d/a.jpg", "PLANT_01")]
    parts = {"train": rows, "dev": rows}
    assert set(dataset.smoke_subset(parts, {"train": 1, "dev": 0})) == {"train"}
    kept, counts = dataset.filter_missing(rows, spark.createDataFrame([("b.jpg",)], "path string"), ["place"])
    assert kept.count() == 1 and tuple(counts.first()) == (1, 1, 2)
    assert dataset.malformed(rows).isEmpty()


# --- versions, copies, listings --------------------------------------------------------------


def test_versions(spark, tmp_path, monkeypatch):
    """Whatever step fails, a reader finds the old data or the new; the version before stays."""
    folder = str(tmp_path / "t")
    rows = lambda: sorted(r.id for r in spark.read.schema("id long").json(sinks.current_version(spark, folder)).collect())
    spark.range(3).write.json(folder)
    assert rows() == [0, 1, 2]
    sinks.write_version(spark.read.schema("id long").json(folder).where("id > 0"), folder)
    assert rows() == [1, 2]
    broken = spark.range(9).select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_version(broken, folder)
    assert rows() == [1, 2]
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "write_text", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.write_version(spark.range(5), folder)
    assert rows() == [1, 2]
    before = sinks.current_version(spark, folder)
    sinks.write_version(spark.range(7, 9), folder)
    assert rows() == [7, 8] and spark.read.json(before).count() == 2
    assert len(list((tmp_path / "t/_versions").iterdir())) == 2


def test_copies_are_whole_or_none(spark, tmp_path):
    sources = []
    for i in range(5):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (3 << 20))
        sources.append((str(tmp_path / f"{i}.bin"), f"a/{i % 3}/x{i}"))
    pairs = spark.createDataFrame([*sources, sources[0], (f"file://{tmp_path}/4.bin", "b")], "source string, target string")
    for out in (str(tmp_path / "out"), f"file://{tmp_path}/out"):  # the second time all is there
        assert sorted(map(tuple, sinks.copied_files(pairs, out).collect())) == sorted([(t, 3 << 20) for _, t in sources] + [("b", 3 << 20)])
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["b", "x0", "x1", "x2", "x3", "x4"]
    assert (tmp_path / "out/a/1/x4").read_bytes() == bytes([4]) * (3 << 20)


def test_listing_by_tasks(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"d{i % 7}" / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"d{i % 7}" / ("deep" if i % 2 else "") / f"{i}.txt").write_bytes(b"x" * i)
    (tmp_path / "d0" / "_SUCCESS").write_text("")
    (tmp_path / "d0" / "n.csv").write_text("")
    folders = spark.createDataFrame([(f"{tmp_path}/d{i}",) for i in range(9)], "folder string")
    got = readers.dealt_inventory(spark, folders, "*.txt").collect()
    assert sorted((r.path.rpartition("/")[2], r.length) for r in got) == sorted((f"{i}.txt", i) for i in range(30))
    # Spark's own file source leaves empty files out.
    assert {r.path for r in got if r.length} == {r.path for r in readers.inventory(spark, str(tmp_path), "*.txt").collect()}


def test_rolling_hash(spark):
    """The fold in 32 bits, as a loop makes it."""
    rng = random.Random(14)

    def loop(cells, width, height):
        acc = width * 31 + height
        for y in range(0, height, max(1, height // 6)):
            for x in range(0, width, max(1, width // 6)):
                acc = acc * 31 + cells[y * width + x]
        return (acc + (1 << 31)) % (1 << 32) - (1 << 31)

    rows = [(w, h, [rng.randrange(-(2**31), 2**31) for _ in range(w * h)]) for w, h in [(0, 0), (1, 1), (5, 9), (13, 6), (40, 25)]]
    frame = spark.createDataFrame([(c, w, h) for w, h, c in rows], "cells array<int>, w int, h int")
    got = frame.select("w", C.grid_hash(F.col("cells"), F.col("w"), F.col("h")).alias("s")).collect()
    assert {r.w: r.s for r in got} == {w: loop(c, w, h) for w, h, c in rows}
    labels = spark.createDataFrame([(14,), (-13,), (5,), (-(2**31),)], "s int").select(C.mock_label(F.col("s"), ["a", "b", "c", "unknown"]).alias("l")).collect()
    assert [r.l for r in labels] == ["unknown", "b", "c", "c"]
