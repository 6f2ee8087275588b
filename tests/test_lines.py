"""Records that span lines, headers of each file, and places in file order, in files split anywhere."""

import csv
import gzip
import json
import random

import duckdb
import pytest

from sparkurate import schemas
from sparkurate.sources import lines, readers


@pytest.fixture(params=["128m", "40"])
def splits(spark, request):
    """Files whole, and split every forty bytes."""
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "0" if request.param == "40" else "4m"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def test_quoted_line_ends(spark, tmp_path, splits):
    (tmp_path / "t.csv").write_text('id,name\n1,"a\nb"\n2,c\n3,"x,""y"""\n4\n5,"p\n\n\nq ""z"", r"\n6,5" pipe\n7,"s",t\n')
    got = readers.read_untyped(spark, str(tmp_path / "t.csv"), schemas.strings("id", "name")).collect()
    assert sorted(map(tuple, got)) == [("1", "a\nb"), ("2", "c"), ("3", 'x,"y"'), ("5", 'p\n\n\nq "z", r'), ("6", '5" pipe')]


def test_random_records(spark, tmp_path, splits):
    """What the csv module writes is what comes out, in any splits; so says DuckDB."""
    rng = random.Random(9)
    rows = [(str(i), "".join(rng.choice(['a', 'é', '"', "\n", ",", " ", ";", "bc"]) for _ in range(rng.randrange(1, 30))) + "x", rng.choice(["k", "l m"])) for i in range(90)]
    with open(tmp_path / "t.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("id", "text", "kind"), *rows])
    got = readers.read_untyped(spark, str(tmp_path / "t.csv")).collect()
    assert sorted(map(tuple, got)) == sorted(rows)
    theirs = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/t.csv', header=true, all_varchar=true, delim=',', quote='\"', escape='\"')").fetchall()
    assert sorted(theirs) == sorted(rows)


def test_headers_of_each_file(spark, tmp_path, splits):
    (tmp_path / "s-1.csv").write_text('id,name\n1,one\n')
    (tmp_path / "s-2.csv").write_text('name,id,"more"\ntwo,2,x\n"thr\nee",3,y\n')
    (tmp_path / "s-3.csv").write_text('name,id\n"li""ne",4\n')
    (tmp_path / "s-4.csv").write_text('name;"other\nname";id\nz;;5\n')
    (tmp_path / "s-5.csv").write_text("")
    with gzip.open(tmp_path / "s-6.csv.gz", "wt") as file:
        file.write('id,name\n6,"s\r\nix"\n')
    files = readers.find_files(str(tmp_path), "s", all_shards=True) + [str(tmp_path / "s-6.csv.gz")]
    got = readers.read_untyped(spark, files, schemas.strings("id", "name", "more", "none")).collect()
    assert sorted(map(tuple, got), key=str) == [("1", "one", None, None), ("2", "two", "x", None), ("3", "thr\nee", "y", None), ("4", 'li"ne', None, None), ("5", "z", None, None), ("6", "s\r\nix", None, None)]
    assert readers.read_untyped(spark, str(tmp_path / "s-5.csv"), schemas.strings("id")).collect() == []


def test_unclosed_quotes(spark, tmp_path, monkeypatch):
    """A quote that is never closed is one malformed record to the end of its file, and no more than that."""
    (tmp_path / "a.csv").write_text('id,name\n1,"a\nb"\n2,"open\n3,c\n')
    (tmp_path / "b.csv").write_text("id,name\n4,d\n")
    got = readers.read_untyped(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv")]).collect()
    assert {("1", "a\nb"), ("4", "d")} <= set(map(tuple, got)) and not any(r.id == "3" for r in got)
    monkeypatch.setattr(lines, "LONGEST_RECORD", 8)
    got = readers.read_untyped(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(map(tuple, got)) == [("1", "a\nb")]


def test_line_numbers(spark, tmp_path, splits):
    rng, want = random.Random(10), []
    for k in range(4):
        values = [json.dumps({"v": f"{k}-{i}"}) if rng.random() < 0.8 else rng.choice(["", "  "]) for i in range(12 * (k != 2))]
        (tmp_path / f"{k}.jsonl").write_text("\n".join(values) + ("\n" if k % 2 and values else ""))
        want += [(k, i + 1, v) for i, v in enumerate(values)]
    want = [(k, i, p + 1, v) for p, (k, i, v) in enumerate(want)]
    got = lines.numbered(spark, str(tmp_path)).collect()
    assert sorted((int(r.file[-7]), r.line, r.place, r.value) for r in got) == want
    filled = [json.loads(v)["v"] for *_, v in want if v.strip()]
    for n in (1, 7, len(filled)):
        first = readers.first_json_lines(spark, str(tmp_path), schemas.strings("v"), n).orderBy("place").collect()
        assert [(r.place, r.v) for r in first] == [(i + 1, v) for i, v in enumerate(filled[:n])]
    for n in (0, len(filled) + 1):
        with pytest.raises(ValueError):
            readers.first_json_lines(spark, str(tmp_path), schemas.strings("v"), n)
    ordered = readers.read_json_lines_in_order(spark, str(tmp_path), schemas.strings("v")).orderBy("place").collect()
    assert [r.v for r in ordered] == filled
