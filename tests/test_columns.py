"""Scalar functions against small tables of expected values."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import jsonscan
from sparkurate.operators import rendering, splits


def values(spark, rows, make, ddl="a string"):
    frame = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ddl)
    names = [n for n in frame.columns if n != "i"]
    return [r.v for r in frame.select("i", make(*[F.col(n) for n in names]).alias("v")).orderBy("i").collect()]


def test_licenses(spark):
    texts = ["CC-BY 4.0", "cc_by_nc", "CC0", "all-rights-reserved", "Creative Commons BY", "\tCC0\n", "cc-bync", "cc-by-sa", "cc-by-nc-sa", "CC BY-NC", "", None, "by", "ccbync", "publicdomain"]
    assert values(spark, texts, C.license_text) == ["CC-BY", "CC-BY-NC", "CC0", None, "CC-BY", "CC0", "CC-BY", "CC-BY", "CC-BY-NC", None, None, None, "CC-BY", "CC-BY-NC", "CC0"]
    assert values(spark, texts, C.license_sql) == ["CC-BY", "CC-BY-NC", "CC0", None, None, None, "CC-BY-NC", "CC-BY", "CC-BY-NC", None, None, None, "CC-BY", "CC-BY-NC", "CC0"]


def test_labels_in_text(spark):
    texts = ['{ "label_id" : "moss_7" }', 'First, a look: {"n": 2, "label_id":"fern"} - sure', "{LABEL_ID: lichen_3, n: 1}", "no braces, label_id: x", "}{", "", None]
    assert values(spark, texts, C.label_mobile)[:6] == ["moss_7", "fern", "lichen_3", "unknown", "unknown", "unknown"]
    assert values(spark, [('x {"label_id":"A"} "label_id" : "B"', ""), ("", '"LABEL_ID":"E"'), (None, None)], C.label_desktop, "a string, b string") == ["B", "E", "unknown"]
    assert values(spark, ['{"label_id":"FUN_03', '{"label_id":"', "x"], C.label_prefixed) == ["FUN_03", "", ""]
    assert values(spark, ["unknown", "FUN_20", "FUN_21", "PLANT_00", "UNK_NON_TARGET_PLANT", "FUN_01\n"], C.label_valid) == [True, True, False, False, False, False]


def test_numbers(spark):
    texts = ["0.5", "1.5", "2.5", "-2.5", "12.5", "1e2", "3000000000", "7", "x", None, "", "5d"]
    assert values(spark, texts, C.to_whole) == [1, 2, 3, -3, 13, 100, None, 7, None, None, None, None]
    assert values(spark, ["5d", "1.5", " 2 ", "nan", ".5"], C.to_double)[:3] == [None, 1.5, 2.0]
    assert values(spark, ["5", "0", "x", "-1"], lambda c: C.int_or(c, 9)) == [5, 9, 9, 9]


def test_paths(spark):
    assert values(spark, ["E:\\photos\\images\\moss\\a.b.png", "raw_cache/fern\\7.jpg", "", "/x/images/"], lambda c: C.rebase_path(c, "/srv")) == ["/srv/moss/a.b.png", "/srv/fern/7.jpg", "/srv", "/srv"]
    assert values(spark, ["/a/b/c.jpg", "c.jpg", "/c.jpg"], lambda c: C.portable_path(c, "p/")) == ["p/images/b/c.jpg", "p/images/misc/c.jpg", "p/images/misc/c.jpg"]
    assert values(spark, ["/a", "C:\\x", "b/c"], lambda c: C.resolve_path(c, "/r")) == ["/a", "C:\\x", "/r/b/c"]
    assert values(spark, ["s"], lambda c: C.query_string(("q", F.lit("a b&c")), ("n", c))) == ["q=a%20b%26c&n=s"]


def test_text(spark):
    assert values(spark, ["ąb\x01\n"], C.ascii_only) == ["  b \n"]
    assert values(spark, ["  a \t\n b  ", None], C.compact) == ["a b", ""]
    assert [len(v) for v in values(spark, ["x" * 521, "x" * 520], C.shorten)] == [520, 520]
    assert values(spark, [(None, "Bison")], C.short_description, "a string, b string") == ["Brak opisu z Wikipedii dla Bison."]
    odd = ['q"\\\n', "ł/é", "\u2028\x7f"]
    assert values(spark, odd, lambda c: C.json_object(("k", c), ("l", c))) == [json.dumps({"k": v, "l": v}, ensure_ascii=False) for v in odd]


def test_boxes(spark):
    points = [(34.0, -25.0), (33.9, 0.0), (65.0, -30.0), (None, 1.0)]
    assert values(spark, points, lambda lat, lon: C.in_any_box(lon, lat), "a double, b double")[:3] == [True, False, True]
    assert values(spark, [(49.0, 14.05), (49.0, 14.0), (None, 15.0)], lambda lat, lon: C.in_priority_region(lon, lat), "a double, b double") == [True, False, False]


def spec_first_object(text):
    """The rule in its plain form: from each brace on, the first balanced span."""
    text = text.strip()
    try:
        whole = json.loads(text)
        return whole if isinstance(whole, dict) else None
    except ValueError:
        pass
    for start, c in enumerate(text):
        if c != "{":
            continue
        depth = 0
        for end in range(start, len(text)):
            depth += (text[end] == "{") - (text[end] == "}")
            if depth == 0:
                try:
                    return json.loads(text[start : end + 1])
                except ValueError:
                    break
    return None


@settings(max_examples=500, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["{", "}", '"a"', ":", "1", ",", " ", "[", "]", '{"label_id":"X"}', "x", '"{"']), max_size=14).map("".join))
def test_first_object_matches_its_rule(text):
    assert jsonscan.first_object(text) == spec_first_object(text)


def test_labels_of_objects():
    found = {t: jsonscan.label_in(jsonscan.first_object(t)) for t in ("{}", "[1]", '{"label_id": 7}', '{"label_id":"a","label_id":" b "}', '{"a":1} tail', '{bad} {"label_id":"X"}', "", '{"label_id": NaN}')}
    assert list(found.values()) == ["invalid_json", "invalid_json", "missing_label", "b", "missing_label", "X", "invalid_json", "missing_label"]


def test_allocation_golden():
    first = splits.allocate({"p": 2742, "f": 458}, 2000)
    assert first == {"p": 1714, "f": 286}
    assert splits.allocate({"p": 1028, "f": 172}, 400) == {"p": 343, "f": 57}
    assert splits.allocate({"a": 1}, 0) == {"a": 0}
    with pytest.raises(ValueError):
        splits.allocate({"a": 1}, 2)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 50), min_size=1), st.data())
def test_table_allocation_is_the_same(spark, capacities, data):
    need = data.draw(st.integers(0, sum(capacities.values())))
    capacities = dict(sorted(capacities.items()))
    frame = spark.createDataFrame(list(capacities.items()), "label string, capacity long")
    assert {r.label: r.share for r in splits.allocation(frame, need).collect()} == splits.allocate(capacities, need)


def test_prompts():
    manifest = [("moss_1", "plants", "Moss maior", "mech", "great moss")]
    public, training = rendering.catalog_rows(manifest), rendering.catalog_rows(manifest, internal=True)
    lines = rendering.system_prompt("strict_label_only_with_taxonomy", training).split("\n")[6:]
    assert lines[0] == "- moss_1 = Moss maior" and lines[1].endswith("(collapse to public unknown outside training)") and "UNK_*" in lines[-1]
    assert rendering.render("desktop", 1, public).endswith("Allowed labels:\n- moss_1 = Moss maior")
    assert rendering.system_prompt("strict_label_only_with_taxonomy", public).count("\n") == 7
    assert "Allowed labels:" in rendering.system_prompt("strict_label_only_with_taxonomy", public)
    with pytest.raises(ValueError):
        rendering.system_prompt("other", public)
