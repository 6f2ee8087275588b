"""Each training-data operator against a library, a brute-force version or an exact round trip, and its edge cases."""

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkurate.llm import bpe, common, langid, lm, mixing, mpeg, quality, queries, tokencount, toxicity, wrappers

from ..conftest import DATA

DDL = "doc_id long, text string, lang string, source string"
LONG = "lorem ipsum Dolor sit amet " * 20_000
#: Nulls in any column, empty and very long texts, repeated rows, odd characters.
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, LONG, "en", None), (3, LONG, "en", None), (None, "no id here", None, "a"), (5, " \t\r\n\x0b", "en", "a"), (6, "ł é 中文 \U0001f600 don't 12,345", "en", "a"), (7, "x" * 5000, "de", "a"), (8, "\x00\x85\xa0  a", "de", "b")]


def frame(spark, rows):
    """Rows with a further column whose name an operator uses itself."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, DDL)
    for name in ("score", "n", "rep", "copies", "token", "_row"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n))


# --- oracle SQL ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/sf0.01/documents.parquet'")
    ours, theirs = queries.queries()[name](spark, f"{DATA}/sf0.01").toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = [sorted(tuple(str(v) for v in r) for r in f[columns].itertuples(index=False)) for f in (ours, theirs)]
    assert rows[0] == rows[1]


# --- op1 -------------------------------------------------------------------------------------


def test_quality_measures():
    assert quality.measure("a b c a b c d") == (7, 7, 0, 0, 6, 1)
    assert quality.measure("x y\nx y\n\n x y\nx y") == (8, 8, 0, 2, 8, 4)
    assert quality.measure("a a a a #$ |") == (6, 7, 3, 0, 4, 1)
    assert quality.measure("") == (0, 0, 0, 0, 0, 0)


def spec_repeats(ws):
    n = Counter(zip(ws, ws[1:], ws[2:]))
    return len({p + s for p in range(len(ws) - 2) if n[tuple(ws[p : p + 3])] > 1 for s in range(3)})


def test_repeated_words_match_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        ws = [rng.choice("abc") for _ in range(rng.randrange(0, 30))]
        assert quality.repeated_words(ws) == spec_repeats(ws)


def test_sketches_merge_exactly(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(50, 90)) + " #" * rng.randrange(0, 9), rng.choice(["en", "de"]), rng.choice("ab")) for i in range(200)]
    whole = quality.sketches(quality.measures(frame(spark, rows)))
    parts = quality.sketches(quality.measures(frame(spark, rows[:77]))).union(quality.sketches(quality.measures(frame(spark, rows[77:]))))
    assert sorted(map(tuple, quality.merge(whole, "lang").collect())) == sorted(map(tuple, quality.merge(parts, "lang").collect()))
    kept = {r.doc_id: r for r in quality.judge(frame(spark, [*rows, (999, " ".join(w + "#%&" for w in rows[0][1].split()), "en", "a")])).collect()}
    assert not kept[999].kept and not kept[999].base_failed and sum(r.kept for r in kept.values()) == 200


def test_fences_follow_their_group(spark):
    """Each fence is the plain formula over its own group's values; the same text is judged by its source."""
    rng = random.Random(21)
    code = [(i, words(rng, 60) + " #" * rng.randrange(10, 30), "en", "code") for i in range(120)]
    prose = [(i, words(rng, 60) + " #" * (rng.random() < 0.1), "en", "prose") for i in range(200, 320)]
    both = [(i, words(rng, 60) + " #" * 25, "en", s) for i, s in ((900, "code"), (901, "prose"))]
    got = {r.doc_id: r for r in quality.judge(frame(spark, code + prose + both)).collect()}
    assert got[900].kept and not got[901].kept

    def plain(rows, rate, event, length):
        made = [dict(zip(quality.MEASURES, quality.measure(t), strict=True)) for _, t, *_ in rows]

        def quartile(values, k):  # the least value that k quarters of all are up to, as its bucket has it
            x = sorted(values)[math.ceil(len(values) * k / 4) - 1]
            return x if x < 64 else x >> (x.bit_length() - 6) << (x.bit_length() - 6)

        values = [rate(m) for m in made]
        spread = max(quartile(values, 3) - quartile(values, 1), 1000 * event // quartile([m[length] for m in made], 2))
        return quartile(values, 3) + quality.REACH * spread

    for rows, r in ((code + both[:1], got[900]), (prose + both[1:], got[901])):
        assert r.symbols_fence == plain(rows, lambda m: 1000 * m["n_symbols"] // m["n_words"], 1, "n_words")
        assert r.repeats_fence == plain(rows, lambda m: 1000 * m["n_repeat_words"] // m["n_words"], 6, "n_words")
        assert r.dup_lines_fence == plain(rows, lambda m: 1000 * m["n_dup_lines"] // m["n_lines"], 1, "n_lines")
        assert r.word_length_fence == plain(rows, lambda m: 1000 * m["word_chars"] // m["n_words"], 1, "n_words")


def test_quality_edges(spark):
    got = quality.judge(frame(spark, ODD)).collect()
    assert len(got) == len(ODD) and all(r.base_failed and not r.kept for r in got)
    assert quality.judge(frame(spark, [])).collect() == []


# --- op2 -------------------------------------------------------------------------------------


def test_language_held_out(spark):
    got = queries.queries()["op2_language_id"](spark, f"{DATA}/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_pieces_and_edges(spark, monkeypatch):
    text = "Ébène straße o'neil 123 xyz " * 50
    monkeypatch.setattr(langid, "PIECE", 64)
    pieces = np.bincount(langid.grams(text), minlength=langid.BUCKETS)
    monkeypatch.setattr(langid, "PIECE", 1 << 30)
    assert (np.bincount(langid.grams(text), minlength=langid.BUCKETS) == pieces).sum() > 0.9 * langid.BUCKETS
    model = langid.train(frame(spark, ODD))
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(frame(spark, ODD), model).collect()}
    assert {(1, "und"), (2, "und"), (5, "und")} <= got and (3, "en") in got
    nothing = langid.train(frame(spark, []))
    assert [r.lang_pred for r in langid.predict(frame(spark, ODD[:3]), nothing).collect()] == ["und"] * 3
    assert langid.predict(frame(spark, []), model).collect() == []


def test_language_batches_match_plain_bayes(monkeypatch):
    """A batch of texts, also cut into many, has the scores of a loop over each text's n-grams."""
    rng = random.Random(41)
    counts = np.random.default_rng(1).integers(0, 50, (20, langid.BUCKETS)).astype(float)
    model = langid.Model([f"l{k}" for k in range(20)], counts, np.arange(20.0))
    texts = [words(rng, rng.randrange(0, 40)) if i % 5 else (None, "", "12 34", "a", "łódź " * 3000)[i // 5 % 5] for i in range(60)]
    plain = []
    for t in texts:
        grams = langid.grams(t or "")
        if not len(grams):
            plain.append(("und", 0.0))
            continue
        log_p = np.log((counts + langid.SMOOTHING) / (counts + langid.SMOOTHING).sum(axis=1, keepdims=True))
        s = log_p[:, grams].sum(axis=1) + model.prior
        plain.append((f"l{s.argmax()}", 1 / np.exp(s - s.max()).sum()))
    for cells in (1 << 18, 100):
        monkeypatch.setattr(langid, "CELLS", cells)
        got = model.predict(texts)
        assert [a for a, _ in got] == [a for a, _ in plain] and [b for _, b in got] == pytest.approx([b for _, b in plain], rel=1e-3)


def test_language_matrix_is_bounded(spark, monkeypatch):
    """Many languages have fewer counters each; none is left out."""
    assert [langid.buckets_for(n) for n in (0, 1, 256, 257, 1 << 30)] == [1 << 15, 1 << 15, 1 << 15, 1 << 14, 1]
    rng = random.Random(43)
    letters = [chr(c) for c in range(0x4E00, 0x9000)]
    rows = [(k, "".join(rng.choice(letters) for _ in range(300)), f"l{k:04}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.languages) == 1200 and model.log_p.shape == (4096, 1200)
    assert all(r.lang_pred == f"l{r.doc_id:04}" for r in langid.predict(docs, model).collect())
    monkeypatch.setattr(langid, "BROADCAST_LANGUAGES", 10)
    assert np.array_equal(langid.train(docs).log_p, model.log_p)


# --- op3 -------------------------------------------------------------------------------------


def test_audio_query_holds_its_contract(spark, tmp_path):
    """Each digest against hashlib and zlib over the text's own bytes; offsets and durations against the stored stream."""
    frame(spark, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    media = {(r.doc_id, hashlib.sha256(r.media).hexdigest()): bytes(r.media) for r in mpeg.encode(frame(spark, ODD)).collect()}
    got = queries.queries()["op3_mpeg_audio"](spark, str(tmp_path)).collect()
    texts = defaultdict(list)
    for i, t, *_ in ODD:
        texts[i].append((t or "").encode())
    assert len(got) == len(ODD)
    for r in got:
        raw = texts[r.doc_id][0]
        payload = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        stream = media[r.doc_id, r.media_sha256]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes) == (zlib.crc32(payload[-32:]), len(stream))
        headers = [mpeg.header(stream[o : o + 4]) for o in r.frame_offsets]
        assert all(headers) and r.duration_samples == sum(h.samples for h in headers) and {r.sample_rate} == {h.rate for h in headers}
        assert len(headers) == len(payload) // 576 and r.feature == next(x.feature for x in got if x.payload_sha256 == r.payload_sha256)


def test_tags_of_any_number_of_frames():
    frames = b"".join(b"TXXX" + (len(x) + 1).to_bytes(4, "big") + b"\0\0\0" + x for x in (f"k{i}\0v{i}".encode() for i in range(3000)))
    size = len(frames)
    tag = b"ID3\3\0\0" + bytes(size >> s & 127 for s in (21, 14, 7, 0)) + frames
    assert len(mpeg.scan(tag + mpeg.write(b"x"))["tags"]) >= 3000



def test_media_round_trip(spark):
    for r in mpeg.media_columns(mpeg.encode(frame(spark, ODD))).collect():
        raw = next((t or "") for i, t, *_ in ODD if i == r.doc_id).encode()
        a = r.audio
        assert a.payload == mpeg.pad(raw) and a.tags["TXXX:payload_bytes"] == str(len(raw))
        assert (a.n_frames, a.n_samples, a.crc_failed, a.resyncs, a.skipped_bytes, a.table_ok, a.table) == (len(a.payload) // 576, 1152 * a.n_frames, 0, 0, 0, True, "Xing")
        assert a.vbr == (a.n_frames >= mpeg.RICH_EVERY) and all(mpeg.header(bytes(r.media[o : o + 4])) for o in a.offsets)


def test_media_damage():
    good = mpeg.write(b"payload " * 2000)
    found = mpeg.scan(good)
    broken = bytearray(good)
    broken[found["offsets"][5] + 9] ^= 0x40
    assert mpeg.scan(bytes(broken))["crc_failed"] == 1
    at = found["offsets"][7]
    noisy = mpeg.scan(good[:at] + b"\xff\xfb\xe0junk\xff" + good[at:])
    assert (noisy["n_frames"], noisy["resyncs"], noisy["skipped_bytes"], noisy["table_ok"]) == (found["n_frames"], 1, 8, False)
    cut = mpeg.scan(good[: found["offsets"][-1] + 100])
    assert cut["n_frames"] == found["n_frames"] - 1 and cut["skipped_bytes"] == 100
    assert mpeg.scan(b"")["n_frames"] == 0 and mpeg.scan(b"no audio \xff\xe0 at all")["n_frames"] == 0
    two = mpeg.scan(good + good)
    assert two["n_frames"] >= 2 * found["n_frames"] and two["tags"]["TXXX:payload_bytes"] == "16000"


def test_media_headers():
    cases = {"fffb9064": (3, 417, 1152, 44100), "fffd9064": (2, 522, 1152, 44100), "ffff9064": (1, 312, 384, 44100), "fff39064": (3, 261, 576, 22050), "ffe39064": (3, 522, 576, 11025)}
    for raw, (layer, size, samples, rate) in cases.items():
        h = mpeg.header(bytes.fromhex(raw))
        assert (h.layer, h.size, h.samples, h.rate) == (layer, size, samples, rate)
    for raw in ("fffbf064", "fffb0064", "fffb9c64", "ffeb9064", "fff99064", "fefb9064"):
        assert mpeg.header(bytes.fromhex(raw)) is None


# --- op4 -------------------------------------------------------------------------------------


def lm_tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), b"\n"]


def spec_lm(train):
    """The model by its formulas: counts in dictionaries, probabilities by recursion."""
    grams = Counter(tuple(x[i : i + k]) for x in train for k in (1, 2, 3) for i in range(len(x) - k + 1))
    n, v = sum(map(len, train)), sum(len(g) == 1 for g in grams)

    def mass(k):
        octaves = defaultdict(list)
        for g, c in grams.items():
            if len(g) == k - 1 and g != (b"\n",):
                octaves[c.bit_length()].append(c)
        once = sum(c == 1 for g, c in grams.items() if len(g) == k)
        low, high = -6.0, 30.0
        for _ in range(60):
            m = math.exp((low + high) / 2)
            if sum(sum(x) * m / (sum(x) / len(x) - 1 + m) for x in octaves.values()) < once:
                low = (low + high) / 2
            else:
                high = (low + high) / 2
        return math.exp(high)

    m = {k: mass(k) for k in (2, 3)}

    def p(word, context):
        if not context:
            return (grams[word,] + 0.5) / (n + 0.5 * (v + 1))
        k = len(context) + 1
        return (grams[*context, word] + m[k] * p(word, context[1:])) / (grams[context] + m[k])

    return grams, n, v, p


@pytest.mark.parametrize("sizes", [(8 << 20, 4 << 20), (300, 64)])
def test_lm_matches_its_formulas(spark, sizes):
    """One chunk and one bucket, or many of both: every text has the score of the formulas."""
    rng = random.Random(4)
    train = [(i, " ".join(rng.choice("a b c d e f g h i j k l m zażółć".split()) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    train += [(i, " ".join(f"w{k}" for k in random.Random(i).sample(range(2000), 2000))) for i in (70, 71)] + [(72, "rare qq rr\x0bss"), (73, "x" * 3000)]
    test = [*train[30:], (900, "zz a b a b NEW A B"), (901, None), (901, None), (902, "qq rr ss w1 qq rr zz"), (903, "ZAŻÓŁĆ x")]
    marked = frame(spark, [(*r, k, None) for k, rows in (("train", train), ("test", test)) for r in rows]).withColumn("held", F.col("lang") == "train")
    got = defaultdict(list)
    for r in lm.score(marked, "held", *sizes).collect():
        got[r.doc_id].append(r)
    grams, n, v, p = spec_lm([lm_tokens(t) for _, t in train])
    for i, text in test:
        found = lm_tokens(text)
        total = sum(math.log10(p(t, tuple(found[max(0, k - 2) : k]))) for k, t in enumerate(found))
        base = sum(math.log10((grams[t,] + 0.5) / (n + 0.5 * (v + 1))) for t in found)
        for r in got[i]:
            assert r.score == pytest.approx(total, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(found), sum(grams[t,] > 0 for t in found), n)
    assert len(got[901]) == 2 and sum(map(len, got.values())) == len(train) + len(test)


def test_lm_parts_of_a_text_carry_its_state():
    """Parts of any size, with lanes of any length, have the sums of the whole text's traversal."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("a b c d e zażółć Q".split()) for _ in range(rng.randrange(400))).encode() for _ in range(20)] + [b"", b" \t a", b"a " + b" " * 900 + b"b"]
    mass = {2: 1.7, 3: 0.6}
    whole = lm.Traversal(texts)
    counts = whole.own_counts(np.arange(len(texts)) % 2 == 0)
    plain = whole.scores(counts, 900, 8, mass)
    learned = dict(zip(whole.keys.tolist(), counts.tolist(), strict=True))
    for size in (1, 7, 50, 5000):
        parts = [(i, part, lead, part_of) for i, t in enumerate(texts) for part_of, (part, lead) in enumerate(lm.text_parts(t, size))]
        last = [k + 1 == len(parts) or parts[k + 1][0] != parts[k][0] for k in range(len(parts))]
        of = np.array([i for i, *_ in parts])
        path = lm.Traversal([p for _, p, *_ in parts], np.array([lead for *_, lead, _ in parts]), np.array(last))
        assert np.array_equal(path.own_counts(of % 2 == 0), np.array([learned[k] for k in path.keys.tolist()], np.uint64))
        got = path.scores(np.array([learned[k] for k in path.keys.tolist()], np.uint64), 900, 8, mass)
        for a, b in zip(got, plain, strict=True):
            assert np.bincount(of, a, minlength=len(texts)) == pytest.approx(b, rel=1e-9)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 90, 5000):
        for top in (1, 2, 300, 1 << 44, (1 << 64) - 1):
            numbers = rng.integers(0, top, n, np.uint64, endpoint=True)
            assert np.array_equal(lm.unpacked(lm.packed(numbers), n), numbers)


def test_lm_lanes_carry_the_state(monkeypatch):
    texts = [" ".join(random.Random(i).choices("abcdef", k=300)).encode() for i in range(5)]
    path = lm.Traversal(texts)
    counts = path.own_counts(np.array([True, True, False, False, True]))
    plain = path.scores(counts, 903, 7, {2: 2.0, 3: 0.5})
    for lane in (3, 10, 299):
        monkeypatch.setattr(lm, "LANE", lane)
        assert path.scores(counts, 903, 7, {2: 2.0, 3: 0.5})[3] == pytest.approx(plain[3], rel=1e-12)


def test_lm_scores_stay_if_the_input_is_split_anew(spark, tmp_path):
    """Another split of the files between score() and the action: the chunks are the written ones."""
    rng = random.Random(9)
    frame(spark, [(i, words(rng, 40, "abcdefgh"), "en", "a") for i in range(400)]).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("train", F.col("doc_id") % 3 > 0)
    plain = {r.doc_id: r.score for r in lm.score(docs, "train").collect()}
    key = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(key, 4)
    try:
        later = lm.score(docs, "train", 2000, 2000)
        spark.conf.set(key, 2)
        assert {r.doc_id: r.score for r in later.collect()} == pytest.approx(plain, rel=1e-9)
    finally:
        spark.conf.unset(key)


def test_lm_probabilities_sum_to_one():
    rng = random.Random(5)
    train = [lm_tokens(" ".join(rng.choice("abcde") for _ in range(rng.randrange(30)))) for _ in range(40)]
    grams, *_, p = spec_lm(train)
    words = {g[0] for g in grams if len(g) == 1} | {b"unknown"}
    for context in [(), (b"a",), (b"a", b"b"), (b"e", b"e")]:
        assert sum(p(w, context) for w in words) == pytest.approx(1)


def test_lm_query_holds_its_contract(spark, tmp_path):
    """The query on a written table: held-out rows teach nothing; counts by a plain version."""
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randrange(30), "abc"), "en", "a") for i in range(80)] + ODD
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op4_lm_scoring"](spark, str(tmp_path)).collect()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, *_ in rows}
    train = [lm_tokens(t) for i, t, *_ in rows if not held[i]]
    known = {t for x in train for t in x}
    plain = sorted((str(i), held[i], len(lm_tokens(t)), sum(w in known for w in lm_tokens(t)), sum(map(len, train))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == plain
    assert all(r.score <= 0 and r.base_score <= 0 for r in got)


def test_lm_edges(spark):
    got = lm.score(frame(spark, ODD).withColumn("held", F.lit(False)), "held").collect()
    assert len(got) == len(ODD) and all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert lm.score(frame(spark, []).withColumn("held", F.lit(True)), "held").collect() == []


# --- op5 -------------------------------------------------------------------------------------


def page(i, extra="", body=None):
    body = body or "".join(f"<p>Paragraph {k} of page {i} &amp; more&nbsp;text.\n  Next</p>" for k in range(i % 3 + 1))
    return (
        f"<html><head><title>T{i}</title><script>if(a<b){{x('</p>')}}</script></head><body><header>Site</header><nav><ul><li><a href=/>Home</a><li>About</ul></nav>"
        f"<div class=notice>Cookies!</div><article class='post-{i}'><h1>Title {i}</h1>{body}<div class='share-box'>Share</div><form>Mail<input></form>{extra}</article>"
        f"<aside>Side {i}</aside><div id=comments><p>Nice {i}</p></div><!-- <p>no</p> --><footer>(c)</footer></body></html>"
    )


def test_wrappers_find_the_article(spark):
    rows = [(i, f"https://h{i % 2}.example/{i}", page(i)) for i in range(12)] + [(99, None, None), (98, "https://h0.example/x", ""), (97, "not a url", "plain <b>text</b> only")]
    f = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in wrappers.extract(f, wrappers.infer(f)).collect()}
    for i in range(12):
        want = [f"Title {i}"] + [f"Paragraph {k} of page {i} & more text. Next" for k in range(i % 3 + 1)]
        assert got[i].text == "\n\n".join(want) and got[i].n_chars == len(got[i].text)
    assert (got[99].text, got[98].text, got[97].text) == ("", "", "plain text only")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert wrappers.extract(empty, wrappers.infer(empty)).collect() == []


def test_template_text_in_the_article_goes(spark):
    rows = [(i, "https://h.example/", page(i, extra="<div>Read on in our shop</div>")) for i in range(24)]
    f = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all("shop" not in r.text and f"Title {r.page_id}" in r.text for r in wrappers.extract(f, wrappers.infer(f)).collect())
    same = spark.createDataFrame([(i, "https://h.example/", page(1)) for i in range(24)], "page_id long, url string, html string")
    assert all("Title 1" in r.text for r in wrappers.extract(same, wrappers.infer(same)).collect())


def test_text_of_copied_pages_stays(spark):
    """A block that only a page and its copy have is theirs, not the template's."""
    rows = [(i, f"https://h.example/{i}", page(i, extra="<div>Read on in our shop</div>")) for i in range(24)]
    quoted = page(50, extra="<blockquote>Only here</blockquote>")
    rows += [(50, "https://h.example/50", quoted), (51, "https://h.example/51", quoted.replace("<title>", "<link rel=canonical href=/50><title>"))]
    f = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(f, wrappers.infer(f)).collect()}
    assert got[50].endswith("Only here") and got[51] == got[50] and not any("shop" in t for t in got.values())


@pytest.mark.parametrize("n", [3, 60, 200, 2_000, 20_000, 300_000])
def test_different_pages_are_counted_at_every_size(n):
    """Copies count once, parts add up, and no number of pages fills the bitmaps."""
    whole = half = 0
    for i in range(n):
        bit = wrappers.page_bit([("article/p", f"page {i}", 0), ("nav/a", f"link {i % 7}", 1)])
        whole |= bit
        half |= bit if i % 2 else 0
    assert wrappers.different_pages(whole) == pytest.approx(n, rel=0.3, abs=1) and wrappers.different_pages(half) == pytest.approx(n / 2, rel=0.3, abs=1)
    assert wrappers.bits_of(wrappers.levels_of(whole)) == whole


@pytest.mark.parametrize("n", [200, 3_000])
def test_text_of_a_few_articles_stays_on_hosts_of_any_size(spark, n):
    """A block on 5 of a hundred articles is theirs, one on 40 of a hundred is the template's."""
    extra = lambda i: "<blockquote>Said by a few</blockquote>" if i % 20 == 7 else "<blockquote class=shop>Read on in our shop</blockquote>" if i % 5 < 2 else ""
    rows = [(i, "https://h.example/", page(i, extra=extra(i))) for i in range(n)]
    f = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in wrappers.extract(f, wrappers.infer(f)).collect():
        assert ("Said by a few" in r.text) == (r.page_id % 20 == 7) and "shop" not in r.text and f"Title {r.page_id}" in r.text


def test_paths_outside_the_main_text():
    for path in ("nav/ul/li", "header/p", "div#comments/p", "main/aside/p", "div.ad", "article/footer/p", "article/div.ad"):
        assert wrappers._aside(path), path
    for path in ("article.has-sidebar/p", "div.with-sidebar/main/p", "div.content/p", "article/div.download/p", "article/header/h1", "article/section.related-work/p", "article/div.copyright-law/p"):
        assert not wrappers._aside(path), path


def test_unclosed_elements_lose_nothing():
    for name in ("button", "select", "object", "svg", "textarea", "script", "iframe"):
        got = [t for _, t, _ in wrappers.blocks(f"<p>one</p><{name}>go<p>two</p><p>three</p>")]
        assert got == ["one", "two", "three"], name
        assert [t for _, t, _ in wrappers.blocks(f"<p>one</p><{name}>go</{name}><p>two</p>")] == ["one", "two"], name
    assert [t for _, t, _ in wrappers.blocks("<button>a<p>x</p><button>b</button><p>y</p>")] == ["x", "y"]


def wrapper_of(stream):
    return [wrappers.Node(s, r, False, [(1, 1, 1, 0, 0, 1)] * len(s), 1) for s, r, _, _ in wrappers.fold(list(stream))]


def test_alignment():
    assert wrappers.expression(wrapper_of("abbcdcd")) == "(a) (b)+ (c d)+"
    assert wrappers.expression(wrappers.align(wrapper_of("abbc"), wrapper_of("abxc"))) == "(a) (b)+ (x)? (c)"
    assert wrappers.expression(wrappers.align(wrapper_of("ac"), wrapper_of("abbc"))) == "(a) (b)* (c)"


def test_wrappers_match_every_stream_they_come_from():
    """As a plain regular expression, a wrapper matches each of its pages; alignments are common subsequences."""
    rng = random.Random(13)
    for _ in range(300):
        streams = ["".join(rng.choice("abcde") for _ in range(rng.randrange(0, 12))) for _ in range(rng.randrange(1, 5))]
        whole = wrapper_of(streams[0])
        for stream in streams[1:]:
            whole = wrappers.align(whole, wrapper_of(stream))
        expression = wrappers.expression(whole).replace(" ", "")
        assert all(re.fullmatch(expression, x) for x in streams), (streams, expression)
    for size in (10, 300):
        for letters in ("ab", "abcdefgh", [str(i) for i in range(400)]):
            one, other = ([rng.choice(letters) for _ in range(size)] for _ in range(2))
            found = wrappers.common_places(one, other)
            assert all(one[i] == other[j] for i, j in found) and all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:], strict=False))
            if size == 10:
                best = [[0] * 11 for _ in range(11)]
                for i in range(10):
                    for j in range(10):
                        best[i + 1][j + 1] = best[i][j] + 1 if one[i] == other[j] else max(best[i][j + 1], best[i + 1][j])
                assert len(found) >= best[10][10] - 3


NAMES = ["x1", "x2", "x3", "x4", "x5"]


def neutral_page(rng, i, shop):
    """A page whose names say nothing, and the main text that it was made from."""
    menu = "".join(f"<li><a href=/{k}>{words(rng, 2)}</a>" for k in range(rng.randrange(3, 8)))
    parts = [("h1", words(rng, 4))] + [(rng.choice(["p", "p", "p", "blockquote", "h2"]), words(rng, rng.randrange(12, 40))) for _ in range(rng.randrange(3, 9))]
    body = "".join(f"<{n}>{t}</{n}>" for n, t in parts)
    page = f"<title>{words(rng, 3)}</title><div class=x1><ul>{menu}</ul></div><div class=x2>{words(rng, 6)}</div><div class=x3 id=k{i}>{body}<div class=x4>{shop}</div></div><div class=x5><p>{words(rng, 5)}</p></div>"
    return page, "\n\n".join(t for _, t in parts)


def test_inference_alone_finds_the_article(spark, tmp_path):
    """The query against the texts that pages were made from: neutral names, several hosts, copies, odd rows."""
    rng = random.Random(31)
    made = {i: (f"https://h{i % 3}.example/{i}", *neutral_page(rng, i, f"Read on in our shop {i % 3}")) for i in range(90)}
    rows = [(i, url, html) for i, (url, html, _) in made.items()]
    rows += [(500, made[0][0], made[0][1]), (7, *made[7][:2]), (600, None, None), (601, "https://h0.example/", "")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("host", "text", "salt", "matching", "shape", "part"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.queries()["op5_html_extraction"](spark, str(tmp_path)).collect()
    want = {i: text for i, (_, _, text) in made.items()} | {500: made[0][2], 600: "", 601: ""}
    assert len(got) == len(rows) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_long_pages_and_many_shapes(spark, monkeypatch):
    """A page of 20,000 different blocks, and more shapes than a task aligns: in three levels here."""
    rng = random.Random(32)
    long = "<article>" + "".join(f"<div class=c{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}><p>paragraph {k}</p></div>" for k in range(20_000)) + "</article>"
    deep = "<article>" + "<div>" * 30_000 + "deep down" + "</div>" * 30_000 + "<p>after</p></article>"
    rows = [(1, "https://long.example/", long), (2, "https://deep.example/", deep)]
    rows += [(10 + i, "https://h.example/", f"<nav>Menu</nav><article><h1>T{i}</h1>" + "".join(f"<{rng.choice(['p', 'pre', 'h2', 'blockquote', 'ul'])}>part {k} of {i}" for k in range(9)) + "</article>") for i in range(300)]
    f = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = common.materialize(wrappers.infer(f, part=16))
    assert found.count() == 3
    for limit in (1 << 30, 0):
        monkeypatch.setattr(wrappers, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(wrappers, "PAGES_A_SALT", 50)
        got = {r.page_id: r.text.split("\n\n") for r in wrappers.extract(f, found).collect()}
        assert got[1] == [f"paragraph {k}" for k in range(20_000)] and got[2] == ["deep down", "after"]
        assert all(got[10 + i] == [f"T{i}"] + [f"part {k} of {i}" for k in range(9)] for i in range(300))


# --- op7 and op9 -----------------------------------------------------------------------------

TEXTS = [t or "" for _, t, *_ in ODD] + ["a" * 3000 + " b", "  two  spaces \n\n\t x", "́́combining", "don't DON'T I'll", "12345678 ½ ③", "\r\n" * 50, "<s> </s> <unk> ▁ <0x41>", "a b" * 9000]


def tiktoken_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_the_library_s(spark):
    rng = random.Random(8)
    texts = TEXTS + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 1000), rng.randrange(0x4E00, 0x9000)])) for _ in range(200)) for _ in range(40)]
    encoding, path = tiktoken_encoding(), public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.codec(path, public_tokenizers.PATTERN)
    for t in texts:
        ids = own.encode(t).tolist()
        assert ids == encoding.encode_ordinary(t) and own.decode(ids) == t.encode()
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(1000, None, None, None)]
    encoded = bpe.encode(frame(spark, rows), path, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.content).decode() for r in bpe.decode(encoded, path, public_tokenizers.PATTERN).collect()} == {i: t or "" for i, t, *_ in rows}
    for r in bpe.round_trip(frame(spark, rows), path, public_tokenizers.PATTERN).collect():
        ids = encoding.encode_ordinary(rows[-1][1] or "" if r.doc_id == 1000 else texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_perfect_hash():
    keys = [str(i).encode() for i in range(3000)]
    table = bpe.PerfectHash(keys, list(range(5, 3005)))
    assert [table.find(k) for k in keys] == list(range(5, 3005)) and table.find(b"x") == -1 and len(table.keys) == 3000
    assert bpe.PerfectHash([], []).find(b"a") == -1 and bpe.PerfectHash([b"a"], [7]).find(b"a") == 7


def test_token_counts_are_the_library_s(spark, monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(9)
    texts = TEXTS + [words(rng, 400) for _ in range(20)]
    want = [len(library.encode(t)) for t in texts]
    for split in (50, 8192):
        assert [sum(len(library.encode(p)) for p in tokencount.safe_parts(t, split)) for t in texts] == want
    monkeypatch.setattr(tokencount, "BATCH_BYTES", 100)
    assert tokencount.count_texts(texts, path) == want
    got = {r.doc_id: r for r in tokencount.count_tokens(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)] + [(500, None, None, None)]), path, limit=100).collect()}
    assert all((got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 100) for i, (t, n) in enumerate(zip(texts, want, strict=True))) and got[500].n_tokens == 0


# --- op8 -------------------------------------------------------------------------------------


def spec_exponent(shares, flat_enough):
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if flat_enough([s**middle for s in shares]) else (low, middle)
    return (low + high) / 2


def test_mixing_exponents(spark):
    rows = [(i, "w " * 10, None, s) for i, s in enumerate("a" * 600 + "b" * 100 + "c" * 20)]
    sources, totals = mixing.shares(mixing.prepared(frame(spark, rows)))
    shares = [600 / 720, 100 / 720, 20 / 720]
    want = spec_exponent(shares, lambda w: max(x / s for x, s in zip(w, shares, strict=True)) / sum(w) > 3)
    assert mixing.exponent_for(sources, totals, totals.tokens, max_repetition=3) == pytest.approx(want, abs=1e-6)

    def entropy(w):
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    want = spec_exponent(shares, lambda w: entropy(w) >= 0.8 * math.log(3))
    assert mixing.exponent_for(sources, totals, totals.tokens, target_entropy=0.8) == pytest.approx(want, abs=1e-6)
    assert mixing.exponent_for(sources, totals, totals.tokens, max_repetition=99) == 0.0


@pytest.mark.parametrize(("digits", "step"), [(1, 3), (3, 1), (4, 2), (5, 3)])
def test_mixing_draws_the_budget(spark, digits, step):
    rng = random.Random(11)
    rows = [(i, "w " * rng.randrange(0, 30), None, rng.choice(["hot", "hot", "hot", "cold", None])) for i in range(400)]
    prepared = mixing.prepared(frame(spark, rows))
    sources, totals = mixing.shares(prepared)
    drawn = mixing.assign(prepared, sources, mixing.plan(sources, totals, 0.3, totals.tokens), totals, digits=digits, step=step).select("doc_id", "_mix_source", "_mix_tokens", "_mix_place", *[F.col(f"_mix_{k}").alias(k) for k in ("copies", "weight", "passes", "room")]).collect()
    assert len(drawn) == 400
    by = defaultdict(list)
    for r in drawn:
        by[r._mix_source].append(r)
    z = sum((sum(r._mix_tokens for r in v) / totals.tokens) ** 0.3 for v in by.values())
    for v in by.values():
        own = sum(r._mix_tokens for r in v)
        assert v[0].weight == pytest.approx((own / totals.tokens) ** 0.3 / z)
        part, upto = math.floor(v[0].weight * totals.tokens + 0.5), 0
        for r in sorted(v, key=lambda r: (r._mix_place, r.doc_id)):
            upto += r._mix_tokens
            assert r.copies == part // own + (upto <= part % own)


@pytest.mark.parametrize("most_sources", [0, 100_000])
def test_mixing_splits_equal_rows(spark, monkeypatch, most_sources):
    """A pass stops amid rows that are equal in id and text; each row's draws are those of a plain loop over the places."""
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most_sources)
    monkeypatch.setattr(mixing, "PART_ROWS", 7)
    rng = random.Random(5)
    rows = [(None, "w w w", "en", "hot")] * 90 + [(None, "w w w", "de", "hot")] * 30 + [(i, "w " * rng.randrange(0, 9), "en", rng.choice(["hot", "cold", None])) for i in range(60)]
    rng.shuffle(rows)
    prepared = mixing.prepared(frame(spark, rows))
    sources, totals = mixing.shares(prepared)
    amid = 0
    for budget in range(150, 750, 150):
        drawn = mixing.assign(prepared, sources, mixing.plan(sources, totals, 0.6, budget), totals, digits=1).collect()
        assert Counter((r.doc_id, r.text, r.lang, r.source) for r in drawn) == Counter(rows)
        for source in {r._mix_source for r in drawn}:
            own = sorted((r for r in drawn if r._mix_source == source), key=lambda r: r._mix_place)
            upto, want, got = 0, Counter(), Counter()
            for r in own:
                upto += r._mix_tokens
                want[r._mix_place, r._mix_passes + (upto <= r._mix_room)] += 1
                got[r._mix_place, r._mix_copies] += 1
            assert want == got
            amid += any(len({c for p, c in got if p == place}) > 1 for place, _ in got)
    assert amid > 0


def test_mixing_keeps_null_and_empty_apart(spark):
    rows = [(1, None, None, "s")] * 3 + [(1, "", None, "s")] * 2 + [(None, "a b", None, None), (None, "a b", None, "")] * 4
    prepared = mixing.prepared(frame(spark, rows))
    sources, totals = mixing.shares(prepared)
    for budget in (3, 5, 7, 11):
        drawn = mixing.assign(prepared, sources, mixing.plan(sources, totals, 1.0, budget), totals).collect()
        assert Counter((r.doc_id, r.text, r.lang, r.source) for r in drawn) == Counter(rows)


def test_mixing_edges(spark):
    for rows in ([], ODD, [(1, None, None, None)], [(1, "a", None, "s"), (2, "", None, "t")]):
        docs = frame(spark, rows)
        prepared = mixing.prepared(docs)
        sources, totals = mixing.shares(prepared)
        exponent = mixing.exponent_for(sources, totals, totals.tokens, max_repetition=1.25)
        assert mixing.assign(prepared, sources, mixing.plan(sources, totals, exponent, totals.tokens), totals).count() == len(rows)
        out = mixing.stage(spark, docs, "")
        assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {r[0] for r in rows}


# --- op10 ------------------------------------------------------------------------------------


def test_segments_match_brute_force():
    rng = random.Random(12)
    for _ in range(400):
        odds = {"a": 0, "b": 0, "c": -2.0, "d": 1.5, "e": 3.0, "f": -4.0}
        text = [rng.choice("abcdef") for _ in range(rng.randrange(0, 14))]
        scores = [odds[t] for t in text]
        model = toxicity.Model({t: s for t, s in odds.items() if s}, {})
        got, n = model.segments(" ".join(text))
        values = [s - toxicity.DRIFT for s in scores]

        def best(low, high):
            """The definition: the best segment, then the same left and right of it."""
            found = [(sum(values[a:b]), -(b - a), a, b) for a in range(low, high) for b in range(a + 1, high + 1)]
            total, _, a, b = max(found, default=(0, 0, 0, 0), key=lambda x: (round(x[0], 9), x[1]))
            return [*best(low, a), (a, b, total), *best(b, high)] if total > 1e-9 else []

        want = best(0, len(values))
        assert n == len(scores) and sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want)) and len(got) == len(want)


def test_segments_of_repeated_passages():
    """Each passage has its segment, also where earlier mentions have the same words."""
    model = toxicity.Model({"bad": 4.0, "worse": 4.0}, {}, 1.0, -5.0)
    filler = "plain " * 1000
    segments, n = model.segments(f"bad worse {filler}bad worse")
    assert n == 1004 and [(a, b) for a, b, _ in segments] == [(0, 2), (1002, 1004)]
    late = f"bad {filler}worse {filler}bad worse bad worse"
    segments, n = model.segments(late)
    assert segments[-1][:2] == (n - 4, n) and segments[-1][2] == pytest.approx(4 * (4.0 - toxicity.DRIFT))
    assert model.judged(segments, n)[0] > model.judged(*model.segments(f"bad {filler}worse {filler}"))[0]


def test_segments_take_linear_time():
    """Candidates that can't be extended aren't walked again: ten times the features, some ten times the steps."""
    took = []
    for n in (20_000, 200_000):
        began = time.perf_counter()
        found = toxicity.maximal_segments([(i, 3.0 if i % 2 else -3.5) for i in range(n)])
        took.append(time.perf_counter() - began)
        assert len(found) == n // 2
    assert took[1] < 40 * took[0]


def test_extremes_are_recovered():
    rng = np.random.default_rng(3)
    tokens = rng.integers(50, 2000, 40_000).astype(float)
    best = (np.log(0.05 * tokens) - np.log(-np.log(rng.random(len(tokens))))) / 0.7
    best[best < 3] = 0  # what is under 3 isn't seen: treated as nothing found, the rest decides
    decay, rate = toxicity.fit_extremes(best, tokens, np.ones(len(tokens)))
    assert decay == pytest.approx(0.7, rel=0.1) and rate == pytest.approx(0.05, rel=0.35)
    assert toxicity.fit_extremes(np.zeros(2), np.array([10.0, 30.0]), np.ones(2)) == (1.0, 1 / 40)


def test_toxicity_returns_significant_segments(spark):
    """Only segments that are rare in clean text are returned, all of them, with the same score as the whole's."""
    model = toxicity.Model({"bad": 6.0, "worse": 6.0, "odd": 2.0}, {}, 1.0, -5.0, 0.8, 0.01)
    text = "bad worse " + "plain " * 200 + "odd " + "plain " * 200 + "worse bad worse"
    got = toxicity.score(frame(spark, [(1, text, None, None)]), model).collect()[0]
    assert [(x["first"], x["end"]) for x in got.segments] == [(0, 2), (403, 406)] and got.score == pytest.approx(model.score(text)[0])


def test_toxicity_repeated_ids_teach_once(spark):
    rows = [(i % 4, f"{'nasty' if i % 2 else 'nice'} word{i % 4}", None, None) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, toxic int")
    once = toxicity.train(frame(spark, rows[:4]), labels)
    assert toxicity.train(frame(spark, rows), labels) == once


def test_toxicity_held_out(spark):
    got = queries.queries()["op10_toxicity"](spark, f"{DATA}/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/sf0.1/labels.parquet").collect()}
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in got)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    clean = [r for r in held if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in clean) <= 0.005 * len(clean)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(3, 1), (7, 0), (3, None), (None, 1), (8, 5)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, ODD), labels)
    got = toxicity.score(frame(spark, ODD), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    nothing = toxicity.train(frame(spark, ODD), labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(frame(spark, ODD), nothing).collect()} == {0.0}
    assert toxicity.score(frame(spark, []), model).collect() == []


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    rows, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = common.materialize(stage(spark, rows, f"{DATA}/sf0.001"))
        assert rows.columns == docs.columns
        seen.append((name, {r.doc_id for r in rows.select("doc_id").collect()}))
    assert all(b <= a for (_, a), (_, b) in zip(seen, seen[1:])) and seen[2][1] == seen[3][1]
    out = corpus_pipeline.run(spark, f"{DATA}/sf0.001").collect()
    assert {r.doc_id for r in out} == seen[-1][1] and len(out) == rows.count()
    encoding = tiktoken_encoding()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(encoding.encode_ordinary(texts[r.doc_id])) for r in out)


CLASHES = ["passes", "weight", "room", "before", "copies", "rep", "n", "node", "component", "_gone", "score", "lang_pred", "toxic", "host", "salt", "train", "chunk", "bucket", "key", "keys", "counts", "statistics", "kept", "words", "lines", "held_out", "value"]


def odd_tables(spark, folder, rows):
    """documents, labels and pages of these rows, with columns of names that operators use."""
    docs = spark.createDataFrame(rows, DDL).select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 1), (7, 0)] if rows else [], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    turns = [(r[0] and r[0] * 100, None if r[0] == 5 else k, r[2], r[1]) for k, r in enumerate(rows)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").select("*", *[F.lit("clash").alias(c) for c in ("steps", "depth", "start", *CLASHES)]).write.parquet(f"{folder}/conversations.parquet")
    vectors = [(r[0], [None, [], [float(k), 1.0, 2.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0]][k % 5]) for k, r in enumerate(rows)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").select("*", *[F.lit("clash").alias(c) for c in ("whitened", *CLASHES)]).write.parquet(f"{folder}/embeddings.parquet")
    pages = [(i, None if i == 1 else f"https://h.example/{i}", t and f"<article><p>{t}</article>") for i, t, *_ in rows]
    spark.createDataFrame(pages, "page_id long, url string, html string").select("*", *[F.lit("clash").alias(c) for c in ("text", "matching", *CLASHES)]).write.parquet(f"{folder}/pages.parquet")
    return docs


@pytest.mark.parametrize("rows", [[], ODD], ids=["empty", "odd"])
def test_every_query_takes_odd_tables(spark, rows, tmp_path):
    """Nulls, empty and very long texts, repeated rows, ids that repeat, clashing names: one result a row."""
    odd_tables(spark, tmp_path, rows)
    for name, query in queries.queries().items():
        got = query(spark, str(tmp_path)).collect()
        if name.startswith(("op11_", "op12_")):  # nodes and components: their rows are held in test_structures
            assert bool(got) == bool(rows), name
            continue
        key = "page_id" if name.startswith("op5_") else "doc_id"
        assert sorted(str(r[key]) for r in got) == sorted(str(r[0]) for r in rows), name


@pytest.mark.parametrize("rows", [[], ODD], ids=["empty", "odd"])
def test_every_stage_takes_odd_tables(spark, rows, tmp_path):
    """Each stage but the last keeps the columns and only rows that came in; clean documents reach the end."""
    import corpus_pipeline

    docs = odd_tables(spark, tmp_path, rows)
    came = Counter(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, str(tmp_path)))
        left = Counter(map(str, docs.collect()))
        assert docs.columns[:4] == ["doc_id", "text", "lang", "source"] and set(left) <= set(came), name
        if name == "source_mixing":
            assert set(left) == set(came)
        came = left
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == sum(came.values())
    for r in got:
        text = next(t or "" for i, t, *_ in rows if i == r.doc_id)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
