"""Queries of sources, sinks and whole flows: files are written to the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import lookups, rendering, sampling
from sparkurate.plans import candidates, dataset, evaluation
from sparkurate.queries import _FULL, _LISTED, _OBJECTS, _quoted, _results, query, table
from sparkurate.session import scratch_folder
from sparkurate.sources import readers, sinks


def _text_file(rows: DataFrame, header: str, place: str) -> str:
    """One file of the lines (column line) in order after a header; the tables written so are small."""
    spark, folder = rows.sparkSession, scratch_folder(rows.sparkSession)
    lines = rows.select(F.col(place).cast("long").alias("place"), "line").union(spark.createDataFrame([(-1, header)], "place long, line string"))
    lines.repartition(1).sortWithinPartitions("place").select("line").write.text(folder)
    return folder


# --- sources and sinks -----------------------------------------------------------------------


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey % 7 NOT IN (0, 1)")
def untyped_csv(spark, sf_dir):
    """Rows with a field too few or too many are dropped, also where one column alone is asked for."""
    k = F.col("c_custkey")
    fields = F.when(k % 7 == 0, F.concat_ws(";", "c_name", k)).when(k % 7 == 1, F.concat_ws(";", "c_name", k, F.lit("x"), F.lit("y"), F.lit("z"))).otherwise(F.concat_ws(";", "c_name", k, "c_mktsegment", F.lit("")))
    path = _text_file(table(spark, sf_dir, "customer").select("c_custkey", fields.alias("line")), "name;id;segment;rest", "c_custkey")
    return readers.read_untyped(spark, path, schemas.strings("id", "name", "segment"))


@query("SELECT n_name AS label_id, lower(trim(n_name)) AS kingdom, trim(n_name) AS scientific_name, 'p' || n_nationkey AS polish_name, '' AS english_name, n_nationkey::INT AS place FROM nation")
def read_manifest(spark, sf_dir):
    line = F.concat_ws(",", "n_name", F.concat(F.lit(" "), "n_name"), F.concat("n_name", F.lit("  ")), F.concat(F.lit("p"), "n_nationkey"), F.lit(" "))
    path = _text_file(table(spark, sf_dir, "nation").select("n_nationkey", line.alias("line")), ",".join(schemas.MANIFEST.names), "n_nationkey")
    return readers.read_manifest(spark, path, size=25)


_EVENT = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("note", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))])


def _event_rows(spark, sf_dir):
    note = F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('ł "'), F.col("props"), F.lit("\\")))
    return table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("kind"), note.alias("note"), F.array("event_type", "props").alias("tags"))


_EVENT_SQL = "SELECT event_id::VARCHAR AS event_id, event_type AS kind, CASE WHEN event_id % 3 > 0 THEN 'ł \"' || props || chr(92) END AS note, event_type || '|' || props AS tags FROM events"


@query(_EVENT_SQL)
def json_lines_round_trip(spark, sf_dir):
    folder = scratch_folder(spark)
    sinks.write_json_lines(_event_rows(spark, sf_dir), folder)
    return readers.read_json_lines(spark, folder, _EVENT).withColumn("tags", F.array_join("tags", "|"))


@query(_EVENT_SQL)
def strict_json_lines(spark, sf_dir):
    folder = scratch_folder(spark)
    sinks.write_json_lines(_event_rows(spark, sf_dir), folder, spaced=True)
    return readers.read_json_lines_strict(spark, folder, _EVENT).withColumn("tags", F.array_join("tags", "|"))


@query("SELECT '{\"event_id\": \"' || event_id || '\", \"kind\": ' || to_json(event_type)::VARCHAR || ', \"tags\": [' || to_json(event_type)::VARCHAR || ', ' || to_json(props)::VARCHAR || ']}' AS line FROM events")
def spaced_json_lines(spark, sf_dir):
    return _event_rows(spark, sf_dir).drop("note").select(sinks.python_json(_event_rows(spark, sf_dir).drop("note")).alias("line"))


_RECORD_SQL = """SELECT l_returnflag AS label_id, 'img/' || l_returnflag || '/' || {id} || '.jpg' AS image_path, printf('%.6f', l_quantity) AS latitude, printf('%.6f', l_discount) AS longitude, CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END AS is_poland, {id} AS photo_id,
CASE WHEN l_linenumber = 1 THEN 'http://h/large.jpg' ELSE 'http://h/x.jpg' END AS download_url FROM lineitem WHERE NOT (l_linenumber = 2 AND l_returnflag = 'R')""".format(id="concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)")


def _selected(spark, sf_dir):
    photo = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    own = {"label_id": F.col("l_returnflag"), "photo_id": photo, "latitude": F.col("l_quantity"), "longitude": F.col("l_discount"), "is_poland": F.col("l_quantity") > 25}
    own |= {"image_url": F.when(F.col("l_linenumber") == 1, "http://h/medium.jpg").otherwise("http://h/x.jpg"), "observation_id": F.col("l_orderkey").cast("string")}
    return table(spark, sf_dir, "lineitem").select("l_linenumber", *[own.get(n, F.lit("")).alias(n) for n in schemas.CANDIDATE.names])


@query(_RECORD_SQL)
def records_csv(spark, sf_dir):
    """Selected candidates to records.csv and back; rows of failed downloads stay out."""
    chosen, folder = _selected(spark, sf_dir), scratch_folder(spark)
    failed = chosen.where("l_linenumber = 2 AND label_id = 'R'").select(C.planned_path("img", F.col("label_id"), F.col("photo_id")).alias("image_path"))
    sinks.write_csv(sinks.record_rows(chosen, "img", failed), folder)
    return readers.read_records(spark, folder).select("label_id", "image_path", "latitude", "longitude", "is_poland", "photo_id", "download_url")


@query("SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS photo_id FROM lineitem WHERE l_returnflag = 'A'")
def attribution_ids(spark, sf_dir):
    folder = scratch_folder(spark)
    sinks.write_csv(sinks.attribution_rows(sinks.record_rows(_selected(spark, sf_dir).where("label_id = 'A'"), "img")), folder)
    return readers.read_attribution_ids(spark, folder)


@query("SELECT l_returnflag AS label_id, count(*) AS missing FROM lineitem WHERE l_linenumber = 2 GROUP BY 1")
def failures_by_label(spark, sf_dir):
    """Failed downloads, known by their planned path alone, by the label of their record."""
    chosen = _selected(spark, sf_dir).withColumn("image_path", C.planned_path("img", F.col("label_id"), F.col("photo_id")))
    return lookups.attribute_failures(chosen, chosen.where("l_linenumber = 2").select("image_path"))


def _label_file(spark, sf_dir) -> str:
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("label_id"), *[F.col("n_name").alias(n) for n in schemas.MANIFEST.names[1:]], F.col("n_nationkey").alias("place"))
    path = f"{scratch_folder(spark)}/labels.json"
    sinks.write_text(sinks.label_document(nations), path)
    return path


@query(f"SELECT n_name AS label_id, n_name AS kingdom, n_name AS public_label_id FROM nation UNION ALL SELECT * FROM (VALUES ('unknown', 'unknown', 'unknown'), {', '.join(f'({e[0]!r}, {e[1]!r}, {V.UNKNOWN!r})' for e in V.INTERNAL_ENTRIES)}) AS i")
def label_catalog(spark, sf_dir):
    return readers.catalog_entries(readers.read_label_catalog(spark, _label_file(spark, sf_dir))).select("label_id", "kingdom", "public_label_id")


@query(f"SELECT n_name AS label FROM nation UNION ALL SELECT * FROM (VALUES ('unknown'), {', '.join(f'({x!r})' for x in V.INTERNAL_UNKNOWN)}) AS i")
def supported_labels(spark, sf_dir):
    return readers.supported_labels(readers.read_label_catalog(spark, _label_file(spark, sf_dir)))


@query("""SELECT '{"type":"object","properties":{"label_id":{"type":"string","enum":[' || string_agg('"' || l || '"', ',' ORDER BY upper(l)) || ']}},"required":["label_id"],"additionalProperties":false}' AS schema FROM (SELECT DISTINCT lower(n_name) AS l FROM nation WHERE n_nationkey > 4 UNION SELECT n_name FROM nation WHERE n_nationkey <= 4)""")
def label_schema(spark, sf_dir):
    labels = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") > 4, F.lower("n_name")).otherwise(F.col("n_name")).alias("label"))
    return sinks.json_schema(labels.union(labels))


def _nation_files(spark, sf_dir) -> tuple[str, DataFrame]:
    """A folder with a file for each nation of an even key, and its inventory by name."""
    folder = scratch_folder(spark)
    table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("k"), "n_nationkey").alias("k"), F.col("n_name").alias("value")).write.partitionBy("k").text(folder)
    return folder, readers.inventory(spark, folder, "part-*").withColumn("name", F.regexp_extract("path", r"k=(k\d+)/", 1))


@query("SELECT 'k' || n_nationkey AS name, length(n_name) + 1 AS length FROM nation WHERE n_nationkey % 2 = 0")
def file_inventory(spark, sf_dir):
    return _nation_files(spark, sf_dir)[1].select("name", "length")


@query("SELECT 'k' || min(n_nationkey) AS path FROM nation WHERE n_nationkey >= 5 AND n_nationkey % 2 = 0")
def first_existing_file(spark, sf_dir):
    files = _nation_files(spark, sf_dir)[1].select(F.col("name").alias("path"))
    tries = table(spark, sf_dir, "nation").where("n_nationkey >= 5").select(F.col("n_nationkey").alias("place"), F.concat(F.lit("k"), "n_nationkey").alias("path"))
    return readers.first_existing(tries, files)


@query("SELECT 'k' || n_nationkey AS name FROM nation WHERE n_nationkey % 2 = 1")
def missing_files(spark, sf_dir):
    """Required files that aren't there or are empty."""
    files = _nation_files(spark, sf_dir)[1].where("length > 0")
    return lookups.missing(table(spark, sf_dir, "nation").select(F.concat(F.lit("k"), "n_nationkey").alias("name")), files, "name")


@query("SELECT sum(length(n_name) + 1)::BIGINT AS bytes FROM nation WHERE n_nationkey % 2 = 0")
def file_bytes(spark, sf_dir):
    return _nation_files(spark, sf_dir)[1].agg(F.sum("length").alias("bytes"))


# --- scalars and lookups ---------------------------------------------------------------------


@query("""SELECT page_id, 'p/images/' || CASE WHEN len(parts) < 2 OR parts[-2] = '' THEN 'misc' ELSE parts[-2] END || '/' || parts[-1] AS portable, CASE WHEN page_id % 3 = 0 THEN '/abs/' || url WHEN page_id % 3 = 1 THEN 'C:' || url ELSE '/root/' || url END AS resolved,
'q=' || replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D') || '&n=' || page_id AS query, upper(sha256(url)) AS digest
FROM (SELECT page_id, url, string_split(replace(CASE WHEN page_id % 2 = 0 THEN url ELSE 'x' || page_id END, chr(92), '/'), '/') AS parts FROM pages WHERE url SIMILAR TO '[A-Za-z0-9:/?=._-]*')""")
def path_functions(spark, sf_dir):
    url, k = F.col("url"), F.col("page_id")
    given = F.when(k % 3 == 0, F.concat(F.lit("/abs/"), url)).when(k % 3 == 1, F.concat(F.lit("C:"), url)).otherwise(url)
    pages = table(spark, sf_dir, "pages").where(url.rlike(r"^[A-Za-z0-9:/?=._-]*$"))
    return pages.select(
        "page_id", C.portable_path(F.when(k % 2 == 0, url).otherwise(F.concat(F.lit("x"), k.cast("string"))), "p/").alias("portable"), C.resolve_path(given, "/root/").alias("resolved"),
        C.query_string(("q", url), ("n", k.cast("string"))).alias("query"), C.content_hash(url.cast("binary")).alias("digest"),
    )


_NUMBER = "CASE event_id % 4 WHEN 0 THEN concat('', event_id % 50) WHEN 1 THEN event_type WHEN 2 THEN concat(' ', event_id % 9, ' ') ELSE concat('-', event_id) END"


@query(f"SELECT event_id, CASE WHEN event_id % 4 = 0 AND event_id % 50 >= 1 THEN event_id % 50 WHEN event_id % 4 = 2 AND event_id % 9 >= 1 THEN event_id % 9 ELSE 7 END::INT AS n, replace('<image>: ' || event_type, '<image>', '[' || event_id || ']') AS prompt, round(value / 7, 4) AS rounded FROM events")
def parse_and_fill(spark, sf_dir):
    """Positive integers with a fallback, the media marker in a prompt, the digest's rounding."""
    prompt = C.fill_marker(F.concat(F.lit("<image>: "), "event_type"), F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")))
    return table(spark, sf_dir, "events").select("event_id", C.int_or(F.expr(_NUMBER), 7).alias("n"), prompt.alias("prompt"), F.round(F.col("value") / 7, 4).alias("rounded"))


@query("SELECT p_partkey, list_filter([p_name, '', ' ', p_brand], lambda x: trim(x) <> '')[1] AS first, len(list_filter([p_name, '', ' ', p_brand], lambda x: trim(x) <> '')) AS n, len(string_split(p_type, '')[1:16]) AS letters FROM part")
def list_functions(spark, sf_dir):
    kept = C.without_blanks(F.array("p_name", F.lit(""), F.lit(" "), "p_brand"))
    rows = table(spark, sf_dir, "part").withColumns({"_kept": kept, "_letters": F.split("p_type", "")})
    return rows.select("p_partkey", F.element_at("_kept", 1).alias("first"), F.size("_kept").cast("long").alias("n"), F.size(sampling.first_items("_letters")).cast("long").alias("letters"))


@query("SELECT o_orderkey, o_orderpriority AS label_id, n_name AS kingdom FROM orders JOIN (SELECT p, n_name FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) JOIN nation ON n_nationkey = length(p)) ON o_orderpriority = p")
def strict_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label_id"))
    catalog = orders.select("label_id").distinct().join(table(spark, sf_dir, "nation"), F.length("label_id") == F.col("n_nationkey")).select("label_id", F.col("n_name").alias("kingdom"))
    return lookups.lookup_strict(orders, catalog).select("o_orderkey", "label_id", "kingdom")


@query("SELECT lower(c_mktsegment) AS label, count(*) AS n, max(name) AS name FROM customer LEFT JOIN (SELECT lower(r_name[1]) AS k, max(r_name) AS name FROM region GROUP BY 1) ON lower(c_mktsegment[1]) = k GROUP BY 1")
def folded_lookup(spark, sf_dir):
    """A join on a key in any case, and the same from one map of the catalog."""
    rows = table(spark, sf_dir, "customer").select(F.substring("c_mktsegment", 1, 1).alias("key"), "c_mktsegment")
    catalog = table(spark, sf_dir, "region").groupBy(F.lower(F.substring("r_name", 1, 1)).alias("key")).agg(F.max("r_name").alias("name"))
    joined = lookups.by_folded_key(rows, catalog, "key")
    whole = lookups.map_of(catalog, "key", "name", fold=True)
    same = joined.join(F.broadcast(whole)).withColumn("name", F.when(F.col("name").eqNullSafe(F.try_element_at("map", F.lower("key"))), F.col("name")).otherwise("differs"))
    return same.groupBy(F.lower("c_mktsegment").alias("label")).agg(F.count("*").alias("n"), F.max("name").alias("name"))


@query("SELECT DISTINCT l_returnflag AS label_id FROM lineitem")
def distinct_labels(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label_id")).distinct()


@query("SELECT 'run/checkpoint-' || max(n_nationkey) AS path FROM nation")
def newest_checkpoint(spark, sf_dir):
    return sampling.newest(table(spark, sf_dir, "nation").select(F.concat(F.lit("run/checkpoint-"), "n_nationkey").alias("path")), "path")


@query("SELECT arg_min(p_name, p_partkey) AS p_name FROM part WHERE contains(lower(p_name), lower('A')) OR contains(lower(p_name), '9')")
def first_matching_file(spark, sf_dir):
    return sampling.first_with(table(spark, sf_dir, "part"), "p_name", ("A", "9"), "p_partkey")


@query("SELECT row_number() OVER (ORDER BY label_id) AS place, label_id, missing FROM (SELECT lang AS label_id, 1000000 - count(*) AS missing FROM documents WHERE lang IS NOT NULL GROUP BY 1)")
def sorted_shortages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("lang is not null").withColumn("label_id", F.col("lang"))
    quotas = docs.select("label_id").distinct().withColumn("quota", F.lit(1_000_000))
    report = sampling.shortage_report(sampling.shortages(docs, quotas))
    return report.select("place", "label_id", "missing")


# --- prompts ---------------------------------------------------------------------------------

_ROLES = [("user", "plants"), ("assistant", "fungi"), ("system", "plants")]


@query(
    f"""SELECT 'training' AS client, concat_ws(chr(10), {', '.join(map(_quoted, (V.CLASSIFY, V.JSON_ONLY, V.CHOOSE, V.FALLBACK[True], V.NO_INVENTION, 'Allowed labels:')))}, {_LISTED}, {', '.join(_quoted(f'- {e[0]} = {e[4]}{V.INTERNAL_NOTE}') for e in V.INTERNAL_ENTRIES)}, {_quoted(V.LAST_LINE[True])}) AS prompt
UNION ALL SELECT 'desktop', concat_ws(chr(10), {', '.join(map(_quoted, (V.CLASSIFY, V.JSON_ONLY, V.CHOOSE, V.FALLBACK[True], V.NO_THINKING, V.NO_INVENTION, 'Allowed labels:')))}, {_LISTED})
UNION ALL SELECT 'mobile', {_quoted(V.MOBILE_SYSTEM)} || (SELECT string_agg(r_name, ',' ORDER BY r_regionkey) FROM region) || '.'
UNION ALL SELECT 'mobile_taxonomy', (SELECT string_agg(r_name || ': s_' || r_name || ' (p; ' || r_regionkey || ')', chr(10) ORDER BY r_regionkey) FROM region) || chr(10) || {_quoted(V.UNKNOWN_TAXON_LINE)}"""
)
def client_prompts(spark, sf_dir):
    catalog = rendering.catalog_rows([(r, k, f"s_{r}", f"p_{r}", f"e_{r}") for r, k in _ROLES])
    training = rendering.catalog_rows([(r, k, f"s_{r}", f"p_{r}", f"e_{r}") for r, k in _ROLES], internal=True)
    regions = [(r["r_name"], "k", f"s_{r['r_name']}", "p", str(r["r_regionkey"])) for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    found = {
        "training": rendering.system_prompt("strict_label_only_with_taxonomy", training),
        "desktop": rendering.render("desktop", 1, catalog),
        "mobile": rendering.mobile_prompt([r[0] for r in regions]),
        "mobile_taxonomy": rendering.mobile_taxonomy([*regions, V.UNKNOWN_ENTRY]),
    }
    return spark.createDataFrame(list(found.items()), "client string, prompt string")


@query(f"SELECT {_quoted(V.LEGACY_SYSTEM)} AS system, {_FULL} AS answer, 'img/' || conv_id AS image, count(*) AS n FROM conversations JOIN (VALUES ('user', 'plants'), ('assistant', 'fungi'), ('system', 'plants')) AS c(label_id, kingdom) ON role = c.label_id GROUP BY role, kingdom, conv_id")
def training_examples(spark, sf_dir):
    """Rows to examples, with every image there."""
    catalog = [(r, k, f"s_{r}", f"p_{r}", f"e_{r}") for r, k in _ROLES]
    rows = table(spark, sf_dir, "conversations").select(F.col("role").alias("label_id"), F.concat(F.lit("img/"), F.col("conv_id").cast("string")).alias("image_path"))
    found = rendering.examples(rows, catalog, files=rows.select(F.col("image_path").alias("path")))
    return found.groupBy(F.element_at("messages", 1)["content"].alias("system"), F.element_at("messages", 3)["content"].alias("answer"), F.element_at("images", 1).alias("image")).agg(F.count("*").alias("n"))


# --- whole flows -----------------------------------------------------------------------------

_OBS = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_LATITUDE, _LONGITUDE = "34 + l_quantity * 0.9", "l_discount * 400 - 10"
_CHAIN = f"""WITH taxa AS (SELECT p_partkey AS taxon, p_name AS scientific_name, CASE WHEN p_partkey % 3 = 0 THEN 'fungi' ELSE 'plants' END AS kingdom, CASE WHEN p_partkey % 50 < 5 THEN 'L' || p_partkey % 50 END AS label FROM part WHERE p_partkey % 7 <> 0),
o AS (SELECT {_OBS} AS id, 's' || l_suppkey AS observer, l_partkey AS taxon, {_LATITUDE} AS lat, {_LONGITUDE} AS lon, l_linenumber AS line, l_orderkey AS ord FROM lineitem WHERE l_returnflag <> 'N' AND {_LATITUDE} BETWEEN 34 AND 73 AND {_LONGITUDE} BETWEEN -32 AND 45),
seen AS (SELECT *, lon BETWEEN 14.05 AND 24.25 AND lat BETWEEN 49 AND 55.05 AS near FROM o JOIN taxa USING (taxon)),
capped AS (SELECT *, row_number() OVER (PARTITION BY label, near ORDER BY md5('23|' || id), id) AS rn FROM seen),
pool AS (SELECT * FROM capped WHERE rn <= CASE WHEN label IS NULL THEN CASE WHEN near THEN 40 ELSE 60 END ELSE CASE WHEN near THEN 4 ELSE 9 END END)
SELECT coalesce(label, 'unknown') AS label_id, kingdom, id AS observation_id, id || '-p' AS photo_id, observer AS observer_id, CASE WHEN ord % 2 = 0 THEN 'CC0' ELSE 'CC-BY' END AS license_code, observer AS photographer,
round(lat, 9) AS latitude, round(lon, 9) AS longitude, near AS is_poland FROM pool WHERE ord % 5 <> 0"""


@query(_CHAIN)
def candidate_chain(spark, sf_dir):
    """All five stages from raw strings: taxa, observations, caps, first photos with a licence, join."""
    parts, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    k = F.col("p_partkey")
    ancestry = F.when(k % 7 == 0, F.lit("1/2/3")).when(k % 3 == 0, F.lit("48460/47170/9")).otherwise(F.lit("48460/47126/8"))
    taxa = parts.select(k.cast("string").alias("taxon_id"), F.concat_ws(" ", "p_name", "p_partkey").alias("name"), ancestry.alias("ancestry"))
    manifest = parts.where("p_partkey % 50 < 5").select(F.concat(F.lit("L"), (k % 50).cast("string")).alias("label_id"), F.lit("k").alias("kingdom"), F.upper(F.concat_ws(" ", "p_name", "p_partkey")).alias("scientific_name"), F.lit("p").alias("polish_name"), F.lit("e").alias("english_name"))
    own = F.expr(_OBS)
    grade = F.when(F.col("l_returnflag") == "N", "casual").when(F.col("l_returnflag") == "A", "Research").otherwise("needs_id")
    seen = lines.select(
        own.alias("observation_uuid"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("observer_id"), F.col("l_partkey").cast("string").alias("taxon_id"), grade.alias("quality_grade"),
        F.expr(_LATITUDE).cast("string").alias("latitude"), F.expr(_LONGITUDE).cast("string").alias("longitude"),
    )
    order = F.col("l_orderkey")
    license_ = F.when(order % 5 == 0, "all rights reserved").when(order % 2 == 0, "cc0").otherwise("cc-by 4.0")
    first = lines.select(own.alias("observation_uuid"), F.concat(own, F.lit("-p")).alias("photo_id"), F.lit("JPG").alias("extension"), license_.alias("license"), F.lit("").alias("observer_id"), F.lit("0").alias("position"))
    later = first.withColumns({"photo_id": F.concat("photo_id", F.lit("2")), "license": F.lit("CC0"), "position": F.lit("x")})
    none = first.withColumns({"photo_id": F.lit("0"), "extension": F.lit(None).cast("string"), "position": F.lit("-1")})
    found = candidates.candidates(taxa, seen, first.unionByName(later).unionByName(none), manifest, known_caps=(4, 9), unknown_caps=(40, 60))
    return found.select("label_id", "kingdom", "observation_id", "photo_id", "observer_id", "license_code", "photographer", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "is_poland")


_KNOWN = ("view", "click", "purchase", "never")
_EVALUATED = f"""WITH {_OBJECTS}, pairs AS (SELECT event_id, event_type AS truth, label AS pred, parsed = '{{"label_id": "' || event_type || '"}}' AS exact, parsed FROM found),
known AS (SELECT * FROM (VALUES {', '.join(f'({k!r}, {i})' for i, k in enumerate(_KNOWN))}) AS k(label, place)), dom AS (SELECT label FROM known UNION SELECT truth FROM pairs UNION SELECT pred FROM pairs),
c AS (SELECT label, count(*) FILTER (truth = label AND pred = label) AS tp, count(*) FILTER (truth <> label AND pred = label) AS fp, count(*) FILTER (truth = label AND pred <> label) AS fn FROM dom, pairs GROUP BY label),
f AS (SELECT *, CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM c),
top AS (SELECT truth, pred, count(*) AS n, min(event_id) AS first FROM pairs WHERE truth <> pred GROUP BY 1, 2)
SELECT count(*) AS num_examples, round(count(parsed) / count(*), 9) AS valid_json_rate, round(count(*) FILTER (exact) / count(*), 9) AS exact_json_match_rate, round(count(*) FILTER (truth = pred) / count(*), 9) AS accuracy,
(SELECT round(sum(f1) / 4, 9) FROM f WHERE label IN (SELECT label FROM known)) AS macro_f1_known, (SELECT round(avg(f1), 9) FROM f) AS macro_f1_all,
(SELECT string_agg(label || ' ' || tp + fn || ' ' || printf('%.6f', f1), ', ' ORDER BY label) FROM f) AS per_class,
(SELECT string_agg(truth || '>' || pred || ' ' || n, ', ' ORDER BY n DESC, place, first) FROM (SELECT * FROM top JOIN known ON truth = label ORDER BY n DESC, place, first LIMIT 5)) AS confusions,
(SELECT count(*) FROM (SELECT 1 FROM pairs WHERE pred IN ('invalid_json', 'missing_label') LIMIT 50)) AS invalid FROM pairs"""


@query(_EVALUATED)
def whole_evaluation(spark, sf_dir):
    """Rates, metrics, per-class values, confusions and bad answers of free texts in one row."""
    known = spark.createDataFrame([(k, i) for i, k in enumerate(_KNOWN)], "label string, label_place int")
    found = evaluation.evaluate(_results(spark, sf_dir), known, {}, top=5)
    entries = F.transform(F.map_entries("per_class"), lambda e: F.concat_ws(" ", e["key"], e["value"]["support"], F.format_string("%.6f", e["value"]["f1"])))
    confusions = F.transform("top_confusions", lambda t: F.concat(t["truth"], F.lit(">"), t["pred"], F.lit(" "), t["count"].cast("string")))
    rounded = [F.round(k, 9).alias(k) for k in ("valid_json_rate", "exact_json_match_rate", "accuracy", "macro_f1_known", "macro_f1_all")]
    return found.select("num_examples", *rounded, F.array_join(F.array_sort(entries), ", ").alias("per_class"), F.array_join(confusions, ", ").alias("confusions"), F.size("invalid_examples").cast("long").alias("invalid"))


@query(f"WITH d AS (SELECT 'train' AS split, doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'val', doc_id, row_number() OVER (ORDER BY doc_id) FROM documents WHERE doc_id % 2 = 1) SELECT split, doc_id FROM d WHERE n <= CASE split WHEN 'train' THEN 20 ELSE 7 END")
def smoke_subset(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    parts = dataset.smoke_subset({"train": docs.where("doc_id % 2 = 0"), "val": docs.where("doc_id % 2 = 1")}, {"train": 20, "val": 7, "dev": 5}, "doc_id")
    return parts["train"].select(F.lit("train").alias("split"), "doc_id").union(parts["val"].select(F.lit("val").alias("split"), "doc_id"))


@query("""SELECT CASE WHEN event_id % 3 = 0 THEN '/abs/' || event_id ELSE '/root/' || event_id END AS image, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'unknown' END AS label FROM events WHERE event_id % 4 <> 0 ORDER BY event_id LIMIT 30""")
def suite_examples(spark, sf_dir):
    """The first examples with an image, paths resolved, labels collapsed."""
    k = F.col("event_id")
    image = F.when(k % 4 == 0, " ").when(k % 3 == 0, F.concat(F.lit("/abs/"), k.cast("string"))).otherwise(k.cast("string"))
    said = F.array(F.struct(F.lit("Assistant").alias("role"), F.concat(F.lit('{"label_id":"'), "event_type", F.lit('"}')).alias("content")))
    rows = table(spark, sf_dir, "events").select(k.alias("place"), F.array(image).alias("images"), said.alias("messages"))
    return dataset.test_examples(rows, "/root", 30, ["view", "click", "unknown"], {})


@query("SELECT event_id FROM events WHERE event_id % 10 = 3")
def malformed_examples(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 3, F.array("event_type")).alias("messages"), F.array("props").alias("images"))
    return dataset.malformed(rows).select("event_id")


@query("SELECT 'train' AS split, lang AS label_id, 3::BIGINT AS quota FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) UNION ALL SELECT 'train', 'unknown', 9")
def quota_rows(spark, sf_dir):
    labels = [r["lang"] for r in table(spark, sf_dir, "documents").where("lang is not null").select("lang").distinct().collect()]
    return dataset.quota_table(spark, labels, {"train": 3}, {"train": 9})


@query("""SELECT name, status FROM (SELECT count(*) FILTER (r_regionkey < 3) AS p, count(*) AS n, count(DISTINCT r_name) AS d FROM region), (VALUES ('catalog_size', 'FAIL'), ('unique_labels', 'PASS'), ('parser_round_trip', NULL), ('prompt_coverage', 'FAIL'), ('adapter_files', 'WARNING')) AS c(name, s),
LATERAL (SELECT CASE name WHEN 'catalog_size' THEN CASE WHEN p = 20 THEN 'PASS' ELSE 'FAIL' END WHEN 'unique_labels' THEN CASE WHEN n = d THEN 'PASS' ELSE 'FAIL' END WHEN 'parser_round_trip' THEN CASE WHEN (SELECT bool_and(regexp_full_match(r_name, '[A-Za-z0-9_]+')) FROM region) THEN 'PASS' ELSE 'FAIL' END ELSE s END AS status)""")
def self_test(spark, sf_dir):
    """Checks of a catalog, its prompt and its files that need no model."""
    catalog = table(spark, sf_dir, "region").select(F.col("r_name").alias("label_id"), F.when(F.col("r_regionkey") < 3, "plants").otherwise("fungi").alias("kingdom"))
    adapter = spark.createDataFrame([("a.bin", 5), ("b.bin", 0)], "name string, length long")
    return dataset.self_test(catalog, "AFRICA", adapter, ["a.bin", "b.bin"]).select("name", "status")
