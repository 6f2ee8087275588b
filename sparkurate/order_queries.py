"""Queries of file order, records that span lines, greedy and seeded selection, places by ranges, and files that are copied and replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkurate import schemas
from sparkurate.flow_queries import _text_file
from sparkurate.functions import columns as C
from sparkurate.functions import values as V
from sparkurate.operators import metrics, ordering, sampling, splits
from sparkurate.queries import IDS, IDS_SQL, LINE_KEY, _flagged, query, table
from sparkurate.session import scratch_folder
from sparkurate.sources import readers, sinks

# --- records and lines -----------------------------------------------------------------------


def _quoted_field(text) -> object:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


@query("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name || chr(10) || '\"' || c_mktsegment || '\", ' || chr(10) || chr(10) || 'x' ELSE c_name END AS note, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def records_across_lines(spark, sf_dir):
    """Two files of other columns in another order; one has quoted line ends, quotes and separators."""
    customers, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    note = F.concat("c_name", F.lit("\n"), F.lit('"'), "c_mktsegment", F.lit('", \n\nx'))
    spanning = customers.where(key % 2 == 0).select("c_custkey", F.concat_ws(",", _quoted_field(note), key, "c_mktsegment").alias("line"))
    plain = customers.where(key % 2 == 1).select("c_custkey", F.concat_ws(";", key, "c_name", F.lit("more")).alias("line"))
    paths = [_text_file(spanning, "note,id,segment", "c_custkey"), _text_file(plain, "id;note;rest", "c_custkey")]
    return readers.read_untyped(spark, paths, schemas.strings("id", "note", "segment"))


_PLACES = "SELECT event_id::VARCHAR AS event_id, event_type AS kind, row_number() OVER (ORDER BY event_id % 2, event_id) AS place FROM events"


def _event_files(spark, sf_dir) -> list[str]:
    """Two files, the even events' before the others, with blank lines between some."""
    base, paths = scratch_folder(spark), []
    for odd in (0, 1):
        line = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("event_type").alias("kind")))
        rows = table(spark, sf_dir, "events").where(F.col("event_id") % 2 == odd).select("event_id", F.when(F.col("event_id") % 10 == odd, F.concat(line, F.lit("\n  "))).otherwise(line).alias("line"))
        rows.repartition(1).sortWithinPartitions("event_id").select("line").write.text(f"{base}/{odd}")
        paths.append(f"{base}/{odd}")
    return paths


@query(f"SELECT event_id, kind, (place + (event_id::BIGINT % 2 = 1)::INT * (SELECT count(*) FROM events WHERE event_id % 10 = 0) + (SELECT count(*) FROM events o WHERE o.event_id % 10 = p.event_id::BIGINT % 2 AND o.event_id < p.event_id::BIGINT))::BIGINT AS place FROM ({_PLACES}) p")
def json_lines_in_order(spark, sf_dir):
    """Each row's place over all files; blank lines count."""
    return readers.read_json_lines_in_order(spark, _event_files(spark, sf_dir), schemas.strings("event_id", "kind")).select("event_id", "kind", "place")


@query(f"SELECT * FROM ({_PLACES}) WHERE place <= (SELECT count(*) FROM events WHERE event_id % 2 = 0) + 77")
def first_in_file_order(spark, sf_dir):
    """The first rows of both files, as many as the first has and 77 more; blank lines don't count."""
    n = table(spark, sf_dir, "events").where("event_id % 2 = 0").count() + 77
    return readers.first_json_lines(spark, _event_files(spark, sf_dir), schemas.strings("event_id", "kind"), n)


# --- selection and order ---------------------------------------------------------------------


@query(
    f"""WITH RECURSIVE p AS (SELECT {IDS_SQL}, l_returnflag, coalesce(l_quantity BETWEEN 10 AND 20, false) AS flag, row_number() OVER (PARTITION BY l_returnflag ORDER BY coalesce(l_quantity BETWEEN 10 AND 20, false) DESC, {LINE_KEY}, {IDS_SQL}) AS rn FROM lineitem),
g AS (SELECT l_returnflag AS k, 0::BIGINT AS pos, []::BIGINT[] AS orders, []::BIGINT[] AS suppliers, []::BIGINT[] AS taken FROM (SELECT DISTINCT l_returnflag FROM lineitem)
UNION ALL SELECT k, rn, CASE WHEN free THEN orders || [l_orderkey] ELSE orders END, CASE WHEN free THEN suppliers || [l_suppkey] ELSE suppliers END, CASE WHEN free THEN taken || [rn] ELSE taken END
FROM (SELECT g.*, p.rn, p.l_orderkey, p.l_suppkey, NOT list_contains(orders, l_orderkey) AND len(list_filter(suppliers, lambda s: s = l_suppkey)) < 2 AS free FROM g JOIN p ON p.l_returnflag = g.k AND p.rn = g.pos + 1 WHERE len(taken) < 15))
SELECT {IDS_SQL}, l_returnflag, flag FROM p JOIN (SELECT k, unnest(max_by(taken, pos)) AS t FROM g GROUP BY k) ON k = l_returnflag AND t = rn"""
)
def greedy_topk(spark, sf_dir):
    """Orders have several suppliers: one line an order, two a supplier, the first 15 of each flag."""
    rows = _flagged(table(spark, sf_dir, "lineitem").select(*IDS, "l_returnflag", "l_quantity"))
    return sampling.greedy_top(rows, "l_returnflag", "l_orderkey", "l_suppkey", "flag", IDS, 15).select(*IDS, "l_returnflag", "flag")


@query()
def seeded_order(spark, sf_dir):
    """The documents of each language in the order of one generator that goes from language to language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    languages = [r["lang"] for r in docs.where("lang IS NOT NULL").select("lang").distinct().orderBy("lang").collect()]
    largest = docs.groupBy("lang").count().agg(F.max("count").alias("n")).first()["n"] or 1
    return sampling.seeded(docs, "lang", "doc_id", languages, largest)


_SHARES = """WITH c AS (SELECT l_partkey AS label, count(*) AS capacity FROM lineitem GROUP BY 1), t AS (SELECT *, sum(capacity) OVER ()::BIGINT AS total FROM c),
f AS (SELECT *, 12345 * capacity // total AS share, 12345 * capacity % total AS fraction FROM t), r AS (SELECT *, row_number() OVER (ORDER BY fraction DESC, capacity DESC, label) AS rn, 12345 - sum(share) OVER () AS rest FROM f WHERE share < capacity)
SELECT label, capacity, (share + CASE WHEN rn <= rest THEN 1 ELSE 0 END)::BIGINT AS share FROM r UNION ALL SELECT label, capacity, share FROM f WHERE share >= capacity"""


@query(_SHARES)
def allocation_of_many_keys(spark, sf_dir):
    return splits.allocation(table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("label")).agg(F.count("*").alias("capacity")), 12345)


@query("SELECT o_orderkey, row_number() OVER w AS place, (sum(o_custkey) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM orders WINDOW w AS (ORDER BY o_orderpriority DESC, o_orderkey)")
def places_in_order(spark, sf_dir):
    """Places and running sums over the whole table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    order = [F.desc("o_orderpriority"), F.col("o_orderkey")]
    return ordering.running_sum(ordering.numbered(orders, order), order, "o_custkey", "upto").select("o_orderkey", "place", "upto")


@query("SELECT l_returnflag, md5(string_agg(l_orderkey || '.' || l_linenumber || '.' || l_partkey, ',' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS digest FROM lineitem GROUP BY 1")
def ordered_text_of_hot_keys(spark, sf_dir):
    """Three keys share all rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", *IDS, F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("line"))
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return ordering.joined_text(rows, ["l_returnflag"], order, "line", ",").select("l_returnflag", F.md5("text").alias("digest"))


_LABELS = ["A", "B", "C", "D", "E", V.UNKNOWN]


@query(
    f"""SELECT vec_id, signature, CASE WHEN signature % 7 = 0 THEN '{V.UNKNOWN}' ELSE (['A', 'B', 'C', 'D', 'E'])[abs(signature) % 5 + 1] END AS label FROM (SELECT vec_id, (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INT AS signature
FROM (SELECT vec_id, list_reduce(list_transform(embedding, lambda e: floor(e::DOUBLE * 1048576)::BIGINT), lambda a, b: ((a * 31 + b) % 4294967296 + 4294967296) % 4294967296, 256::BIGINT) AS h FROM embeddings))"""
)
def mock_signature(spark, sf_dir):
    """The rolling hash of an eight by eight grid of numbers, and the label that it stands for."""
    cells = F.transform("embedding", lambda e: F.floor(e.cast("double") * (1 << 20)).cast("int"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", C.grid_hash(cells, F.lit(8), F.lit(8)).alias("signature"))
    return rows.withColumn("label", C.mock_label(F.col("signature"), _LABELS))


# --- files -----------------------------------------------------------------------------------


def _customer_files(spark, sf_dir) -> DataFrame:
    """path and key of a file for each of some customers, all nations' among them."""
    folder = scratch_folder(spark)
    one = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min_by("c_name", "c_custkey").alias("value"))
    one.select(F.concat(F.lit("n"), "c_nationkey").alias("k"), "value").write.partitionBy("k").text(folder)
    folders = one.select(F.concat(F.lit(f"{folder}/k=n"), "c_nationkey").alias("folder"))
    local = folders.withColumn("folder", F.regexp_replace("folder", "^file:/*", "/"))
    return readers.dealt_inventory(spark, local, "part-*").withColumn("nation", F.regexp_extract("path", r"k=n(\d+)/", 1).cast("int"))


_FIRST_NAMES = "SELECT c_nationkey AS nation, min_by(c_name, c_custkey) AS name FROM customer GROUP BY 1"


@query(f"SELECT nation, (length(name) + 1)::BIGINT AS length FROM ({_FIRST_NAMES})")
def listed_by_tasks(spark, sf_dir):
    return _customer_files(spark, sf_dir).select("nation", "length")


@query(f"SELECT 'images/k=n' || nation AS folder, name || chr(10) AS content FROM ({_FIRST_NAMES})")
def bundled_files(spark, sf_dir):
    """Files copied into a bundle, as they are read there."""
    out = scratch_folder(spark)
    sinks.bundle(_customer_files(spark, sf_dir).select(F.array("path").alias("images")), out)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out)
    return files.select(F.regexp_extract("path", r"(images/[^/]*)/", 1).alias("folder"), F.decode("content", "UTF-8").alias("content"))


@query("SELECT p_partkey::VARCHAR AS id, 'new/' || p_brand AS path FROM part WHERE p_partkey % 3 > 0")
def replaced_in_place(spark, sf_dir):
    """A folder is rewritten from its own rows, twice; the pointer names what holds."""
    folder, columns = scratch_folder(spark), schemas.strings("id", "path")
    sinks.write_json_lines(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("old/"), "p_brand").alias("path")), folder)
    for change in (lambda df: df.where("id % 3 > 0"), lambda df: df.withColumn("path", F.replace("path", F.lit("old/"), F.lit("new/")))):
        sinks.write_version(change(readers.read_json_lines(spark, sinks.current_version(spark, folder), columns)), folder)
    return readers.read_json_lines(spark, sinks.current_version(spark, folder), columns)


@query("SELECT count(*)::BIGINT AS num_examples, avg(l_discount) < 1 AS sane, format('{:.4f}', round(count(*) FILTER (l_returnflag = 'R') / count(*), 4)) AS digest FROM lineitem")
def summary_file(spark, sf_dir):
    """The summary's file read back, and the rate of its digest."""
    path = f"{scratch_folder(spark)}/summary.json"
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_discount") < 1).alias("valid"), (F.col("l_returnflag") == "R").alias("exact"))
    digest = sinks.write_summary(metrics.json_rates(rows), path)
    rate = next(line.partition(": ")[2] for line in digest.splitlines() if line.startswith("exact_json_match_rate"))
    read = spark.read.option("multiLine", True).json(path)
    return read.select("num_examples", (F.col("valid_json_rate") == 1).alias("sane"), F.lit(rate).alias("digest"))


@query("SELECT upper(r_name) AS label_id, 'about ' || r_name AS title, r_regionkey % 2 = 0 AS has_image FROM region")
def media_documents(spark, sf_dir):
    """A folder of JSON documents: of two of a label in any case the later file holds, broken ones are left out, images may be missing."""
    folder, regions = scratch_folder(spark), table(spark, sf_dir, "region")
    image = F.concat("r_name", F.lit(".png"))
    early = regions.select(F.concat(F.lit("a"), "r_regionkey").alias("k"), F.lower("r_name").alias("label_id"), F.lit("replaced").alias("title"), image.alias("image_file"))
    late = regions.select(F.concat(F.lit("b"), "r_regionkey").alias("k"), F.upper("r_name").alias("label_id"), F.concat(F.lit("about "), "r_name").alias("title"), image.alias("image_file"))
    early.union(late).write.partitionBy("k").json(folder)
    for r in regions.where("r_regionkey % 2 = 0").select("r_name").collect():
        sinks.write_text("png", f"{folder}/{r['r_name']}.png")
    sinks.write_text("{broken", f"{folder}/k=c0/z.json")
    return readers.read_media(spark, folder).select("label_id", "title", F.col("image_path").isNotNull().alias("has_image"))


@query("SELECT n_regionkey, count(*) AS n FROM nation WHERE n_nationkey > 3 GROUP BY 1")
def stored_intermediate(spark, sf_dir):
    """A named table that is computed once and read by name."""
    sinks.as_table(table(spark, sf_dir, "nation").where("n_nationkey > 3"), "some_nations", stored=True)
    return spark.sql("SELECT n_regionkey, count(*) AS n FROM some_nations GROUP BY 1")


@query("SELECT string_agg(r_name, ';' ORDER BY r_regionkey) AS content FROM region")
def side_files(spark, sf_dir):
    """A small file beside a dataset's folder, found in the parent and copied."""
    base = scratch_folder(spark)
    names = ";".join(r["r_name"] for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect())
    sinks.write_text(names, f"{base}/records.csv")
    sinks.write_text("", f"{base}/split/x")
    sinks.copy_side_files(f"{base}/split", f"{base}/out")
    return spark.createDataFrame([(sinks.read_text(spark, f"{base}/out/records.csv"),)], "content string")
