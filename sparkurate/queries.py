"""Queries of the curation operators on the driver's tables, each with the DuckDB SQL that it must agree with.

Roles: lineitem rows are observations (their four keys together are unique), suppliers
observers, return flags labels, quantity and discount coordinates; parts are taxa.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkurate.functions import columns as C
from sparkurate.functions import jsonscan
from sparkurate.functions import values as V
from sparkurate.operators import lookups, metrics, rendering, sampling, splits
from sparkurate.plans import dataset, evaluation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
IDS_SQL = ", ".join(IDS)
DOC_KEY = "md5('23|' || doc_id::VARCHAR)"
LINE_KEY = f"md5(concat_ws('|', '23', {', '.join(f'{i}::VARCHAR' for i in IDS)}))"
EVENT_KEY = "md5('23|' || event_id::VARCHAR)"
# Three predictions in ten are off: a truth and a prediction for each event.
PRED_SQL = "CASE event_id % 10 WHEN 0 THEN 'view' WHEN 1 THEN 'other' WHEN 2 THEN 'click' ELSE event_type END"
KNOWN_EVENTS = ("view", "click", "purchase", "never")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flagged(lines: DataFrame) -> DataFrame:
    return lines.withColumn("flag", F.coalesce(F.col("l_quantity").between(10, 20), F.lit(False)))


def _pick(column: str, values: list[str | None]) -> Column:
    """The value of a literal list at column modulo its length."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.col(column) % len(values) + 1).cast("int"))


def _sql_pick(column: str, values: list[str | None]) -> str:
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[{column} % {len(values)} + 1]"


# --- projections, filters, predicates --------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 30 AND l_discount BETWEEN 0.02 AND 0.06 AND lower(l_returnflag) IN ('r', 'a')")
def bbox_filter(spark, sf_dir):
    box = {"longitude": (10.0, 30.0), "latitude": (0.02, 0.06)}
    inside = C.in_box(F.col("l_quantity"), F.col("l_discount"), box) & F.lower("l_returnflag").isin("r", "a")
    return table(spark, sf_dir, "lineitem").where(inside).select(*IDS)


@query("SELECT coalesce(l_quantity BETWEEN 14.05 AND 24.25 AND l_extendedprice / 1000 BETWEEN 49.0 AND 55.05, false) AS flag, count(*) AS n FROM lineitem GROUP BY 1")
def priority_flag(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(C.in_priority_region(F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("flag")).agg(F.count("*").alias("n"))


@query(
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE (x BETWEEN -25 AND 45 AND y BETWEEN 34 AND 72) OR (x BETWEEN -31.5 AND -13 AND y BETWEEN 63 AND 67.5) OR (x BETWEEN -11 AND 5 AND y BETWEEN 35 AND 44.5) GROUP BY 1".replace(
        "FROM lineitem", "FROM (SELECT l_returnflag, l_quantity - 40 AS x, l_extendedprice / 1000 AS y FROM lineitem)"
    )
)
def multi_box_any(spark, sf_dir):
    inside = C.in_any_box(F.col("l_quantity") - 40, F.col("l_extendedprice") / 1000)
    return table(spark, sf_dir, "lineitem").where(inside).groupBy("l_returnflag").agg(F.count("*").alias("n"))


_ANCESTRY = ["48460/47170", "48460/47126/211194", None, "1/47170/47126", "147170", "47126"]


@query(
    f"""SELECT p_partkey, CASE WHEN '/' || coalesce(a, '') || '/' LIKE '%/47170/%' OR t = '47170' THEN 'fungi' WHEN '/' || coalesce(a, '') || '/' LIKE '%/47126/%' OR t = '47126' THEN 'plants' END AS kingdom
FROM (SELECT p_partkey, {_sql_pick("p_partkey", _ANCESTRY)} AS a, CASE p_partkey % 17 WHEN 0 THEN '47170' WHEN 1 THEN '47126' ELSE p_partkey::VARCHAR END AS t FROM part)"""
)
def taxa_kingdom_case(spark, sf_dir):
    taxon = F.when(F.col("p_partkey") % 17 == 0, "47170").when(F.col("p_partkey") % 17 == 1, "47126").otherwise(F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", C.kingdom_of_taxon(taxon, _pick("p_partkey", _ANCESTRY)).alias("kingdom"))


_KINGDOMS = ["Fungi", " plantae ", "", None, "animalia", "PLANTS", "fungus-like plant"]
_KINGDOM_SQL = "CASE WHEN contains(lower({0}), 'fung') THEN 'fungi' WHEN contains(lower({0}), 'plant') THEN 'plants' END"


@query(f"SELECT p_partkey, {_KINGDOM_SQL.format('k')} AS kingdom FROM (SELECT p_partkey, {_sql_pick('p_partkey', _KINGDOMS)} AS k FROM part)")
def kingdom_norm(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.kingdom(_pick("p_partkey", _KINGDOMS)).alias("kingdom"))


@query(
    f"""SELECT label, count(*) AS n FROM (SELECT CASE WHEN l <> 'unknown' THEN l WHEN k = 'plants' THEN 'UNK_NON_TARGET_PLANT' WHEN k = 'fungi' THEN 'UNK_NON_TARGET_FUNGUS' ELSE 'UNK_OTHER_OR_AMBIGUOUS' END AS label
FROM (SELECT CASE WHEN p_size < 10 THEN p_brand ELSE 'unknown' END AS l, {_KINGDOM_SQL.format(_sql_pick("p_partkey", _KINGDOMS))} AS k FROM part)) GROUP BY 1"""
)
def unknown_subclass(spark, sf_dir):
    label = F.when(F.col("p_size") < 10, F.col("p_brand")).otherwise("unknown")
    return table(spark, sf_dir, "part").groupBy(C.unknown_subclass(label, _pick("p_partkey", _KINGDOMS)).alias("label")).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_name <> 'unknown' AND n_regionkey IN (0, 1)")
def known_targets(spark, sf_dir):
    return table(spark, sf_dir, "nation").where(C.is_known_target(F.col("n_name")) & F.col("n_regionkey").isin(0, 1)).select("n_nationkey", "n_name")


_LICENSES = ["CC-BY 4.0", "cc_by_nc", "CC0", "all-rights-reserved", " CC0 ", "cc-bync", "ccbync", "by", "creative commons by", "CreativeCommons-BY-NC", "cc-by-sa", "publicdomain", "CC BY-NC", "", None]
_NORM = "replace(replace(replace(replace({0}, 'creative commons', 'cc'), 'creativecommons', 'cc'), '_', '-'), ' ', '')"


@query(
    f"""SELECT p_partkey, CASE WHEN x LIKE 'cc0%' OR x = 'publicdomain' THEN 'CC0' WHEN x LIKE 'cc-by-nc%' OR x IN ('cc-bync', 'ccbync') THEN 'CC-BY-NC' WHEN x LIKE 'cc-by%' OR x IN ('by', 'ccby') THEN 'CC-BY' END AS license
FROM (SELECT p_partkey, lower({_NORM.format("coalesce(" + _sql_pick("p_partkey", _LICENSES) + ", '')")}) AS x FROM part)"""
)
def license_norm_sql(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.license_sql(_pick("p_partkey", _LICENSES)).alias("license"))


@query(
    f"""SELECT p_partkey, CASE WHEN x LIKE 'cc0%' OR x = 'publicdomain' THEN 'CC0' WHEN x LIKE 'cc-by-nc%' THEN 'CC-BY-NC' WHEN x LIKE 'cc-by%' OR x IN ('by', 'ccby') THEN 'CC-BY' WHEN x = 'ccbync' THEN 'CC-BY-NC' END AS license
FROM (SELECT p_partkey, {_NORM.format("lower(trim(" + _sql_pick("p_partkey", _LICENSES) + "))")} AS x FROM part)"""
)
def license_norm_py(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.license_text(_pick("p_partkey", _LICENSES)).alias("license"))


@query("SELECT p_partkey, 'https://inaturalist-open-data.s3.amazonaws.com/photos/' || p_partkey::VARCHAR || '/large.' || lower(p_brand) AS image_url, 'https://www.inaturalist.org/photos/' || p_partkey::VARCHAR AS source_url FROM part")
def url_build(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", C.photo_url(key, F.lower("p_brand")).alias("image_url"), C.photo_page(key).alias("source_url"))


@query("SELECT p_partkey, coalesce(nullif(CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN p_type END, ''), p_brand) AS name FROM part")
def nullif_coalesce(spark, sf_dir):
    first = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", C.first_filled(first, F.col("p_brand")).alias("name"))


# --- joins -----------------------------------------------------------------------------------

_MANIFEST = [("T_01", "fungi", "PARIS", "a", "alpha"), ("T_02", "plants", "Nation_1", "b", "beta"), ("T_03", "plants", "NATION_5", "c", "gamma"), ("T_04", "fungi", "Anemone nemorosa", "d", "delta")]
_MANIFEST_SQL = "(VALUES " + ", ".join(str(m) for m in _MANIFEST) + ") AS m(label_id, kingdom, scientific_name, polish_name, english_name)"


def _manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_MANIFEST, "label_id string, kingdom string, scientific_name string, polish_name string, english_name string")


@query(f"SELECT n.n_nationkey, n.n_name AS scientific_name, m.label_id, m.polish_name, m.english_name FROM nation n LEFT JOIN {_MANIFEST_SQL} ON lower(n.n_name) = lower(m.scientific_name)")
def ci_left_join(spark, sf_dir):
    taxa = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("scientific_name"))
    return lookups.match_names(taxa, _manifest(spark))


@query("SELECT o_orderpriority, count(*) AS n, sum(l_quantity)::BIGINT AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_discount BETWEEN 0.05 AND 0.07 GROUP BY 1")
def inner_join_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_discount").between(0.05, 0.07))
    joined = lines.join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query(
    f"""SELECT {IDS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 200000)) WHERE rn = 1"""
)
def semi_join_rank(spark, sf_dir):
    pool = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_orderkey").alias("l_orderkey"))
    kept = lookups.semi(table(spark, sf_dir, "lineitem").select(*IDS), pool, "l_orderkey")
    return sampling.best_per_key(kept, "l_orderkey", [F.col(c).asc_nulls_last() for c in ("l_linenumber", "l_partkey", "l_suppkey")])


@query("SELECT c_custkey, c_mktsegment, count(*) AS n FROM (SELECT o_custkey AS c_custkey FROM orders) JOIN customer USING (c_custkey) GROUP BY 1, 2")
def using_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return orders.join(table(spark, sf_dir, "customer"), "c_custkey").groupBy("c_custkey", "c_mktsegment").agg(F.count("*").alias("n"))


_CODES = ["T_01", "T_99", "UNK_NON_TARGET_PLANT", "unknown", None, "T_03"]


@query(
    f"""WITH c AS (SELECT * FROM {_MANIFEST_SQL} UNION ALL SELECT 'unknown', 'unknown', 'unknown', 'nieznane', 'unknown'),
p AS (SELECT p_partkey, l AS label_id, CASE WHEN l LIKE 'UNK_%' THEN 'unknown' ELSE l END AS k FROM (SELECT p_partkey, {_sql_pick("p_partkey", _CODES)} AS l FROM part))
SELECT p_partkey, p.label_id, coalesce(c.kingdom, 'unknown') AS kingdom, coalesce(c.scientific_name, 'unknown') AS scientific_name, coalesce(c.polish_name, 'nieznane') AS polish_name, coalesce(c.english_name, 'unknown') AS english_name FROM p LEFT JOIN c ON p.k = c.label_id"""
)
def lookup_fallback(spark, sf_dir):
    catalog = _manifest(spark).union(spark.createDataFrame([V.UNKNOWN_ENTRY], _manifest(spark).schema))
    return lookups.lookup_public(table(spark, sf_dir, "part").select("p_partkey", _pick("p_partkey", _CODES).alias("label_id")), catalog)


@query(f"SELECT p_partkey, CASE WHEN l LIKE 'UNK_%' THEN 'unknown' ELSE l END AS label FROM (SELECT p_partkey, {_sql_pick('p_partkey', _CODES)} AS l FROM part)")
def collapse_labels(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.collapse(_pick("p_partkey", _CODES)).alias("label"))


@query(f"SELECT p_partkey, CASE WHEN lower(l) IN ('t_01', 't_03') THEN l WHEN lower(l) = 'unk_non_target_plant' THEN 'unknown' ELSE 'unknown' END AS label FROM (SELECT p_partkey, {_sql_pick('p_partkey', [*_CODES, 't_01'])} AS l FROM part)")
def collapse_allowed(spark, sf_dir):
    label = _pick("p_partkey", [*_CODES, "t_01"])
    return table(spark, sf_dir, "part").select("p_partkey", C.collapse_allowed(label, ["T_01", "T_03", "UNK_NON_TARGET_PLANT", "unknown"], {"UNK_NON_TARGET_PLANT": "unknown"}).alias("label"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_missing(spark, sf_dir):
    return lookups.missing(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


_SPLIT_SQL = "CASE WHEN l_partkey % 20 < 17 THEN 'train' WHEN l_partkey % 20 < 19 THEN 'val' ELSE 'test' END"


@query(f"SELECT l_orderkey FROM (SELECT l_orderkey, {_SPLIT_SQL} AS split FROM lineitem) GROUP BY 1 HAVING count(DISTINCT split) > 1")
def split_leakage(spark, sf_dir):
    k = F.col("l_partkey") % 20
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(k < 17, "train").when(k < 19, "val").otherwise("test").alias("split"))
    return splits.leaking(rows, "l_orderkey")


@query(
    f"""SELECT doc_id, lang, split FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {DOC_KEY}, doc_id) AS rn FROM documents)
JOIN (VALUES ('train', 1, 40), ('val', 41, 50), ('test', 51, 60)) AS s(split, low, high) ON rn BETWEEN low AND high"""
)
def range_slot_join(spark, sf_dir):
    slots = lookups.slot_table(spark, {"train": 40, "val": 10, "test": 10})
    rows = sampling.ranked(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [sampling.order_key("doc_id"), F.col("doc_id")], most=60)
    return splits.in_slots(rows, slots).select("doc_id", "lang", "split")


@query("SELECT conv_id, turn, variant FROM conversations CROSS JOIN (VALUES ('legacy_full_json'), ('strict_label_only'), ('strict_label_only_with_taxonomy')) AS v(variant)")
def variant_cross_join(spark, sf_dir):
    return lookups.variants(table(spark, sf_dir, "conversations").select("conv_id", "turn"), list(rendering.STYLES))


_SYNONYMS = {"FRANCE": ("Gallia", "l'Hexagone"), "CHINA": ("Zhongguo",), "nowhere": ("x",)}
_SYNONYM_ROWS = ", ".join("('{}', '{}')".format(name, other.replace("'", "''")) for name, others in _SYNONYMS.items() for other in others)


@query(f"SELECT n_nationkey, n_name AS scientific_name FROM nation UNION ALL SELECT n_nationkey, s FROM nation JOIN (VALUES {_SYNONYM_ROWS}) AS v(n, s) ON n = n_name")
def alias_expand(spark, sf_dir):
    return lookups.with_aliases(table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("scientific_name")), _SYNONYMS)


@query("SELECT n_nationkey, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def display_join(spark, sf_dir):
    right = lookups.small(table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"))
    return table(spark, sf_dir, "nation").join(right, "n_regionkey", "left").select("n_nationkey", "r_name")


# --- windows, sampling, top-k ----------------------------------------------------------------

_CAPS = f"""SELECT * FROM (SELECT {IDS_SQL}, l_returnflag, coalesce(l_quantity BETWEEN 10 AND 20, false) AS flag,
row_number() OVER (PARTITION BY {{0}}coalesce(l_quantity BETWEEN 10 AND 20, false) ORDER BY {LINE_KEY}, {IDS_SQL}) AS rn FROM lineitem) WHERE (flag AND rn <= {{1}}) OR (NOT flag AND rn <= {{2}})"""


@query(f"SELECT {IDS_SQL}, l_returnflag, flag, rn FROM ({_CAPS.format('l_returnflag, ', 150, 250)})")
def stratified_cap(spark, sf_dir):
    lines = _flagged(table(spark, sf_dir, "lineitem")).select(*IDS, "l_returnflag", "flag")
    return sampling.stratified_cap(lines, ["l_returnflag"], "flag", IDS, (150, 250))


@query(f"SELECT {IDS_SQL}, flag, rn FROM ({_CAPS.format('', 400, 700)})")
def unknown_cap(spark, sf_dir):
    return sampling.stratified_cap(_flagged(table(spark, sf_dir, "lineitem")).select(*IDS, "flag"), [], "flag", IDS, (400, 700))


_FIRST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY coalesce(nullif(l_linenumber, 3), 2147483647), l_partkey, l_suppkey) AS n FROM lineitem WHERE l_shipdate > TIMESTAMP '1994-01-01') WHERE n = 1"


def _first_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate > timestamp '1994-01-01'")
    return sampling.best_per_key(lines, "l_orderkey", [F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(3)), F.lit(2**31 - 1)), F.col("l_partkey").asc_nulls_last(), F.col("l_suppkey").asc_nulls_last()])


@query(f"SELECT {IDS_SQL} FROM ({_FIRST})")
def best_per_key(spark, sf_dir):
    return _first_lines(spark, sf_dir).select(*IDS)


@query(f"SELECT {IDS_SQL}, l_returnflag FROM ({_FIRST}) WHERE l_returnflag IN ('R', 'A')")
def best_then_filter(spark, sf_dir):
    return _first_lines(spark, sf_dir).where(F.col("l_returnflag").isin("R", "A")).select(*IDS, "l_returnflag")


@query(
    f"""WITH o AS (SELECT l.*, coalesce(l_quantity BETWEEN 10 AND 20, false) AS flag, {LINE_KEY} AS k FROM lineitem l JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity BETWEEN 5 AND 45 AND o_orderstatus <> 'P'),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, flag ORDER BY k, {IDS_SQL}) AS rn FROM o) WHERE (flag AND rn <= 1500) OR (NOT flag AND rn <= 2500)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n1 FROM a) WHERE n1 = 1),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_suppkey ORDER BY flag DESC, k, {IDS_SQL}) AS n2 FROM b) WHERE n2 <= 2)
SELECT {IDS_SQL}, l_returnflag, flag FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY flag DESC, k, {IDS_SQL}) AS n3 FROM c) WHERE n3 <= 150"""
)
def diverse_topk(spark, sf_dir):
    """The candidate chain in small: box, join, caps, first of each key, diversified selection."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_quantity").between(5, 45)).select(*IDS, "l_returnflag", "l_quantity")
    capped = sampling.stratified_cap(_flagged(lines).join(orders, "l_orderkey"), ["l_returnflag"], "flag", IDS, V.KNOWN_CAPS)
    first = sampling.best_per_key(capped, "l_orderkey", [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")])
    return sampling.diverse_top(first, "l_returnflag", "l_orderkey", "l_suppkey", "flag", IDS, 150).select(*IDS, "l_returnflag", "flag")


@query(f"SELECT doc_id, lang, CASE WHEN rn <= 30 THEN 'train' WHEN rn <= 36 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {DOC_KEY}, doc_id) AS rn FROM documents) WHERE rn <= 42")
def split_slices(spark, sf_dir):
    return sampling.slices(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [sampling.order_key("doc_id"), F.col("doc_id")], {"train": 30, "val": 6, "test": 6})


@query("SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 500")
def strict_limit(spark, sf_dir):
    return sampling.first_rows(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 500)


_FILES = ["model-Q4_K_M.gguf", "a-q3_k_s.gguf", "b-q3_k_s-fixed.gguf", "big.gguf", "iq3-mobile.gguf", "q2_k.gguf"]


@query(
    f"""SELECT p_brand, name FROM (SELECT p_brand, name, row_number() OVER (PARTITION BY p_brand ORDER BY
CASE WHEN contains(l, 'q3_k_s') THEN 0 WHEN contains(l, 'q3_k_m') THEN 1 WHEN contains(l, 'q2_k') THEN 2 WHEN contains(l, 'iq3') THEN 3 WHEN contains(l, 'iq2') THEN 4 WHEN contains(l, 'q4_k_m') THEN 5 WHEN contains(l, 'q4_k_s') THEN 6 ELSE 100 END,
CASE WHEN contains(l, 'fixed') OR contains(l, 'mobile') THEN 0 ELSE 1 END, p_size DESC, name) AS rn FROM (SELECT *, lower(name) AS l FROM (SELECT p_brand, p_size, p_partkey::VARCHAR || {_sql_pick("p_partkey", _FILES)} AS name FROM part))) WHERE rn = 1"""
)
def min_by_composite(spark, sf_dir):
    files = table(spark, sf_dir, "part").select("p_brand", "p_size", F.concat(F.col("p_partkey").cast("string"), _pick("p_partkey", _FILES)).alias("name"))
    return sampling.min_by_ranks(files, ["p_brand"], "name", [C.name_rank(F.col("name")), C.fix_rank(F.col("name")), -F.col("p_size"), F.col("name")])


@query("SELECT p_brand, p_name FROM (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_name DESC) AS rn FROM part) WHERE rn = 1")
def max_by_group(spark, sf_dir):
    return sampling.max_by_size(table(spark, sf_dir, "part"), ["p_brand"], "p_name", "p_retailprice")


# --- set operations --------------------------------------------------------------------------


@query(
    f"""SELECT {IDS_SQL}, label FROM (SELECT {IDS_SQL}, l_returnflag AS label FROM ({_CAPS.format("l_returnflag, ", 50, 80).replace("FROM lineitem", "FROM lineitem WHERE l_returnflag <> 'N'")})
UNION ALL SELECT {IDS_SQL}, 'unknown' AS label FROM ({_CAPS.format("", 60, 90).replace("FROM lineitem", "FROM lineitem WHERE l_returnflag = 'N'")}))"""
)
def union_all_pool(spark, sf_dir):
    lines = _flagged(table(spark, sf_dir, "lineitem")).select(*IDS, "l_returnflag", "flag")
    known = sampling.stratified_cap(lines.where("l_returnflag <> 'N'"), ["l_returnflag"], "flag", IDS, (50, 80)).select(*IDS, F.col("l_returnflag").alias("label"))
    other = sampling.stratified_cap(lines.where("l_returnflag = 'N'"), [], "flag", IDS, (60, 90)).select(*IDS, F.lit(V.UNKNOWN).alias("label"))
    return known.unionByName(other)


@query("SELECT column_name FROM (VALUES ('p_brand'), ('label_id'), ('kingdom'), ('p_size')) AS r(column_name) EXCEPT SELECT column_name FROM (DESCRIBE SELECT * FROM part)")
def schema_diff(spark, sf_dir):
    return lookups.schema_difference(["p_brand", "label_id", "kingdom", "p_size"], table(spark, sf_dir, "part"))


# --- aggregates ------------------------------------------------------------------------------


@query("SELECT count(*) FILTER (l_returnflag <> 'N') AS known_rows, count(*) FILTER (l_returnflag = 'N') AS unknown_rows, count(*) AS all_rows FROM lineitem")
def conditional_counts(spark, sf_dir):
    one = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    return table(spark, sf_dir, "lineitem").agg(one(F.col("l_returnflag") != "N").alias("known_rows"), one(F.col("l_returnflag") == "N").alias("unknown_rows"), F.count("*").alias("all_rows"))


@query(f"SELECT count(*) AS n FROM ({_CAPS.format('l_returnflag, ', 150, 250)})")
def pool_count(spark, sf_dir):
    return stratified_cap(spark, sf_dir).agg(F.count("*").alias("n"))


_DOC_SPLIT = "CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'val' ELSE 'test' END"


def _split_docs(spark, sf_dir):
    k = F.col("doc_id") % 10
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label_id"), F.when(k < 8, "train").when(k == 8, "val").otherwise("test").alias("split"))


@query(f"SELECT {_DOC_SPLIT} AS split, count(*) AS n FROM documents GROUP BY 1")
def split_counts(spark, sf_dir):
    return _split_docs(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


_QUOTA_ROWS = [(s, k, n) for s, n in (("train", 100), ("val", 12), ("test", 12)) for k in ("en", "de", "fr", "xx")]


@query(
    f"""SELECT split, label_id, coalesce(found, 0) AS found, coalesce(quota, 0) AS quota FROM (SELECT {_DOC_SPLIT} AS split, lang AS label_id, count(*) AS found FROM documents GROUP BY 1, 2)
FULL JOIN (SELECT a AS split, b AS label_id, c::BIGINT AS quota FROM (VALUES {", ".join(map(str, _QUOTA_ROWS))}) AS q(a, b, c)) USING (split, label_id) WHERE coalesce(found, 0) <> coalesce(quota, 0)"""
)
def quota_check(spark, sf_dir):
    return metrics.quota_violations(_split_docs(spark, sf_dir), spark.createDataFrame(_QUOTA_ROWS, "split string, label_id string, quota long"))


@query(
    """SELECT label_id, sum(missing)::BIGINT AS missing FROM (
SELECT q.label_id, 150 - coalesce(n, 0) AS missing FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('xx')) AS q(label_id) LEFT JOIN (SELECT lang AS label_id, count(*) AS n FROM documents GROUP BY 1) d ON q.label_id = d.label_id WHERE 150 - coalesce(n, 0) > 0
UNION ALL SELECT lang, count(*) FROM documents WHERE n_chars > 9000 GROUP BY 1) GROUP BY 1"""
)
def shortage_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("n_chars", F.col("lang").alias("label_id"))
    quotas = spark.createDataFrame([(k, 150) for k in ("en", "de", "fr", "es", "xx")], "label_id string, quota int")
    failed = docs.where("n_chars > 9000").groupBy("label_id").agg(F.count("*").alias("missing"))
    return sampling.add_shortages(sampling.shortages(docs, quotas), failed)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return metrics.duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    """SELECT passed, warned, failed, passed || ' PASS / ' || warned || ' WARN / ' || failed || ' FAIL' AS line FROM
(SELECT count(*) FILTER (o_orderstatus = 'F') AS passed, count(*) FILTER (o_orderstatus = 'P') AS warned, count(*) FILTER (o_orderstatus = 'O') AS failed FROM orders)"""
)
def status_summary(spark, sf_dir):
    named = F.when(F.col("o_orderstatus") == "F", "PASS").when(F.col("o_orderstatus") == "P", "WARNING").when(F.col("o_orderstatus") == "O", "FAIL")
    return metrics.status_summary(table(spark, sf_dir, "orders").select(named.alias("status")))


def _truth_and_pred(spark, sf_dir):
    k = F.col("event_id") % 10
    pred = F.when(k == 0, "view").when(k == 1, "other").when(k == 2, "click").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("place"), F.col("event_type").alias("truth"), pred.alias("pred"))


def _known_events(spark):
    return spark.createDataFrame([(k, i) for i, k in enumerate(KNOWN_EVENTS)], "label string, label_place int")


_PAIRS = f"pairs AS (SELECT event_id, event_type AS truth, {PRED_SQL} AS pred FROM events), known AS (SELECT * FROM (VALUES {', '.join(f'({k!r}, {i})' for i, k in enumerate(KNOWN_EVENTS))}) AS k(label, label_place))"
_CLASSES = f"""WITH {_PAIRS}, dom AS (SELECT label FROM known UNION SELECT truth FROM pairs UNION SELECT pred FROM pairs),
c AS (SELECT label, (SELECT count(*) FROM pairs WHERE truth = label AND pred = label) AS tp, (SELECT count(*) FROM pairs WHERE truth <> label AND pred = label) AS fp, (SELECT count(*) FROM pairs WHERE truth = label AND pred <> label) AS fn FROM dom),
r AS (SELECT *, tp + fn AS support, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r)"""


@query(f"WITH {_PAIRS} SELECT truth, pred, count(*) AS n, min(event_id) AS first_place FROM pairs GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion(_truth_and_pred(spark, sf_dir))


@query(f"{_CLASSES} SELECT label, tp, fp, fn, support, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f")
def per_class_metrics(spark, sf_dir):
    found = metrics.per_class(metrics.confusion(_truth_and_pred(spark, sf_dir)), _known_events(spark))
    return found.select("label", "tp", "fp", "fn", "support", *[F.round(k, 9).alias(k) for k in ("precision", "recall", "f1")])


@query(
    f"""{_CLASSES} SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(sum(f1) FILTER (label IN (SELECT label FROM known)) / count(*) FILTER (label IN (SELECT label FROM known)), 9) AS macro_f1_known,
round(sum(f1) / count(*), 9) AS macro_f1_all, 0.0::DOUBLE AS unknown_precision, 0.0::DOUBLE AS unknown_recall, 0.0::DOUBLE AS unknown_f1 FROM f"""
)
def macro_metrics(spark, sf_dir):
    known = _known_events(spark)
    found = metrics.macro(metrics.per_class(metrics.confusion(_truth_and_pred(spark, sf_dir)), known), known)
    return found.select(*[F.round(k, 9).alias(k) for k in found.columns])


@query(f"WITH {_PAIRS} SELECT label FROM known UNION SELECT truth FROM pairs UNION SELECT pred FROM pairs")
def label_domain(spark, sf_dir):
    return metrics.label_domain(metrics.confusion(_truth_and_pred(spark, sf_dir)), _known_events(spark))


@query(f"WITH {_PAIRS} SELECT truth, pred, n FROM (SELECT truth, pred, count(*) AS n, min(event_id) AS f FROM pairs WHERE truth <> pred GROUP BY 1, 2) JOIN known ON truth = label ORDER BY n DESC, label_place, f LIMIT 25")
def top_confusions(spark, sf_dir):
    return metrics.top_confusions(metrics.confusion(_truth_and_pred(spark, sf_dir)), _known_events(spark))


@query(f"WITH {_PAIRS} SELECT count(*) FILTER (truth = pred) AS correct, count(*) AS total, round(count(*) FILTER (truth = pred) / count(*), 9) AS accuracy FROM pairs")
def suite_accuracy(spark, sf_dir):
    return metrics.suite_accuracy(_truth_and_pred(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 9))


@query("SELECT conv_id, string_agg(role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS text FROM conversations GROUP BY 1")
def ordered_string_agg(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(": ", "role", F.coalesce("text", F.lit(""))).alias("line"))
    return metrics.ordered_text(lines, ["conv_id"], "turn", "line", "\n")


# --- free text and JSON ----------------------------------------------------------------------

# Answers are made of the events' own JSON and types by one expression that both engines run; DuckDB
# finds objects by a pattern and reads them with its JSON functions.
_ANSWER = """CASE event_id % 8 WHEN 0 THEN concat('{"label_id": "', event_type, '"}') WHEN 1 THEN concat('so ', props, ' or {"label_id": "x"}') WHEN 2 THEN props WHEN 3 THEN event_type WHEN 4 THEN '{"label_id": "  "}'
WHEN 5 THEN concat('{bad} {"label_id": " ', event_type, ' "} ', props) WHEN 6 THEN concat('[', event_id, ']') ELSE concat('{"label_id": ', event_id, '}') END"""
_OBJECTS = f"""answers AS (SELECT *, {_ANSWER} AS text FROM events), objects AS (SELECT *, nullif(regexp_extract(text, '\\{{"[^{{}}]*\\}}'), '') AS parsed FROM answers),
read AS (SELECT *, trim(CASE WHEN json_type(parsed, '$.label_id') = 'VARCHAR' THEN json_extract_string(parsed, '$.label_id') ELSE '' END) AS own FROM objects),
found AS (SELECT *, CASE WHEN parsed IS NULL THEN 'invalid_json' WHEN own = '' THEN 'missing_label' ELSE own END AS label FROM read)"""


def _answers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.expr(_ANSWER).alias("text"))


@query(f"WITH {_OBJECTS} SELECT event_id, parsed IS NOT NULL AND json_valid(parsed) AS valid, parsed FROM found")
def find_json_object(spark, sf_dir):
    return _answers(spark, sf_dir).select("event_id", jsonscan.scan(F.col("text")).alias("s")).select("event_id", "s.valid", "s.parsed")


@query(f"WITH {_OBJECTS} SELECT event_id, label FROM found")
def extract_label(spark, sf_dir):
    return _answers(spark, sf_dir).select("event_id", jsonscan.scan(F.col("text")).alias("s")).select("event_id", "s.label")


def _results(spark, sf_dir):
    truth = F.concat(F.lit('{"label_id": "'), F.col("event_type"), F.lit('"}'))
    return _answers(spark, sf_dir).select(F.col("event_id").alias("place"), truth.alias("labels"), F.col("text").alias("response"), F.array(F.concat(F.lit("images/"), F.col("event_id").cast("string"))).alias("images"))


@query(
    f"""WITH {_OBJECTS} SELECT count(*) AS num_examples, round(count(parsed) / count(*), 9) AS valid_json_rate, round(count(*) FILTER (parsed = '{{"label_id": "' || event_type || '"}}') / count(*), 9) AS exact_json_match_rate FROM found"""
)
def json_rates(spark, sf_dir):
    rates = metrics.json_rates(evaluation.scanned(_results(spark, sf_dir)))
    return rates.select("num_examples", *[F.round(k, 9).alias(k) for k in ("valid_json_rate", "exact_json_match_rate")])


@query(
    f"""WITH {_OBJECTS} SELECT event_id AS place, 'images/' || event_id AS image, '{{"label_id": "' || event_type || '"}}' AS labels, text AS response FROM found
WHERE label IN ('invalid_json', 'missing_label') ORDER BY event_id LIMIT 50"""
)
def invalid_examples(spark, sf_dir):
    return evaluation.invalid_examples(evaluation.scanned(_results(spark, sf_dir)))


@query(
    """SELECT conv_id, first(json_extract_string(c, '$.label_id') ORDER BY turn) AS label FROM (SELECT conv_id, turn, '{"label_id":"L' || turn || '"}' AS c FROM conversations WHERE lower(role) = 'assistant') GROUP BY 1
UNION ALL SELECT conv_id, NULL FROM conversations GROUP BY 1 HAVING count(*) FILTER (lower(role) = 'assistant') = 0"""
)
def assistant_label(spark, sf_dir):
    said = F.concat(F.lit('{"label_id":"L'), F.col("turn").cast("string"), F.lit('"}'))
    chats = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", said.alias("content")))).alias("messages"))
    return chats.select("conv_id", C.assistant_label(F.col("messages")).alias("label"))


@query(
    """SELECT page_id, CASE WHEN contains(u, '/square.') THEN replace(u, '/square.', '/large.') WHEN contains(u, '/small.') THEN replace(u, '/small.', '/large.') WHEN contains(u, '/medium.') THEN replace(u, '/medium.', '/large.')
WHEN contains(u, '/original.') THEN replace(u, '/original.', '/large.') ELSE u END AS url FROM (SELECT page_id, trim(url) || (['/medium.jpg', '/square.png', '/large.jpg', '/original.jpeg/small.x'])[page_id % 4 + 1] AS u FROM pages)"""
)
def url_promote(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.promote_size(F.concat(F.lit("  "), F.col("url"), _pick("page_id", ["/medium.jpg", "/square.png", "/large.jpg", "/original.jpeg/small.x"]))).alias("url"))


@query(
    """SELECT page_id, unnest(CASE WHEN contains(u, '/large.') THEN [u, replace(u, '/large.', '/original.'), replace(u, '/large.', '/medium.'), replace(u, '/large.', '/small.'), replace(u, '/large.', '/square.')] ELSE [u] END) AS url
FROM (SELECT page_id, url || (['/large.jpg', '/x.jpg'])[page_id % 2 + 1] AS u FROM pages)"""
)
def url_fallbacks(spark, sf_dir):
    url = F.concat(F.col("url"), _pick("page_id", ["/large.jpg", "/x.jpg"]))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(C.size_fallbacks(url)).alias("url"))


_PATH = "CASE page_id % 5 WHEN 0 THEN replace(url, '/', chr(92)) WHEN 1 THEN concat('/srv/images/', url) WHEN 2 THEN concat('raw_cache//./', url) WHEN 3 THEN concat('raw_cache/x/images/', page_id) ELSE url END"


@query(
    f"""WITH p AS (SELECT page_id, list_filter(string_split(replace({_PATH}, chr(92), '/'), '/'), lambda x: x <> '') AS parts FROM pages),
i AS (SELECT *, coalesce(nullif(list_position(parts, 'images'), 0), nullif(list_position(parts, 'raw_cache'), 0), greatest(len(parts) - 2, 0)) AS k FROM p)
SELECT page_id, '/root/' || array_to_string(list_filter(parts[k + 1:], lambda x: x <> '.'), '/') AS path FROM i"""
)
def path_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.rebase_path(F.expr(_PATH), "/root/").alias("path"))


@query("SELECT doc_id, CASE WHEN length(c) > 520 THEN substr(c, 1, 517) || '...' ELSE c END AS text FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \\r\\n\\t]+', ' ', 'g')) AS c FROM documents)")
def compact_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", C.shorten(F.col("text")).alias("text"))


_REPLY = """CASE event_id % 6 WHEN 0 THEN concat('look: {"n": ', event_id, ', "label_id" : "', event_type, '"} and {"label_id":"', event_id, '"}') WHEN 1 THEN concat('{LABEL_ID:', event_type, '}') WHEN 2 THEN props
WHEN 3 THEN concat('label_id: ', event_type) WHEN 4 THEN concat('} {"label_id":" ', event_type, ' "') ELSE concat('"label_id":"', event_id, '" ', props) END"""
_QUOTED = "'(?i)\"label_id\"\\s*:\\s*\"([^\"]+)\"'"


@query(f"""SELECT event_id, coalesce(nullif(regexp_extract(regexp_extract(trim({_REPLY}), '(?s)\\{{.*\\}}'), '(?i)"?label_id"?\\s*:\\s*"?([A-Za-z0-9_]+)"?', 1), ''), 'unknown') AS label FROM events""")
def parse_label_mobile(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", C.label_mobile(F.expr(_REPLY)).alias("label"))


@query(f"""SELECT event_id, coalesce(trim(regexp_extract_all(out, {_QUOTED}, 1)[-1]), trim(regexp_extract_all(err, {_QUOTED}, 1)[-1]), 'unknown') AS label
FROM (SELECT event_id, {_REPLY} AS out, CASE WHEN event_id % 4 = 0 THEN concat('failed "label_id" : "', event_type, '"') ELSE event_type END AS err FROM events)""")
def parse_label_desktop(spark, sf_dir):
    error = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('failed "label_id" : "'), "event_type", F.lit('"'))).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", C.label_desktop(F.expr(_REPLY), error).alias("label"))


_MADE_LABEL = "CASE p_partkey % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN lower(concat('PLANT_', lpad(cast(p_partkey % 25 as string), 2, '0'))) WHEN 2 THEN concat('FUN_', cast(p_partkey % 25 as string)) WHEN 3 THEN p_brand ELSE concat(CASE WHEN p_partkey % 2 = 0 THEN 'PLANT_' ELSE 'FUN_' END, lpad(cast(p_partkey % 25 as string), 2, '0')) END"


@query(
    f"""SELECT l AS label, l = 'unknown' OR (split_part(l, '_', 1) IN ('PLANT', 'FUN') AND len(string_split(l, '_')) = 2 AND length(split_part(l, '_', 2)) = 2 AND coalesce(try_cast(split_part(l, '_', 2) AS INT) BETWEEN 1 AND 20, false)) AS valid, count(*) AS n
FROM (SELECT {_MADE_LABEL} AS l FROM part) GROUP BY 1, 2"""
)
def label_valid(spark, sf_dir):
    labels = table(spark, sf_dir, "part").select(F.expr(_MADE_LABEL).alias("label"))
    return labels.groupBy("label", C.label_valid(F.col("label")).alias("valid")).agg(F.count("*").alias("n"))


_OUTPUT = f"CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN '' ELSE concat('{{\"label_id\":\"', CASE WHEN p_partkey % 3 = 0 THEN 'ł é ' ELSE '' END, {_MADE_LABEL}, CASE WHEN p_partkey % 2 = 0 THEN '\"}}' ELSE ' and so on' END) END"


@query(
    f"""WITH o AS (SELECT p_partkey, nullif(regexp_extract({_OUTPUT}, '^\\{{"label_id":"[^A-Za-z0-9_]*([A-Za-z0-9_]+)', 1), '') AS l FROM part)
SELECT p_partkey, '{{"label_id":"' || CASE WHEN l = 'unknown' OR (l[:-4] IN ('PLANT', 'FUN') AND l[-3] = '_' AND try_cast(l[-2:] AS INT) BETWEEN 1 AND 20) THEN l ELSE 'unknown' END || '"}}' AS output FROM o"""
)
def normalize_output(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.normal_output(F.expr(_OUTPUT)).alias("output"))


_IMAGE_URL = "CASE page_id % 5 WHEN 0 THEN concat(url, '.PNG') WHEN 1 THEN concat(split_part(url, '?', 1), '.a.JpEg?x=.gif') WHEN 2 THEN concat(split_part(url, '#', 1), '/x.webp#y.png') WHEN 3 THEN 'http://h.jpg' ELSE url END"


@query(
    f"""SELECT page_id, coalesce(nullif(lower(regexp_extract(regexp_replace(split_part(split_part(u, '#', 1), '?', 1), '^[a-z]+://[^/]*', ''), '(?i)\\.(jpg|jpeg|png|webp)$')), ''), '.jpg') AS extension FROM (SELECT page_id, {_IMAGE_URL} AS u FROM pages)"""
)
def image_extension(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.image_extension(F.expr(_IMAGE_URL)).alias("extension"))


# --- composite operators ---------------------------------------------------------------------

_ALLOCATION = """WITH c AS (SELECT lang AS label, count(*) AS capacity FROM documents GROUP BY 1), t AS (SELECT *, sum(capacity) OVER ()::BIGINT AS total FROM c),
f AS (SELECT *, 137 * capacity // total AS share, 137 * capacity % total AS fraction FROM t), r AS (SELECT *, row_number() OVER (ORDER BY fraction DESC, capacity DESC, label) AS rn, 137 - sum(share) OVER () AS rest FROM f)
SELECT label, capacity, (share + CASE WHEN rn <= rest THEN 1 ELSE 0 END)::BIGINT AS share FROM r"""


@query(_ALLOCATION)
def proportional_allocation(spark, sf_dir):
    return splits.allocation(table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("label")).agg(F.count("*").alias("capacity")), 137)


_KINGDOM_OF_DOC = "CASE WHEN doc_id % 5 < 3 THEN 'plants' ELSE 'fungi' END"


@query(
    f"""WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN {_KINGDOM_OF_DOC} ELSE lang END AS g, {DOC_KEY} AS k, lang FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, doc_id) AS rn FROM d),
cap AS (SELECT count(*) FILTER (g = 'plants') AS p, count(*) FILTER (g = 'fungi') AS f FROM d),
a1 AS (SELECT p, f, 60 * p // (p + f) AS b, 60 * p % (p + f) AS r FROM cap), s1 AS (SELECT p, f, b + CASE WHEN r > 0 AND (2 * r > p + f OR (2 * r = p + f AND p >= f)) THEN 1 ELSE 0 END AS tp FROM a1),
a2 AS (SELECT p - tp AS p, f - (60 - tp) AS f, tp FROM s1), a3 AS (SELECT *, 20 * p // (p + f) AS b, 20 * p % (p + f) AS r FROM a2),
s2 AS (SELECT tp, b + CASE WHEN r > 0 AND (2 * r > p + f OR (2 * r = p + f AND p >= f)) THEN 1 ELSE 0 END AS vp FROM a3)
SELECT doc_id::VARCHAR AS observation_id, CASE g WHEN 'plants' THEN 'UNK_NON_TARGET_PLANT' WHEN 'fungi' THEN 'UNK_NON_TARGET_FUNGUS' ELSE g END AS label_id, CASE WHEN lang = 'en' THEN 'unknown' ELSE lang END AS public_label_id,
  CASE WHEN rn <= CASE g WHEN 'plants' THEN tp WHEN 'fungi' THEN 60 - tp ELSE 15 END THEN 'train' ELSE 'val' END AS split
FROM ranked, s2 WHERE rn <= CASE g WHEN 'plants' THEN tp + vp WHEN 'fungi' THEN 80 - tp - vp ELSE 20 END AND (lang = 'en' OR lang IN ('de', 'fr'))"""
)
def build_splits(spark, sf_dir):
    """Languages are labels, English is unknown and told apart by a made-up kingdom."""
    docs = table(spark, sf_dir, "documents")
    records = docs.select(F.when(F.col("lang") == "en", V.UNKNOWN).otherwise(F.col("lang")).alias("label_id"), F.when(F.col("doc_id") % 5 < 3, "plants").otherwise("fungi").alias("kingdom"), F.col("doc_id").cast("string").alias("observation_id"), F.col("doc_id"))
    built = splits.build_splits(records, ["de", "fr"], {"train": 15, "val": 5}, {"train": 60, "val": 20}, extra=0, ids=("doc_id",))
    return built.select("observation_id", "label_id", "public_label_id", "split")


@query(
    f"""SELECT doc_id, lang, NULL::VARCHAR AS repeat_reason FROM documents UNION ALL
SELECT doc_id, lang, 'hard_negative_oversample' FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {DOC_KEY}, doc_id) AS rn FROM documents WHERE lang IN ('de', 'es', 'xx')) WHERE rn <= 60"""
)
def hard_negative_oversample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(None).cast("string").alias("repeat_reason"))
    return sampling.oversample(docs, "lang", ("de", "es", "xx"), ["doc_id"], 60)


@query("SELECT conv_id, turn, '{\"label_id\": \"' || role || '\", \"kingdom\": \"k\", \"scientific_name\": \"ł \\\"' || turn || '\\\"\", \"polish_name\": \"p\"}' AS payload FROM conversations")
def response_payload(spark, sf_dir):
    said = rendering.answer("full_json", F.col("role"), F.lit("k"), F.concat(F.lit('ł "'), F.col("turn").cast("string"), F.lit('"')), F.lit("p"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("payload"))


_CATALOG_SQL = "(VALUES ('user', 'plants'), ('assistant', 'fungi'), ('system', 'plants')) AS c(label_id, kingdom)"


@query(
    f"""SELECT conv_id, turn, unnest(['system', 'user', 'assistant']) AS role, unnest(['{V.LEGACY_SYSTEM}', '{V.LEGACY_USER}', '{{"label_id": "' || role || '", "kingdom": "' || c.kingdom || '", "scientific_name": "s_' || role || '", "polish_name": "p_' || role || '"}}']) AS content, 'img/' || conv_id AS image
FROM conversations JOIN {_CATALOG_SQL} ON role = c.label_id"""
)
def chat_examples(spark, sf_dir):
    catalog = [(r, k, f"s_{r}", f"p_{r}", f"e_{r}") for r, k in (("user", "plants"), ("assistant", "fungi"), ("system", "plants"))]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("label_id"), F.concat(F.lit("img/"), F.col("conv_id").cast("string")).alias("image_path"))
    found = rendering.with_entry(rows, catalog)
    said = rendering.answer("full_json", *[F.col(k) for k in ("_label", "_kingdom", "_scientific", "_polish")])
    messages = rendering.chat(F.lit(rendering.system_prompt("legacy_full_json", catalog)), F.lit(rendering.user_prompt("legacy_full_json", catalog)), said)
    return found.select("conv_id", "turn", F.explode(messages).alias("m"), F.col("image_path").alias("image")).select("conv_id", "turn", "m.role", "m.content", "image")


@query("SELECT conv_id, turn FROM conversations c WHERE conv_id % 3 = 0 OR NOT EXISTS (SELECT 1 FROM (VALUES (0), (1)) AS s(s) WHERE conv_id + s NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es'))")
def all_refs_exist(spark, sf_dir):
    refs = F.when(F.col("conv_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("conv_id").cast("string"), (F.col("conv_id") + 1).cast("string")))
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", refs.alias("images"))
    files = table(spark, sf_dir, "documents").where("lang <> 'es'").select(F.col("doc_id").cast("string").alias("path"))
    return lookups.references_exist(chats, "images", files, ["conv_id", "turn"]).select("conv_id", "turn")


@query(
    f"""WITH r AS (SELECT doc_id, lang AS label_id, {_DOC_SPLIT} AS split, doc_id // 2 AS obs FROM documents)
SELECT 'foreign_label' AS "check", label_id AS key, count(*) AS n FROM r WHERE label_id NOT IN ('en', 'de', 'fr', 'unknown') GROUP BY 2
UNION ALL SELECT 'no_attribution', doc_id::VARCHAR, count(*) FROM r WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 2
UNION ALL SELECT 'several_splits', obs::VARCHAR, 1 FROM r GROUP BY obs HAVING count(DISTINCT split) > 1
UNION ALL SELECT 'quota', split || '/' || label_id, coalesce(found, 0) - coalesce(quota, 0) FROM (SELECT split, label_id, count(*) AS found FROM r GROUP BY 1, 2)
  FULL JOIN (SELECT a AS split, b AS label_id, c::BIGINT AS quota FROM (VALUES {", ".join(map(str, _QUOTA_ROWS))}) AS q(a, b, c)) USING (split, label_id) WHERE coalesce(found, 0) <> coalesce(quota, 0)"""
)
def dataset_violations(spark, sf_dir):
    rows = _split_docs(spark, sf_dir).select("label_id", "split", F.col("doc_id").cast("string").alias("photo_id"), F.expr("doc_id div 2").alias("observation_id"), F.lit(None).cast("string").alias("repeat_reason"))
    labels = spark.createDataFrame([(k,) for k in ("en", "de", "fr", "unknown")], "label_id string")
    attribution = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("photo_id"))
    return dataset.violations(rows, labels, attribution, spark.createDataFrame(_QUOTA_ROWS, "split string, label_id string, quota long"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# A prompt as its sentences and, where it lists labels, the catalog's lines.
_LISTED = "(SELECT string_agg('- ' || label_id || ' = s_' || label_id, chr(10) ORDER BY place) FROM (VALUES ('user', 0), ('assistant', 1), ('system', 2)) AS l(label_id, place))"
_SYSTEMS = {
    "legacy_full_json": _quoted(V.LEGACY_SYSTEM),
    "strict_label_only": _quoted(" ".join((V.CLASSIFY, V.JSON_ONLY, V.OUTPUTS[False], V.NO_INVENTION))),
    "strict_label_only_with_taxonomy": f"concat_ws(chr(10), {', '.join(map(_quoted, (V.CLASSIFY, V.JSON_ONLY, V.CHOOSE, V.FALLBACK[False], V.NO_INVENTION, 'Allowed labels:')))}, {_LISTED}, {_quoted(V.LAST_LINE[False])})",
}
_FULL = """'{"label_id": "' || role || '", "kingdom": "' || kingdom || '", "scientific_name": "s_' || role || '", "polish_name": "p_' || role || '"}'"""
_ALONE = """'{"label_id": "' || role || '"}'"""


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS variant, {system} AS system, {_quoted(V.LEGACY_USER if i == 0 else V.USER + V.USER_FALLBACK[False])} AS user_said, {_FULL if i == 0 else _ALONE} AS answer, count(*) AS n FROM conversations JOIN {_CATALOG_SQL} ON role = c.label_id GROUP BY role, kingdom"
        for i, (name, system) in enumerate(_SYSTEMS.items())
    )
)
def prompt_ablation(spark, sf_dir):
    manifest = [(r, k, f"s_{r}", f"p_{r}", f"e_{r}") for r, k in (("user", "plants"), ("assistant", "fungi"), ("system", "plants"))]
    rows = table(spark, sf_dir, "conversations").select(F.col("role").alias("label_id"), F.lit("i").alias("image_path"))
    said = [F.element_at("messages", i)["content"].alias(k) for i, k in ((1, "system"), (2, "user_said"), (3, "answer"))]
    return rendering.ablation(rows, manifest).groupBy("variant", *said).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (n_regionkey <> 3) AS kept, count(*) FILTER (n_regionkey = 3) AS removed, count(*) AS total FROM nation")
def kept_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "nation")
    return metrics.kept_counts(rows, rows.where("n_regionkey <> 3"))
