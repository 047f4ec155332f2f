"""Queries of smaller functions: parsing, decomposition, provenance and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.functions import geo as G
from seamline.functions import text as X
from seamline.operators import judgements as J
from seamline.plans import query
from seamline.plans.names import _LABELS, labels
from seamline.sources.views import table, view


@query("""
WITH t AS (SELECT p_partkey AS id, concat('head ', p_name, repeat(concat('<', p_brand, '>'), CASE WHEN p_size % 3 = 0 THEN 12 ELSE 4 END)) AS text, p_brand, p_name, p_size FROM part)
SELECT id, CASE WHEN p_size % 3 = 0 THEN concat('head ', p_name, '<', p_brand, '>') ELSE text END AS cleaned FROM t
""")
def repeated_tail(spark, d):
    text = F.concat(F.lit("head "), F.col("p_name"), F.expr("repeat(concat('<', p_brand, '>'), CASE WHEN p_size % 3 = 0 THEN 12 ELSE 4 END)"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), J.repeated_tail(text, least=40).alias("cleaned"))


@query("""
WITH b AS (SELECT c_custkey AS id, concat(c_custkey % 50, ',', -120 - c_custkey % 9, ',', c_custkey % 50 + c_custkey % 3, ',', CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE CAST(-118 + c_custkey % 5 AS STRING) END) AS box FROM customer),
p AS (SELECT id, TRY_CAST(split_part(box, ',', 1) AS DOUBLE) AS s, TRY_CAST(split_part(box, ',', 2) AS DOUBLE) AS w, TRY_CAST(split_part(box, ',', 3) AS DOUBLE) AS n, TRY_CAST(split_part(box, ',', 4) AS DOUBLE) AS e FROM b)
SELECT id, s, w, n, e FROM p WHERE s < n AND w < e
""")
def parse_boxes(spark, d):
    """Boxes given as text in the order S,W,N,E; malformed and turned ones are left out."""
    text = F.expr("concat(c_custkey % 50, ',', -120 - c_custkey % 9, ',', c_custkey % 50 + c_custkey % 3, ',', CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE CAST(-118 + c_custkey % 5 AS STRING) END)")
    parts = F.split(text, ",")
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), *(parts[i].try_cast("double").alias(c) for i, c in enumerate("swne")))
    return rows.where("s < n AND w < e")


@query("""
WITH a AS (SELECT seg_id, 0.5e0 + seg_id % 7 * 0.125e0 AS a11, seg_id % 5 * 0.0625e0 AS a12, seg_id % 3 * 0.0625e0 AS a21, -0.5e0 - seg_id % 4 * 0.125e0 AS a22 FROM v_segments),
n AS (SELECT *, sqrt(a11 * a11 + a21 * a21) AS sx, sqrt(a12 * a12 + a22 * a22) AS sy FROM a)
SELECT seg_id, round(sx, 6) AS sx, round(sy, 6) AS sy, round(degrees(atan2(a21, a11)), 4) AS rotation, round(degrees(acos(least(1.0e0, greatest(-1.0e0, (a11 * a12 + a21 * a22) / (sx * sy))))) - 90, 4) AS shear FROM n
""")
def transform_summary(spark, d):
    sql = "SELECT seg_id, 0.5e0 + seg_id % 7 * 0.125e0 AS a11, seg_id % 5 * 0.0625e0 AS a12, seg_id % 3 * 0.0625e0 AS a21, -0.5e0 - seg_id % 4 * 0.125e0 AS a22 FROM {v}"
    found = G.decomposed(*(F.col(c) for c in ("a11", "a12", "a21", "a22")))
    return spark.sql(sql, v=view(spark, d, "v_segments")).select("seg_id", *(F.round(v, 6 if k in ("sx", "sy") else 4).alias(k) for k, v in found.items()))


@query("""
SELECT b.tok_id AS block_label, f.tok_id AS fitted, CASE WHEN f.tok_id IS NULL THEN 'nearby' WHEN f.tok_id % 4 = 0 THEN 'nearby' ELSE 'street' END AS kind
FROM (SELECT * FROM v_tokens WHERE tok_id % 3 = 0) b LEFT JOIN (SELECT * FROM v_tokens WHERE tok_id % 2 = 0) f ON b.sheet = f.sheet AND b.x1 = f.x1 AND b.y1 = f.y1 AND b.x2 = f.x2 AND b.y2 = f.y2
""")
def label_constraints(spark, d):
    """A block's labels that are fitted labels, by their exact boxes; fitted outliers and others are only nearby text."""
    reads = view(spark, d, "v_tokens")
    fitted = reads.where("tok_id % 2 = 0").select("sheet", "x1", "y1", "x2", "y2", F.col("tok_id").alias("fitted"))
    kind = F.when(F.col("fitted").isNull() | (F.col("fitted") % 4 == 0), "nearby").otherwise("street")
    joined = reads.where("tok_id % 3 = 0").join(fitted, ["sheet", "x1", "y1", "x2", "y2"], "left")
    return joined.select(F.col("tok_id").alias("block_label"), "fitted", kind.alias("kind"))


@query("SELECT sheet, string_agg(concat(k, '=', n), ',' ORDER BY k) AS kinds FROM (SELECT s_nationkey % 4 AS sheet, s_suppkey % 3 AS k, count(*) AS n FROM supplier GROUP BY 1, 2) GROUP BY sheet")
def kinds_histogram(spark, d):
    counts = table(spark, d, "supplier").groupBy((F.col("s_nationkey") % 4).alias("sheet"), (F.col("s_suppkey") % 3).alias("k")).count()
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "count"))), lambda x: F.concat_ws("=", x["k"].cast("string"), x["count"].cast("string")))
    return counts.groupBy("sheet").agg(F.array_join(listed, ",").alias("kinds"))


@query("SELECT count(DISTINCT upper(street)) AS names, count(*) AS segments, min(ax) AS x1, min(ay) AS y1, max(bx) AS x2, max(by_) AS y2 FROM v_segments")
def layer_provenance(spark, d):
    return view(spark, d, "v_segments").agg(F.count_distinct(F.upper("street")).alias("names"), F.count("*").alias("segments"), F.min("ax").alias("x1"), F.min("ay").alias("y1"), F.max("bx").alias("x2"), F.max("by_").alias("y2"))


@query("""
WITH i AS (SELECT n_name, regexp_extract(lower(n_name), '^([a-z]+?)([a-z]{3})$', 1) AS stem, regexp_extract(lower(n_name), '^([a-z]+?)([a-z]{3})$', 2) AS tail FROM nation)
SELECT n_name, concat('loc/', substring(tail, 1, 2), '/', stem, '/', lower(n_name)) AS path, lower(regexp_replace(n_name, '[^A-Za-z0-9]+', '_', 'g')) AS slug FROM i
""")
def catalogue_paths(spark, d):
    stem, tail = (F.regexp_extract(F.lower("n_name"), "^([a-z]+?)([a-z]{3})$", i) for i in (1, 2))
    path = F.concat(F.lit("loc/"), F.substring(tail, 1, 2), F.lit("/"), stem, F.lit("/"), F.lower("n_name"))
    return table(spark, d, "nation").select("n_name", path.alias("path"), X.slug(F.col("n_name")).alias("slug"))


@query(f"SELECT DISTINCT text FROM ({_LABELS}) WHERE text NOT IN (SELECT text FROM ({_LABELS}) WHERE text NOT LIKE '% ST' AND text NOT LIKE '% Avenue')")
def unmatched_sorted(spark, d):
    """Distinct texts without a plain spelling, the set difference of two token lists."""
    texts = labels(spark, d).select("text")
    plain = texts.where("text NOT LIKE '% ST' AND text NOT LIKE '% Avenue'")
    return texts.exceptAll(plain).distinct().join(plain, "text", "left_anti")


@query("""
WITH g AS (SELECT sheet, count(*) AS n FROM v_labels WHERE label_id % 30 = sheet % 3 GROUP BY sheet)
SELECT s.sheet, coalesce(n, 0) AS labels, CASE WHEN coalesce(n, 0) < 2 THEN 'refused_min_labels' ELSE 'ok' END AS status FROM (SELECT DISTINCT sheet FROM v_labels) s LEFT JOIN g USING (sheet)
""")
def refusals(spark, d):
    """A sheet with too few labels gets a status, not an error."""
    rows = view(spark, d, "v_labels")
    some = rows.where("label_id % 30 = sheet % 3").groupBy("sheet").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return rows.select("sheet").distinct().join(some, "sheet", "left").select("sheet", n.alias("labels"), F.when(n < 2, "refused_min_labels").otherwise("ok").alias("status"))


@query("SELECT text, count(*) AS n, min(px) AS nearest FROM v_labels WHERE regexp_matches(text, '^[A-Z][A-Z .''&-]*$') AND len(text) >= 4 AND px <= 500 GROUP BY text ORDER BY nearest, text LIMIT 12")
def alias_candidates(spark, d):
    """The twelve nearest unmatched names that could be aliases."""
    good = F.col("text").rlike("^[A-Z][A-Z .'&-]*$") & (F.length("text") >= 4) & (F.col("px") <= 500)
    return view(spark, d, "v_labels").where(good).groupBy("text").agg(F.count("*").alias("n"), F.min("px").alias("nearest")).orderBy("nearest", "text").limit(12)
