"""Queries of verdicts, roll-ups and spatial attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.operators import judgements as J
from seamline.plans import query
from seamline.plans.names import _T, norm_sql, tokens
from seamline.plans.streets import _RINGS, _rings
from seamline.sources.views import table, view

_BLOCK = "SELECT p_partkey AS block, p_size % 10 / 16.0e0 AS compactness, p_partkey % 9 = 0 AS o, p_partkey % 3 AS through, p_size % 2 = 0 AS numbered, p_partkey % 4 AS lots, p_partkey % 5 = 0 AS has FROM part"


@query(f"""
WITH b AS ({_BLOCK}) SELECT coalesce(CASE WHEN compactness < 0.15 THEN 'thin' WHEN o THEN 'outlier_labels' WHEN through >= 2 THEN 'streets_through' WHEN numbered AND lots < 2 AND NOT has THEN 'no_numerals' END, 'kept') AS reason,
  count(*) AS n FROM b GROUP BY 1
""")
def block_verdicts(spark, d):
    b = spark.sql(_BLOCK.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    reason = J.block_verdict(F.col("compactness"), F.col("o").cast("int"), F.col("through"), F.col("numbered"), F.col("lots"), F.col("has"))
    return b.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("""
SELECT coalesce(CASE WHEN p_size < 5 THEN 'small' WHEN p_partkey % 3 = 0 AND p_partkey % 4 = 0 THEN 'border_no_numerals' WHEN p_size % 8 / 16.0e0 < 0.25 AND p_partkey % 4 = 0 THEN 'thin_no_numerals' END, 'kept') AS reason, count(*) AS n FROM part GROUP BY 1
""")
def area_drops(spark, d):
    reason = J.area_drop(F.col("p_size"), F.lit(5), F.col("p_partkey") % 3 == 0, F.col("p_partkey") % 4, F.col("p_size") % 8 / 16.0)
    return table(spark, d, "part").groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey AS id, p_size / 200.0e0 BETWEEN 0.0015 AND 0.2 AND p_partkey % 7 >= 3 AND NOT (p_partkey % 2 = 0 AND (p_size % 6 > 4 OR p_partkey % 10 / 10.0e0 < 0.35)) AS component,
  p_size / 100000.0e0 >= 0.00008 AND p_partkey % 10 / 10.0e0 <= 0.6 AND p_size % 4 / 4.0e0 <= 0.5 AS outline,
  CASE WHEN abs((1 + p_size / 1000.0e0) - 1) <= 0.04 AND abs(p_partkey % 5 - 1.0e0) <= 2 THEN 'affine' ELSE 'similarity' END AS model FROM part
""")
def shape_filters(spark, d):
    p, s = F.col("p_partkey"), F.col("p_size")
    component = J.component_keep(s / 200.0, p % 7, s % 6, p % 10 / 10.0, p % 2 == 0)
    return table(spark, d, "part").select(
        p.alias("id"), component.alias("component"), J.outline_keep(s / 100000.0, p % 10 / 10.0, s % 4 / 4.0).alias("outline"), J.affine_plausible(1 + s / 1000.0, F.lit(1.0), p % 5 - 1.0).alias("model")
    )


@query("""
SELECT page_id, CASE WHEN len(html) / 1000000.0e0 < 0.004 THEN 'skipped_blank' WHEN page_id % 3 = 0 THEN 'not_selected' ELSE 'pending' END AS status,
  CASE WHEN len(html) < 3000 THEN 'collapsed' WHEN len(html) >= 8000 THEN 'runaway' ELSE 'ok' END AS verdict FROM pages
""")
def page_verdicts(spark, d):
    size = F.length("html")
    return table(spark, d, "pages").select("page_id", J.tile_status(size / 1000000.0, F.col("page_id") % 3 != 0).alias("status"), J.text_verdict(size, F.lit(8000)).alias("verdict"))


@query("""
WITH t AS (SELECT o_custkey AS sheet, max(o_orderdate) AS "at" FROM orders GROUP BY 1), p AS (SELECT o_custkey AS sheet, max(o_orderdate) AS page_at FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT sheet, coalesce(page_at >= t."at" - INTERVAL 1 SECOND, false) AS placed FROM t LEFT JOIN p USING (sheet)
""")
def placed_sheets(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("sheet"), F.col("o_orderdate").alias("at"), "o_orderstatus")
    latest = lambda df: df.groupBy("sheet").agg(F.max("at").alias("at"))
    return J.placed(latest(orders), latest(orders.where("o_orderstatus = 'F'")))


@query("""
SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.event_id % 4 = 0 AND f.event_id % 8 <> 0 AND f.user_id = e.user_id AND f.event_type = e.event_type AND f.event_id % 2 = e.event_id % 2)
""")
def resume_work(spark, d):
    work = table(spark, d, "events").select("event_id", F.col("user_id").alias("tile"), F.col("event_type").alias("angle"), (F.col("event_id") % 2).alias("geometry"))
    done = work.where("event_id % 4 = 0").withColumn("hit_cap", F.col("event_id") % 8 == 0)
    return J.resume(work, done, redo_capped=True).select("event_id")


_LONG = {"ST": "Street", "AVE": "Avenue", "RD": "Road", "STRASSE": "strasse", "PLATZ": "Platz"}


@query(f"""
WITH {_T}, {norm_sql('t')},
q AS (SELECT tok_id, typ, list_transform(string_split(name, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))) AS ws FROM n WHERE regexp_matches(name, '^[A-Z]+( [A-Z]+)*$'))
SELECT tok_id, CASE WHEN typ IS NULL THEN array_to_string(ws, ' ') WHEN typ IN ('STRASSE', 'PLATZ') AND len(ws) = 1 THEN concat(ws[1], lower(typ))
  WHEN typ IN ('STRASSE', 'PLATZ') THEN concat(array_to_string(ws, '-'), '-', upper(typ[1]), lower(typ[2:]))
  ELSE concat(array_to_string(ws, ' '), ' ', CASE typ WHEN 'ST' THEN 'Street' WHEN 'AVE' THEN 'Avenue' WHEN 'RD' THEN 'Road' END) END AS query FROM q
""")
def place_queries(spark, d):
    from seamline.functions import text as X

    label = tokens(spark, d).select("tok_id", X.norm_label(F.col("text")).alias("l")).where(F.col("l.name").rlike("^[A-Z]+( [A-Z]+)*$"))
    return label.select("tok_id", J.place_query(F.col("l.name"), F.col("l.typ")).alias("query"))


_NUMERALS = "SELECT l_orderkey AS block, CAST(l_linenumber AS STRING) AS number, l_quantity * 1.0e0 AS height, (l_partkey % 200 - 100) * 1.0e0 AS dist, l_suppkey % 3 = 0 AS bold FROM {lineitem}"


@query(f"""
WITH t AS ({_NUMERALS.replace('{lineitem}', 'lineitem')}),
o AS (SELECT block, arg_max(number, (height, number)) AS tallest, max(height) AS top, median(height) AS middle, count(*) AS n FROM t WHERE dist >= 0 GROUP BY block),
c AS (SELECT *, CASE WHEN n >= 3 AND top >= 1.6 * middle THEN tallest END AS own FROM o),
k AS (SELECT block, arg_min(number, (-dist, number)) AS near FROM t WHERE bold AND dist < 0 AND dist >= -80 GROUP BY block)
SELECT block, coalesce(own, near) AS number, own IS NULL AND near IS NOT NULL AS inferred, coalesce(n - CASE WHEN own IS NULL THEN 0 ELSE 1 END, 0) AS lots
FROM (SELECT DISTINCT block FROM t) LEFT JOIN c USING (block) LEFT JOIN k USING (block)
""")
def block_numbers(spark, d):
    return J.block_number(spark.sql(_NUMERALS, lineitem=table(spark, d, "lineitem")))


@query("""
WITH t AS (SELECT sheet AS block, lower(text) AS name, min(px) AS dist FROM v_labels WHERE px BETWEEN 0 AND 170 GROUP BY 1, 2)
SELECT block, name, dist, CAST(row_number() OVER (PARTITION BY block ORDER BY dist, name) AS INTEGER) AS place FROM t
""")
def block_names(spark, d):
    return J.block_names(view(spark, d, "v_labels").select(F.col("sheet").alias("block"), F.col("text").alias("name"), F.col("px").alias("dist")))


@query(f"""
WITH r AS ({_RINGS}), s AS (SELECT street, ax + (i + 0.5e0) / 8 * (bx - ax) AS px, ay + (i + 0.5e0) / 8 * (by_ - ay) AS py FROM v_segments, range(8) g(i)),
b AS (SELECT ring_id, street, px, py, px - x0 AS l, x0 + w - px AS rr, py - y0 AS b, w, h, x0, y0 FROM r JOIN s ON px > x0 AND px < x0 + w AND py > y0 AND py < y0 + h + 16),
q AS (SELECT *, CASE WHEN px < x0 + w / 2 THEN (y0 + h + (px - x0) / (w / 2) * 16.0e0 - py) ELSE (y0 + h + rr / (w / 2) * 16.0e0 - py) END AS drop FROM b),
e AS (SELECT *, least(l, rr, b, drop * (w / 2) / sqrt(pow(w / 2, 2) + 256.0e0)) AS depth FROM q)
SELECT ring_id, street, round(sum(5.0e0), 6) AS inside_m FROM e WHERE drop > 0 AND depth >= 8 GROUP BY ring_id, street HAVING sum(5.0e0) >= 10
""")
def streets_through(spark, d):
    return J.streets_through(_rings(spark, d), view(spark, d, "v_segments"), 5.0, 8.0, 10.0).withColumn("inside_m", F.round("inside_m", 6))


@query("""
SELECT sheet AS book, min(px) - max(label_id % 50) AS x1, min(py) - max(label_id % 70) AS y1, max(px) + max(label_id % 50) AS x2, max(py) + max(label_id % 70) AS y2, median(label_id % 9 * 0.125e0) AS scale FROM v_labels GROUP BY sheet
""")
def neighbour_window(spark, d):
    rows = view(spark, d, "v_labels").select(F.col("sheet").alias("book"), F.col("px").alias("x"), F.col("py").alias("y"), (F.col("label_id") % 9 * 0.125).alias("scale"), (F.col("label_id") % 50).alias("w"), (F.col("label_id") % 70).alias("h"))
    return J.neighbour_window(rows, F.col("w"), F.col("h"))


_FIT = "SELECT sheet, label_id % 11 * 0.125e0 AS residual, label_id % 6 = 0 AS outlier, CASE WHEN sheet % 5 = 0 AND label_id % 4 = 0 THEN NULL ELSE label_id % 7 = 0 END AS alias, label_id % 5 = 0 AS fuzzy FROM v_labels"


@query(f"""
WITH l AS ({_FIT})
SELECT sheet, count(*) AS labels, count(*) FILTER (NOT outlier) AS inliers, round(sqrt(avg(residual * residual) FILTER (NOT outlier)), 4) AS rms, median(residual) FILTER (NOT outlier) AS median, max(residual) FILTER (NOT outlier) AS worst,
  CASE WHEN bool_and(alias IS NOT NULL) THEN count(*) FILTER (NOT alias AND NOT fuzzy) END AS plain, CASE WHEN bool_and(alias IS NOT NULL) THEN count(*) FILTER (alias) END AS aliased FROM l GROUP BY sheet
""")
def fit_rollup(spark, d):
    return J.fit_rollup(spark.sql(_FIT.replace("v_labels", "{v}"), v=view(spark, d, "v_labels")))


@query("""
WITH t AS (SELECT vec_id // 6 AS sheet, vec_id AS tint, vec_id * 29 % 360 AS angle FROM embeddings),
b AS (SELECT *, CASE WHEN angle <= 35 OR angle >= 325 THEN 'pink' WHEN angle <= 130 THEN 'yellow' WHEN angle <= 200 THEN 'green' WHEN angle <= 300 THEN 'blue' ELSE 'purple' END AS base FROM t)
SELECT sheet, tint, angle, CASE WHEN count(*) OVER (PARTITION BY sheet, base) > 1 THEN concat(base, row_number() OVER (PARTITION BY sheet, base ORDER BY tint)) ELSE base END AS name FROM b
""")
def tint_names(spark, d):
    rows = table(spark, d, "embeddings").select(F.expr("vec_id div 6").alias("sheet"), F.col("vec_id").alias("tint"), (F.col("vec_id") * 29 % 360).alias("angle"))
    return J.tint_names(rows)


@query("""
SELECT conv_id, turn, coalesce(CASE trim(text) WHEN 'list the words' THEN 'words' END, 'custom') AS preset FROM conversations
""")
def prompt_presets(spark, d):
    presets = spark.createDataFrame([("words", "list the words ")], "name string, body string")
    said = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("prompt"))
    return J.preset_of(said, presets).select("conv_id", "turn", "preset")


@query("SELECT url, regexp_extract(url, '/([^/]*)$', 1) AS leaf, nullif(regexp_extract(url, '(1[5-9][0-9]{2}|20[0-9]{2})', 1), '')::INTEGER AS year FROM pages")
def plan_years(spark, d):
    from seamline.functions import text as X

    return table(spark, d, "pages").select("url", F.regexp_extract("url", "/([^/]*)$", 1).alias("leaf"), X.plan_year(F.col("url")).alias("year"))
