"""Queries from names to places, of placed sheets, run folders and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.operators import locate, sheets, summaries, tokens
from seamline.plans import query
from seamline.plans import names as P
from seamline.sources import runs
from seamline.sources.views import table, view


# ------------------------------------------------------------------------------------------------- names and answers
_MAIN = f"k AS (SELECT sheet, typ AS main FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY n DESC, first) AS rn FROM (SELECT sheet, coalesce(typ, {P._TYPES}[name]) AS typ, count(*) AS n, min(tok_id) AS first FROM n WHERE coalesce(typ, {P._TYPES}[name]) IS NOT NULL GROUP BY ALL)) WHERE rn = 1)"


@query(f"""
WITH {P._T}, {P.norm_sql('t')}, {_MAIN},
u AS (SELECT *, regexp_replace({P.fold_sql('text')}, '[^A-Za-z]', '', 'g') AS letters FROM n WHERE {P._SKIP} IS NULL),
g0 AS (SELECT sheet, name, count(*) AS occurrences, count(*) FILTER (letters <> '' AND letters = upper(letters)) AS uppers, arg_min(typ, tok_id) FILTER (typ IS NOT NULL) AS typ, false AS forced FROM u GROUP BY sheet, name),
g AS (SELECT * REPLACE (name = 'OMEGA' AS forced) FROM g0 UNION ALL SELECT DISTINCT sheet, 'OMEGA', 1, 0, 'RD', true FROM t WHERE sheet NOT IN (SELECT sheet FROM g0 WHERE name = 'OMEGA')),
r AS (SELECT *, uppers / occurrences AS share, CASE WHEN forced OR typ IS NOT NULL THEN 'A' WHEN occurrences >= 2 OR (uppers = occurrences AND len(name) >= 6) THEN 'B' ELSE 'C' END AS tier FROM g),
q AS (SELECT *, round((CASE WHEN typ IS NOT NULL THEN 3 ELSE 0 END) + 2 * share + least(occurrences - 1, 3) + len(name) / 4.0e0, 2) AS rank,
  CASE WHEN name = (SELECT min(name) FROM g0) THEN 'dropped' WHEN tier = 'C' THEN 'bare_tier_C' END AS out FROM r)
SELECT sheet, name, typ, CASE WHEN typ IS NULL THEN main END AS type_assumed, tier, occurrences, round(share, 2) AS upper_frac, rank,
  coalesce(out, CASE WHEN row_number() OVER (PARTITION BY sheet, out IS NULL ORDER BY rank DESC, name) > 10 THEN 'over_max' END) AS reason FROM q LEFT JOIN k USING (sheet)
""")
def name_selection(spark, d):
    reads = P.tokens(spark, d)
    drop = locate.selection(reads, "all").agg(F.min("name")).first()[0]
    return locate.selection(reads, force=("Omega Road",), drop=(drop,), most=10).drop("query")


_ANSWERS = "SELECT concat('Q', o_custkey % 40) AS query, CASE o_orderkey % 3 WHEN 0 THEN 'highway' WHEN 1 THEN 'place' END AS category, CASE o_orderkey % 5 WHEN 0 THEN 'highway' ELSE 'building' END AS class FROM {orders} WHERE o_custkey % 40 < 30"


@query(f"""
WITH a AS (SELECT query, coalesce(category, class) AS category FROM ({_ANSWERS.replace('{orders}', 'orders')})),
c AS (SELECT query, count(*) AS raw, count(*) FILTER (category = 'highway') AS kept FROM a GROUP BY query),
n AS (SELECT i % 5 AS sheet, concat('q', i) AS name, concat('Q', i + 20) AS query FROM range(25) r(i))
SELECT sheet, name, CASE WHEN f THEN bare ELSE query END AS query_used, CASE WHEN f THEN b_raw ELSE t_raw END AS n_raw, CASE WHEN f THEN b_kept ELSE t_kept END AS n_kept, CASE WHEN f THEN b_raw ELSE t_raw END >= 500 AS saturated
FROM (SELECT n.*, upper(name[1]) || name[2:] AS bare, t.raw AS t_raw, t.kept AS t_kept, b.raw AS b_raw, b.kept AS b_kept, coalesce(t.kept = 0 AND coalesce(b.kept, 0) > 0 AND n.query <> upper(name[1]) || name[2:], false) AS f
  FROM n LEFT JOIN c t ON t.query = n.query LEFT JOIN c b ON b.query = upper(name[1]) || name[2:])
""")
def lookups(spark, d):
    """Typed queries, those without a hit of the class giving way to the bare name, and saturated ones."""
    found = spark.sql(_ANSWERS, orders=table(spark, d, "orders")).withColumn("category", F.coalesce("category", "class"))
    asked = spark.range(25).select((F.col("id") % 5).alias("sheet"), F.concat(F.lit("q"), "id").alias("name"), F.concat(F.lit("Q"), F.col("id") + 20).alias("query"))
    return locate.looked_up(asked, found, ["highway"], 500)


_RAW = "SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'highway' END AS category, 'place' AS class, CAST(c_acctbal AS STRING) AS lat, CASE WHEN c_custkey % 9 = 0 THEN 'east' ELSE CAST(c_custkey AS STRING) END AS lon, array('1.5', '2.5', '-3.25', 'x') AS boundingbox, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS display_name FROM {customer}"


@query("""
SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'place' ELSE 'highway' END AS category, round(c_acctbal, 2) AS lat, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey * 1.0e0 END AS lon,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS display_name, 1.5e0 AS s, -3.25e0 AS w, 2.5e0 AS n, CAST(NULL AS DOUBLE) AS e FROM customer WHERE c_custkey % 4 <> 0
""")
def hits_of_class(spark, d):
    raw = spark.sql(_RAW, customer=table(spark, d, "customer"))
    return locate.hits(raw).where(locate.of_class(["highway"])).withColumn("lat", F.round("lat", 2))


_LONG = "lat - (0.001e0 + hit_id % 9 * 0.00390625e0) AS s, lat + (0.001e0 + hit_id % 9 * 0.00390625e0) AS n, lon - 0.015625e0 AS w, lon + 0.015625e0 AS e"


@query(f"""
WITH h AS (SELECT hit_id // 8 AS candidate, lat, lon, {_LONG} FROM v_hits),
b AS (SELECT *, sqrt(pow((n - s) * 111.32e0, 2) + pow((e - w) * 111.32e0 * cos(radians((s + n) / 2)), 2)) < 5 AS whole FROM h),
u AS (SELECT candidate, min(CASE WHEN whole THEN s ELSE lat END) AS s, min(CASE WHEN whole THEN w ELSE lon END) AS w, max(CASE WHEN whole THEN n ELSE lat END) AS n, max(CASE WHEN whole THEN e ELSE lon END) AS e FROM b GROUP BY 1)
SELECT candidate, round(greatest(s - 2 / 111.32e0, -90), 6) AS s, round(w - 2 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS w, round(least(n + 2 / 111.32e0, 90), 6) AS n, round(e + 2 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS e,
  round(abs((n - s) * 111.32e0 * (e - w) * 111.32e0 * cos(radians((s + n) / 2))), 3) AS area_km2 FROM u
""")
def candidate_box(spark, d):
    members = view(spark, d, "v_hits").selectExpr("hit_id div 8 AS candidate", "lat", "lon", *_LONG.split(", "))
    found = locate.candidate_boxes(members, 2.0)
    return found.select("candidate", *(F.round(c, 6).alias(c) for c in "swne"), F.round("area_km2", 3).alias("area_km2"))


_CANDIDATES = "SELECT c_nationkey AS sheet, c_custkey AS candidate, c_custkey % 7 * 0.5e0 AS score, c_custkey % 3 AS n_names, c_custkey % 5 AS n_hits, c_custkey % 11 * 1.0e0 AS area_km2 FROM {customer}"


@query(f"""
WITH c AS ({_CANDIDATES.replace('{customer}', 'customer')})
SELECT sheet, candidate, CAST(row_number() OVER (PARTITION BY sheet ORDER BY score DESC, n_names DESC, n_hits, area_km2, candidate) AS INTEGER) AS rank FROM c
""")
def candidate_order(spark, d):
    return locate.ranked(spark.sql(_CANDIDATES, customer=table(spark, d, "customer"))).select("sheet", "candidate", "rank")


@query(f"""
WITH c AS ({_CANDIDATES.replace('{customer}', 'customer')}),
r AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY score DESC, n_names DESC, n_hits, area_km2, candidate) AS rank FROM c)
SELECT s.sheet, candidate, candidate IS NOT NULL AS found FROM (SELECT DISTINCT sheet FROM c) s LEFT JOIN (SELECT * FROM r WHERE rank = 3) USING (sheet)
""")
def candidate_picker(spark, d):
    return locate.picked(locate.ranked(spark.sql(_CANDIDATES, customer=table(spark, d, "customer"))), 3).select("sheet", "candidate", "found")


@query("""
WITH p AS (SELECT hit_id % 30 AS "into", hit_id AS part, concat('N', hit_id % 4) AS a, name AS b FROM v_hits),
x AS (SELECT "into", part * 2 AS o, a AS name FROM p UNION ALL SELECT "into", part * 2 + 1, b FROM p)
SELECT "into", string_agg(name, '|' ORDER BY o) AS names FROM (SELECT "into", name, min(o) AS o FROM x GROUP BY ALL) GROUP BY 1
""")
def names_merged(spark, d):
    """Names of merged candidates once, in the order of the parts."""
    parts = view(spark, d, "v_hits").select((F.col("hit_id") % 30).alias("into"), F.col("hit_id").alias("part"), F.array(F.concat(F.lit("N"), F.col("hit_id") % 4), "name").alias("names"))
    return locate.merged_names(parts).select("into", F.array_join("names", "|").alias("names"))


_REQUESTS = "SELECT c_custkey AS request, CASE c_custkey % 3 WHEN 0 THEN CASE WHEN c_custkey % 2 = 0 THEN '1, 2, 3, 4' ELSE '3,2,1,4' END END AS bbox, c_nationkey AS sheet, c_custkey % 2 + 1 AS candidate FROM {customer}"


@query(f"""
WITH r AS ({_REQUESTS.replace('{customer}', 'customer')}),
p AS (SELECT request, min(10.0e0 + i) AS s, min(20.0e0 - i) AS w, max(11.0e0 + i) AS n, max(21.0e0) AS e FROM r, range(2) g(i) WHERE request % 3 = 1 GROUP BY request),
b AS (SELECT request, 1.0e0 AS s, 2.0e0 AS w, 3.0e0 AS n, 4.0e0 AS e, 'bbox' AS origin FROM r WHERE bbox = '1, 2, 3, 4' UNION ALL SELECT *, 'place' FROM p
  UNION ALL SELECT request, 5.0e0, 6.0e0 + sheet, 7.0e0, 8.0e0 + sheet, 'locate' FROM r WHERE request % 3 = 2 AND candidate = 1)
SELECT request, origin, round(s - 1 / 111.32e0, 6) AS s, round(w - 1 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS w, round(n + 1 / 111.32e0, 6) AS n, round(e + 1 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS e FROM b
""")
def resolved_boxes(spark, d):
    asked = spark.sql(_REQUESTS, customer=table(spark, d, "customer"))
    named = asked.where("request % 3 = 1").select("request", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("i")).selectExpr("request", "10.0e0 + i AS s", "20.0e0 - i AS w", "11.0e0 + i AS n", "21.0e0 AS e")
    chosen = asked.select("sheet").distinct().selectExpr("sheet", "1 AS rank", "5.0e0 AS s", "6.0e0 + sheet AS w", "7.0e0 AS n", "8.0e0 + sheet AS e")
    return locate.resolved_boxes(asked, named, chosen, 1.0).select("request", "origin", *(F.round(c, 6).alias(c) for c in "swne"))


_IDS = "SELECT p_partkey AS id, concat('see ', CASE p_partkey % 4 WHEN 0 THEN 'g3934tm.g3934tm_g0' WHEN 1 THEN 'g4120.g4120_g0' WHEN 2 THEN 'g3934tm.g4120_g0' ELSE 'loc.gov/' END, lpad(CAST(p_partkey AS STRING), 4, '0'), CASE WHEN p_partkey % 8 = 0 THEN '1884' ELSE '' END, ' ok') AS text FROM {part}"


@query(f"""
WITH t AS ({_IDS.replace('{part}', 'part')}),
m AS (SELECT id, regexp_extract(text, '(g[0-9]{{4}}[a-z]*)\\.(g[0-9]{{4}}[a-z]*)_g[0-9]+[a-z]*', 1) AS cls, regexp_extract(text, '(g[0-9]{{4}}[a-z]*)\\.(g[0-9]{{4}}[a-z]*)_g[0-9]+[a-z]*', 2) AS again,
  regexp_extract(text, '\\.(g[0-9]{{4}}[a-z]*_g[0-9]+[a-z]*)', 1) AS item FROM t)
SELECT id, cls, item, concat('gmd/gmd', cls[2:4], 'm/g', cls[2:5], 'm/', cls, '/', item) AS path, concat('service:gmd:gmd', cls[2:4], 'm:g', cls[2:5], 'm:', cls, ':', item, ':s1') AS image,
  CASE WHEN regexp_matches(item, '_g[0-9]{{9}}$') THEN concat(regexp_extract(item, '_g([0-9]{{5}})', 1), '_', regexp_extract(item, '([0-9]{{4}})$', 1)) END AS stem FROM m WHERE cls <> '' AND cls = again
""")
def catalogue_ids(spark, d):
    found = spark.sql(_IDS, part=table(spark, d, "part")).select("id", locate.catalogue_id(F.col("text")).alias("c")).where("c IS NOT NULL").select("id", "c.*")
    cls, item = F.col("cls"), F.col("item")
    return found.select("id", "cls", "item", locate.storage_path(cls, item).alias("path"), locate.image_id(cls, item, F.lit("s1")).alias("image"), locate.plan_stem(item).alias("stem"))


@query("""
SELECT hit_id, concat('fetch-streets --bbox=', printf('%.4f', lat + 3e-5), ',', printf('%.4f', lon + 3e-5), ',', printf('%.4f', lat + 0.5 + 3e-5), ',', printf('%.4f', lon + 0.25 + 3e-5), ' --out n', lower(name[2:]), '_streets.geojson') AS command, CAST(hit_id % 900 AS VARCHAR) AS sheet FROM v_hits WHERE hit_id % 900 > 0
""")
def fetch_commands(spark, d):
    hits = view(spark, d, "v_hits").where("hit_id % 900 > 0").selectExpr("hit_id", "name", "lat + 3e-5 AS s", "lon + 3e-5 AS w", "lat + 0.5 + 3e-5 AS n", "lon + 0.25 + 3e-5 AS e")
    stem = F.concat(F.lit("01352_1889-p"), F.lpad((F.col("hit_id") % 900).cast("string"), 4, "0"))
    return hits.select("hit_id", locate.fetch_command(F.lower("name")).alias("command"), locate.sheet_number(stem).alias("sheet"))


# ------------------------------------------------------------------------------------------------- placed sheets
_POSES = """SELECT s_suppkey AS sheet, 1000 + s_suppkey % 70 AS w, 800 + s_suppkey % 90 AS h, CASE WHEN s_suppkey % 3 = 0 THEN '10,20,510,620' END AS crop, CASE s_suppkey % 4 WHEN 0 THEN 32610 WHEN 1 THEN 26917 WHEN 2 THEN 25832 ELSE 4326 END AS epsg,
  0.5e0 + s_suppkey % 8 * 0.0625e0 AS a11, 0.125e0 AS a12, 500000.0e0 AS tx, 0.0625e0 AS a21, -0.5e0 - s_suppkey % 4 * 0.125e0 AS a22, 5450000.0e0 AS ty, CASE WHEN s_suppkey % 2 = 0 THEN 50.0e0 END AS stated_ft FROM {supplier}"""
_P = f"p AS ({_POSES.replace('{supplier}', 'supplier')})"


def _poses(spark, d):
    return spark.sql(_POSES, supplier=table(spark, d, "supplier"))


@query(f"""
WITH {_P}, b AS (SELECT *, 0 AS x0, 0 AS y0, w AS x1, h AS y1, 'scan' AS what FROM p UNION ALL SELECT *, CASE WHEN crop IS NULL THEN 0 ELSE 10 END, CASE WHEN crop IS NULL THEN 0 ELSE 20 END, CASE WHEN crop IS NULL THEN w ELSE 510 END, CASE WHEN crop IS NULL THEN h ELSE 620 END, 'content' FROM p)
SELECT sheet, what, 5 AS corners, round(a11 * x1 + a12 * y1 + tx, 6) AS far_x, round(a21 * x1 + a22 * y1 + ty, 6) AS far_y, round(a11 * x0 + a12 * y0 + tx, 6) AS last_x FROM b
""")
def page_footprints(spark, d):
    found = sheets.footprints(_poses(spark, d))
    far, last = F.get("map", F.lit(2)), F.element_at("map", -1)
    return found.select("sheet", "what", F.size("map").alias("corners"), F.round(far["x"], 6).alias("far_x"), F.round(far["y"], 6).alias("far_y"), F.round(last["x"], 6).alias("last_x"))


@query(f"""
WITH {_P}, i AS (SELECT *, a11 * a22 - a12 * a21 AS det, sqrt(a11 * a11 + a21 * a21) AS sx FROM p)
SELECT sheet, round(a22 / det, 6) AS b11, round(-a12 / det, 6) AS b12, round(50 * 0.3048e0 / sx, 6) AS dpi50, round(stated_ft * 0.3048e0 / sx, 6) AS dpi_stated,
  CASE epsg WHEN 32610 THEN 'EPSG:32610 (WGS 84 / UTM zone 10N)' WHEN 26917 THEN 'EPSG:26917 (NAD83 / UTM zone 17N)' WHEN 25832 THEN 'EPSG:25832 (ETRS89 / UTM zone 32N)' ELSE 'EPSG:4326 (EPSG:4326)' END AS crs FROM i
""")
def georeferences(spark, d):
    """The document's numbers, read back from its JSON."""
    at = lambda p: F.get_json_object("document", p)
    number = lambda p, n: F.round(at(p).cast("double"), 6).alias(n)
    return sheets.georeferences(_poses(spark, d)).select(
        "sheet", number("$.affine_map_to_source_px.a11", "b11"), number("$.affine_map_to_source_px.a12", "b12"), number("$.implied_dpi_if_50ft_per_inch", "dpi50"), number("$.implied_dpi_from_stated_scale", "dpi_stated"), at("$.crs").alias("crs")
    )


@query("""
WITH e AS (SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 32610 WHEN 1 THEN 26917 WHEN 2 THEN 4326 WHEN 3 THEN 2193 ELSE 32733 END AS epsg FROM supplier)
SELECT id, epsg, CASE WHEN epsg = 2193 THEN 'refused_crs' ELSE 'ok' END AS status, CASE epsg WHEN 32610 THEN -123.0e0 WHEN 26917 THEN -81.0e0 WHEN 32733 THEN 15.0e0 END AS meridian,
  CASE WHEN epsg = 2193 THEN NULL ELSE 3.0e0 + id % 3 END AS lon, CASE WHEN epsg = 2193 THEN NULL ELSE 4.0e0 + id % 7 END AS lat, epsg AS parsed FROM e
""")
def crs_round_trip(spark, d):
    """Into any system and back gives the degrees that went in; systems that are not handled are refused by status."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.expr("CASE s_suppkey % 5 WHEN 0 THEN 32610 WHEN 1 THEN 26917 WHEN 2 THEN 4326 WHEN 3 THEN 2193 ELSE 32733 END").alias("epsg"))
    epsg = F.col("epsg")
    lon, lat = 3.0 + F.col("id") % 3, 4.0 + F.col("id") % 7
    shift = F.coalesce(sheets.central_meridian(epsg), F.lit(0.0))
    x, y = sheets.from_degrees(lon + shift, lat, epsg)
    back = sheets.to_degrees(F.col("x"), F.col("y"), epsg)
    name = F.concat(F.lit("urn:ogc:def:crs:EPSG::"), epsg.cast("string"))
    fine = sheets.crs_status(epsg) == "ok"
    return rows.withColumns({"x": x, "y": y}).select(
        "id", "epsg", sheets.crs_status(epsg).alias("status"), sheets.central_meridian(epsg).alias("meridian"), F.when(fine, F.round(back[0] - shift, 6)).alias("lon"), F.when(fine, F.round(back[1], 6)).alias("lat"), sheets.parsed_epsg(name).alias("parsed")
    )


@query(f"""
WITH {_P} SELECT sheet, CASE WHEN crop IS NULL THEN w * h ELSE 300000 END AS source_px, CAST(round_even(CASE WHEN crop IS NULL THEN w * h ELSE 300000 END * 0.25e0, 0) AS BIGINT) AS work_px FROM p
""")
def content_pixels(spark, d):
    source, work = sheets.content_px(F.col("crop"), F.lit(0.5))
    return _poses(spark, d).select("sheet", source.alias("source_px"), work.alias("work_px"))


@query(f"""
WITH {_P}, f AS (SELECT sheet, epsg, i % 3 <> 0 AS accepted, i FROM p, range(4) r(i) WHERE epsg <> 4326 AND NOT (sheet % 5 = 0 AND i % 3 = 0))
SELECT sheet, accepted, n.name, count(*) AS features, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS places,
  CASE WHEN n.name = 'wgs84' THEN NULL ELSE concat('urn:ogc:def:crs:EPSG::', epsg) END AS crs FROM (SELECT *, unnest([concat('epsg', epsg), 'wgs84']) AS name FROM f) n GROUP BY sheet, accepted, n.name, epsg
""")
def sheet_collections(spark, d):
    """Collections in two systems, read back from their JSON."""
    rows = _poses(spark, d).where("epsg <> 4326").select("sheet", "epsg", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ordinal")).where("NOT (sheet % 5 = 0 AND ordinal % 3 = 0)")
    ring = sheets.box_ring(F.lit(500000.0), F.lit(5000000.0), F.lit(500100.0), F.lit(5000200.0))
    made = sheets.collections(rows.select("sheet", "epsg", (F.col("ordinal") % 3 != 0).alias("accepted"), "ordinal", ring.alias("ring"), F.struct(F.col("ordinal").alias("n")).alias("properties")))
    read = F.from_json("document", "features array<struct<properties struct<n int>>>, crs struct<properties struct<name string>>")
    listed = made.select("sheet", "accepted", "name", read.alias("r"))
    return listed.select("sheet", "accepted", "name", F.size("r.features").cast("long").alias("features"), F.array_join(F.transform("r.features", lambda f: f["properties"]["n"].cast("string")), ",").alias("places"), F.col("r.crs.properties.name").alias("crs"))


# ------------------------------------------------------------------------------------------------- gates and views
@query("""
WITH l AS (SELECT sheet, label_id, concat(text, ' ST') AS street FROM v_labels), c AS (SELECT DISTINCT sheet, 400.0e0 + sheet % 5 * 200 AS cx, 700.0e0 AS cy FROM v_labels),
m AS (SELECT l.sheet, label_id, seg_id FROM l JOIN c USING (sheet) JOIN v_segments USING (street) WHERE pow((ax + bx) / 2 - cx, 2) + pow((ay + by_) / 2 - cy, 2) <= 250000)
SELECT l.sheet, l.label_id, count(seg_id) AS segments, count(seg_id) = 0 AS dropped FROM l LEFT JOIN m USING (sheet, label_id) GROUP BY ALL
""")
def candidate_radius(spark, d):
    labels = view(spark, d, "v_labels").select("sheet", "label_id", F.concat("text", F.lit(" ST")).alias("street"))
    centres = labels.select("sheet").distinct().select("sheet", (400.0 + F.col("sheet") % 5 * 200).alias("cx"), F.lit(700.0).alias("cy"))
    counts = sheets.reach_counts(labels, view(spark, d, "v_segments"), centres, 500.0)
    return counts.withColumn("dropped", F.col("segments") == 0)


@query("""
SELECT o_custkey AS block, o_orderkey AS part, round(area / total, 6) AS share, n > 1 AND area / total < 0.2 AS sliver
FROM (SELECT *, o_totalprice AS area, sum(o_totalprice) OVER (PARTITION BY o_custkey) AS total, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
""")
def block_slivers(spark, d):
    parts = table(spark, d, "orders").select(F.col("o_custkey").alias("block"), F.col("o_orderkey").alias("part"), F.col("o_totalprice").alias("area"))
    return sheets.split_parts(parts).select("block", "part", F.round("share", 6).alias("share"), "sliver")


@query("""
WITH t AS (SELECT l_orderkey AS part, CAST(l_partkey % 40 AS VARCHAR) AS text, l_quantity * 1.0e0 AS height FROM lineitem),
g AS (SELECT part, median(height) AS middle, arg_max(text, (height, text)) AS top, max(height) AS high, count(*) AS n FROM t GROUP BY part),
k AS (SELECT part, CASE WHEN high >= 1.6 * middle AND n >= 3 THEN top END AS number FROM g)
SELECT part, number, coalesce(string_agg(text, ',' ORDER BY len(text), text) FILTER (number IS NULL OR text <> number), '') AS lots FROM (SELECT DISTINCT part, text FROM t) JOIN k USING (part) GROUP BY part, number
""")
def numerals_inside(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("part"), (F.col("l_partkey") % 40).cast("string").alias("text"), (F.col("l_quantity") * 1.0).alias("height"))
    return sheets.numerals_inside(rows).select("part", "number", F.array_join("lots", ",").alias("lots"))


_TURNED = "SELECT tok_id, 100.0e0 + tok_id % 1400 AS x, 80.0e0 + tok_id % 900 AS y, 256.0e0 * (tok_id % 3) AS tx0, 128.0e0 * (tok_id % 4) AS ty0 FROM {v}"


@query(f"""
WITH v AS ({_TURNED.replace('{v}', 'v_tokens')}),
u AS (SELECT *, 500 + cos(radians(30.0e0)) * (x - 750) - sin(radians(30.0e0)) * (y - 750) AS ux, 400 + sin(radians(30.0e0)) * (x - 750) + cos(radians(30.0e0)) * (y - 750) AS uy FROM v)
SELECT tok_id, round(ux, 6) AS ux, round(uy, 6) AS uy, ux BETWEEN tx0 AND tx0 + 512 AND uy BETWEEN ty0 AND ty0 + 512 AS own FROM u
""")
def turned_views(spark, d):
    """Reads of a turned view in the upright image, and whether their own tile holds them."""
    rows = spark.sql(_TURNED, v=view(spark, d, "v_tokens")).withColumns({"tx1": F.col("tx0") + 512, "ty1": F.col("ty0") + 512})
    x, y = tokens.unrotated(F.col("x"), F.col("y"), 30.0, (F.lit(1500.0), F.lit(1500.0)), (F.lit(1000.0), F.lit(800.0)))
    moved = rows.withColumns({"ux": x, "uy": y})
    return moved.select("tok_id", F.round("ux", 6).alias("ux"), F.round("uy", 6).alias("uy"), tokens.own_tile(F.col("ux"), F.col("uy")).alias("own"))


_MID = "SELECT tok_id, sheet, text, rotation, (x1 + x2) / 2.0e0 AS cx, (y1 + y2) / 2.0e0 AS cy FROM {v}"


@query(f"""
WITH m AS ({_MID.replace('{v}', 'v_tokens')}), t AS (SELECT * FROM m WHERE rotation <> 0), u AS (SELECT * FROM m WHERE rotation = 0)
SELECT sheet, text, string_agg(DISTINCT CAST(rotation AS VARCHAR), ',') AS angles FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.sheet = t.sheet AND u.text = t.text AND abs(u.cx - t.cx) <= 30 AND abs(u.cy - t.cy) <= 30) GROUP BY sheet, text
""")
def view_extras(spark, d):
    reads = spark.sql(_MID, v=view(spark, d, "v_tokens"))
    return tokens.extras(reads.where("rotation <> 0"), reads.where("rotation = 0")).select("sheet", "text", F.array_join(F.transform("angles", lambda a: a.cast("string")), ",").alias("angles"))


# ------------------------------------------------------------------------------------------------- runs
@query("""
WITH t AS (SELECT o_custkey AS run, o_orderkey AS tile, CASE o_orderkey % 4 WHEN 0 THEN 'skipped_blank' WHEN 1 THEN 'not_selected' ELSE 'ok' END AS status, o_orderkey % 300 AS x1, o_orderkey % 200 AS y1 FROM orders),
v AS (SELECT l_orderkey AS tile, l_linenumber * 30 AS rotation, l_linenumber = 4 AS hit_cap, l_linenumber % 2 AS runaway, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity * 0.5e0 END AS generate_s, l_partkey AS tokens_in FROM lineitem),
j AS (SELECT run, v.*, x1 * y1 AS px FROM t JOIN v USING (tile) WHERE status = 'ok'),
a AS (SELECT run, count(*) AS tiles_planned, count(*) FILTER (status = 'ok') AS tiles_read, count(*) FILTER (status = 'skipped_blank') AS tiles_blank FROM t GROUP BY run),
b AS (SELECT run, count(*) AS views, count(generate_s) AS views_with_metadata, count(*) FILTER (hit_cap) AS views_hit_cap, CAST(sum(px) AS BIGINT) AS pixels_work, CAST(sum(runaway) AS BIGINT) AS runaway_dropped, round(sum(generate_s), 3) AS generate_s,
  CAST(sum(tokens_in) FILTER (generate_s IS NOT NULL) AS BIGINT) AS input_tokens, count(DISTINCT rotation) AS rotations FROM j GROUP BY run)
SELECT a.run, tiles_planned, tiles_read, tiles_blank, views, views_with_metadata, views_hit_cap, pixels_work, runaway_dropped, generate_s, input_tokens, rotations, CAST(pixels_work * 4 AS BIGINT) AS pixels_source,
  CASE WHEN views_with_metadata > 0 THEN round(generate_s / views_with_metadata, 3) END AS generate_s_per_view FROM a LEFT JOIN b USING (run)
""")
def reading_summary(spark, d):
    tiles = table(spark, d, "orders").selectExpr("o_custkey AS run", "o_orderkey AS tile", "CASE o_orderkey % 4 WHEN 0 THEN 'skipped_blank' WHEN 1 THEN 'not_selected' ELSE 'ok' END AS status", "0 AS x0", "0 AS y0", "o_orderkey % 300 AS x1", "o_orderkey % 200 AS y1")
    views = table(spark, d, "lineitem").join(tiles.select("run", "tile"), F.col("l_orderkey") == F.col("tile")).selectExpr(
        "run", "tile", "l_linenumber * 30 AS rotation", "l_linenumber = 4 AS hit_cap", "l_linenumber % 2 AS runaway", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity * 0.5e0 END AS generate_s", "0.0e0 AS prepare_s", "l_partkey AS input_tokens", "1 AS output_tokens", "'' AS utc"
    )
    reads = tiles.selectExpr("run", "tile % 5 = 0 AS duplicate", "false AS fragment", "false AS conflict")
    about = tiles.select("run").distinct().selectExpr("run", "1000 AS source_w", "900 AS source_h", "0.5e0 AS work_scale")
    names = ["run", "tiles_planned", "tiles_read", "tiles_blank", "views", "views_with_metadata", "views_hit_cap", "pixels_work", "runaway_dropped", "generate_s", "input_tokens", "rotations", "pixels_source", "generate_s_per_view"]
    return summaries.reading(tiles, views, reads, about).select(names)


@query("""
WITH f AS (SELECT o_custkey % 50 AS run, CASE WHEN o_orderkey % 2 = 0 THEN 'blocks' ELSE 'street_names' END AS product, coalesce(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END, '?') AS kind FROM orders),
c AS (SELECT run, product, kind, count(*) AS n FROM f GROUP BY ALL)
SELECT run, product, CAST(sum(n) AS BIGINT) AS features, string_agg(concat(kind, '=', n), ',' ORDER BY kind) AS kinds FROM c GROUP BY run, product
""")
def output_counts(spark, d):
    rows = table(spark, d, "orders").selectExpr("o_custkey % 50 AS run", "CASE WHEN o_orderkey % 2 = 0 THEN 'blocks' ELSE 'street_names' END AS product", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS kind")
    listed = F.transform(F.map_entries("kinds"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return summaries.outputs(rows).select("run", "product", "features", F.array_join(listed, ",").alias("kinds"))


@query("""
SELECT run, count(*) + 6 AS lines, count(DISTINCT stage) AS stages FROM v_runlog GROUP BY run
""")
def run_history(spark, d):
    """A report of each run; its lines and the stages its totals name."""
    log = view(spark, d, "v_runlog").selectExpr("run", "event_id", "stage", "'ok' AS status", "CAST(finished AS STRING) AS finished", "CAST(elapsed_s AS DOUBLE) AS elapsed_s")
    body = runs.history(log)
    return body.select("run", F.size(F.split("body", "\n")).cast("long").alias("lines"), F.regexp_extract("body", r"(\d+) stages", 1).cast("long").alias("stages"))


@query("""
WITH s AS (SELECT s_suppkey AS sheet, s_nationkey AS book, s_suppkey % 3 = 0 AS placed, s_suppkey % 2 = 0 AS tried, s_suppkey % 5 < 2 AS rotated FROM supplier), b AS (SELECT book, bool_or(placed) AS any_placed FROM s GROUP BY book)
SELECT sheet, CASE WHEN placed THEN 'done' WHEN any_placed AND NOT tried THEN 'fit_with_neighbours' WHEN NOT rotated THEN 'read_turned' ELSE 'unplaced' END AS action FROM s JOIN b USING (book)
""")
def second_pass(spark, d):
    rows = table(spark, d, "supplier").selectExpr("s_suppkey AS sheet", "s_nationkey AS book", "s_suppkey % 3 = 0 AS placed", "s_suppkey % 2 = 0 AS tried_near", "s_suppkey % 5 < 2 AS rotated")
    return runs.retries(rows)
