"""Queries over street layers and plane geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.functions import geo as G
from seamline.operators import streets
from seamline.plans import query
from seamline.plans.names import spell_sql, base_sql, turned_sql
from seamline.sources.views import table, view

_STEM = spell_sql(f"coalesce({turned_sql(base_sql('street'))}, {base_sql('street')})")
_ENDS = "SELECT street, ax AS x, ay AS y FROM v_segments UNION SELECT street, bx, by_ FROM v_segments"
_DIST = "sqrt(({px} - (ax + u * (bx - ax))) * ({px} - (ax + u * (bx - ax))) + ({py} - (ay + u * (by_ - ay))) * ({py} - (ay + u * (by_ - ay))))"
_U = "greatest(0.0e0, least(1.0e0, (({px} - ax) * (bx - ax) + ({py} - ay) * (by_ - ay)) / greatest((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay), 1e-9)))"


@query("""
SELECT p_name AS street, CAST(i - 1 AS INTEGER) AS part, (p_partkey % 90 + (i - 1) * 7) * 1.0e0 AS ax, (p_size * (i - 1)) * 1.0e0 AS ay, (p_partkey % 90 + i * 7) * 1.0e0 AS bx, (p_size * i) * 1.0e0 AS by_
FROM (SELECT *, unnest(range(1, 1 + p_partkey % 4)) AS i FROM part)
""")
def segments_from_polyline(spark, d):
    coords = F.transform(F.sequence(F.lit(0), (F.col("p_partkey") % 4).cast("int")), lambda i: F.struct(((F.col("p_partkey") % 90 + i * 7) * 1.0).alias("x"), (F.col("p_size") * i * 1.0).alias("y")))
    return streets.polyline_segments(table(spark, d, "part").select(F.col("p_name").alias("street"), coords.alias("coords")))


@query(f"SELECT x, y, string_agg(street, '|' ORDER BY street) AS names FROM ({_ENDS}) GROUP BY x, y HAVING count(DISTINCT street) >= 2")
def intersections(spark, d):
    return streets.intersections(view(spark, d, "v_segments")).select("x", "y", F.array_join("names", "|").alias("names"))


_SEEDS = f"""e AS ({_ENDS}), g AS (SELECT x, y FROM e GROUP BY x, y HAVING count(DISTINCT street) >= 2),
m AS (SELECT DISTINCT x, y, {_STEM} AS stem FROM e JOIN g USING (x, y) WHERE street NOT LIKE '% LANE'),
s AS (SELECT x, y, list(stem ORDER BY stem) AS stems FROM m GROUP BY x, y HAVING count(*) >= 2)"""


def _seeds(spark, d):
    layer = view(spark, d, "v_segments")
    return streets.seeds(streets.intersections(layer), layer.where("street NOT LIKE '% LANE'"))


@query(f"WITH {_SEEDS} SELECT x, y, array_to_string(stems, '|') AS stems FROM s")
def seed_pairs(spark, d):
    return _seeds(spark, d).select("x", "y", F.array_join("stems", "|").alias("stems"))


@query(f"""
WITH {_SEEDS}, n AS (SELECT a.x, a.y, len(list_distinct(flatten(list(b.stems)))) AS n_stems, count(*) AS n_seeds
  FROM s a JOIN s b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 14400 GROUP BY a.x, a.y)
SELECT x, y, CAST(n_stems AS INTEGER) AS n_stems, n_seeds FROM n ORDER BY n_stems DESC, n_seeds DESC, x, y LIMIT 1
""")
def densest_seed(spark, d):
    return streets.densest(_seeds(spark, d), 120.0)


_MATCHED = "SELECT DISTINCT sheet, label_id, street FROM v_labels JOIN (SELECT DISTINCT street FROM v_segments) k ON street IN (concat(text, ' ST'), concat(text, ' AVE'))"


@query(f"""
WITH m AS ({_MATCHED}), u AS (SELECT * FROM v_segments WHERE street IN (SELECT street FROM m)),
v AS (SELECT *, row_number() OVER (PARTITION BY street ORDER BY seg_id, k) - 1 AS i, count(*) OVER (PARTITION BY street) AS n
  FROM (SELECT street, seg_id, 0 AS k, ax AS px, ay AS py FROM u UNION ALL SELECT street, seg_id, 1, bx, by_ FROM u)),
g AS (SELECT v.street, t.street AS other, {_U.format(px='px', py='py')} AS u, px, py, ax, ay, bx, by_ FROM v JOIN u t ON v.street < t.street WHERE i % greatest(n // 60, 1) = 0),
gap AS (SELECT street, other, min({_DIST.format(px='px', py='py')}) AS d FROM g GROUP BY ALL),
pairs AS (SELECT * FROM gap UNION ALL SELECT other, street, d FROM gap),
o AS (SELECT m.sheet, m.label_id, min(d) AS nearest FROM m JOIN pairs USING (street) JOIN (SELECT DISTINCT sheet, street AS other FROM m) k ON k.sheet = m.sheet AND k.other = pairs.other
  WHERE (m.sheet, m.label_id, pairs.other) NOT IN (SELECT (sheet, label_id, street) FROM m) GROUP BY ALL)
SELECT DISTINCT m.sheet, m.label_id, coalesce(nearest > 45, false) AS alone FROM m LEFT JOIN o USING (sheet, label_id)
""")
def lonely_streets(spark, d):
    layer = view(spark, d, "v_segments")
    named = F.explode(F.array(F.concat("text", F.lit(" ST")), F.concat("text", F.lit(" AVE"))))
    matched = view(spark, d, "v_labels").select("sheet", "label_id", named.alias("street")).join(layer.select("street").distinct(), "street", "left_semi")
    return streets.lonely(matched, layer, 45.0)


@query("""
WITH w AS (SELECT street, seg_id, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) * CASE WHEN ax < 800 THEN 2.0e0 ELSE 1.0e0 END AS weight FROM v_segments)
SELECT street, seg_id, weight FROM (SELECT *, row_number() OVER (PARTITION BY street ORDER BY weight DESC, seg_id) AS rn FROM w) WHERE rn = 1
""")
def longest_segment(spark, d):
    return streets.longest_segment(view(spark, d, "v_segments"), F.col("ax") < 800)


@query("""
SELECT label_id, round(0.5e0 * px - 0.25e0 * py + 100, 6) AS mx, round(0.25e0 * px + 0.5e0 * py - 50, 6) AS my, px AS bx, py AS by_,
  round(0.75e0 * (cos(radians(30.0e0)) * px + sin(radians(30.0e0)) * py) + 10, 6) AS sx, round(0.75e0 * (sin(radians(30.0e0)) * px - cos(radians(30.0e0)) * py) + 20, 6) AS sy FROM v_labels
""")
def affine_apply(spark, d):
    a = [[0.5, -0.25, 100.0], [0.25, 0.5, -50.0]]
    px, py = F.col("px"), F.col("py")
    mx, my = G.affine(px, py, a)
    bx, by = G.affine(mx, my, G.inverse(a))
    sx, sy = G.affine(px, py, G.similarity(0.75, F.lit(30.0), 10.0, 20.0))
    named = {"mx": mx, "my": my, "bx": bx, "by_": by, "sx": sx, "sy": sy}
    return view(spark, d, "v_labels").select("label_id", *(F.round(v, 6).alias(k) for k, v in named.items()))


_E2 = "0.0066943799901413165e0"
_UTM = """WITH p AS (SELECT hit_id, lat, lon, radians(lat) AS phi, CAST(floor((lon + 180) / 6) AS INTEGER) + 1 AS zone FROM v_hits),
q AS (SELECT *, 0.0066943799901413165e0 AS e2, 0.006739496742276434e0 AS ep2 FROM p),
r AS (SELECT *, 6378137.0e0 / sqrt(1 - e2 * pow(sin(phi), 2)) AS n, pow(tan(phi), 2) AS t, ep2 * pow(cos(phi), 2) AS c, radians(lon - (6 * zone - 183)) * cos(phi) AS a,
  6378137.0e0 * ((1 - e2 / 4 - 3 * pow(e2, 2) / 64 - 5 * pow(e2, 3) / 256) * phi - (3 * e2 / 8 + 3 * pow(e2, 2) / 32 + 45 * pow(e2, 3) / 1024) * sin(2 * phi)
    + (15 * pow(e2, 2) / 256 + 45 * pow(e2, 3) / 1024) * sin(4 * phi) - (35 * pow(e2, 3) / 3072) * sin(6 * phi)) AS m FROM q)
SELECT hit_id, zone, round(0.9996e0 * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * pow(a, 5) / 120) + 500000, 3) AS east,
  round(0.9996e0 * (m + n * tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * pow(a, 6) / 720)), 3) AS north FROM r"""


def _projected(spark, d):
    zone = (F.floor((F.col("lon") + 180) / 6) + 1).cast("int")
    hits = view(spark, d, "v_hits").withColumn("zone", zone)
    x, y = G.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"), F.lit(True))
    return hits.withColumns({"east": x, "north": y})


@query(_UTM)
def utm_forward(spark, d):
    return _projected(spark, d).select("hit_id", "zone", F.round("east", 3).alias("east"), F.round("north", 3).alias("north"))


@query("SELECT hit_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM v_hits")
def utm_inverse(spark, d):
    """There and back again gives the coordinates that went in."""
    lon, lat = G.utm_inverse(F.col("east"), F.col("north"), F.col("zone"), F.lit(True))
    return _projected(spark, d).select("hit_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("""
SELECT hit_id, CAST((CASE WHEN lat - 50 >= 0 THEN 32600 ELSE 32700 END) + floor((lon * 1.5e0 + 180) / 6) + 1 AS INTEGER) AS epsg,
  CAST(floor((lon * 1.5e0 + 180) / 6) + 1 AS INTEGER) AS zone, lat - 50 >= 0 AS north FROM v_hits
""")
def epsg_for(spark, d):
    found = view(spark, d, "v_hits").select("hit_id", G.utm_epsg(F.col("lon") * 1.5, F.col("lat") - 50).alias("epsg"))
    zone, north = G.utm_zone(F.col("epsg"))
    return found.select("hit_id", "epsg", zone.alias("zone"), north.alias("north"))


@query("""
WITH b AS (SELECT municipality, min(lat) AS s, min(lon) AS w, max(lat) AS n, max(lon) AS e FROM v_hits GROUP BY municipality)
SELECT municipality, round(greatest(s - 2 / 111.32e0, -90), 6) AS s, round(w - 2 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS w,
  round(least(n + 2 / 111.32e0, 90), 6) AS n, round(e + 2 / (111.32e0 * cos(radians((s + n) / 2))), 6) AS e,
  round(abs((n - s) * 111.32e0 * (e - w) * 111.32e0 * cos(radians((s + n) / 2))), 3) AS area FROM b
""")
def bbox_pad_union(spark, d):
    box = view(spark, d, "v_hits").groupBy("municipality").agg(F.min("lat").alias("s"), F.min("lon").alias("w"), F.max("lat").alias("n"), F.max("lon").alias("e"))
    padded = G.pad_box(*(F.col(c) for c in "swne"), 2.0)
    area = F.abs((F.col("n") - F.col("s")) * G.KM_PER_DEG * (F.col("e") - F.col("w")) * G.KM_PER_DEG * F.cos(F.radians((F.col("s") + F.col("n")) / 2)))
    return box.select("municipality", *(F.round(v, 6).alias(c) for c, v in zip("swne", padded, strict=True)), F.round(area, 3).alias("area"))


@query("""
WITH b AS (SELECT seg_id, ((degrees(atan2(bx - ax, by_ - ay)) % 360) + 360) % 360 AS b FROM (SELECT seg_id, ax, ay, bx + seg_id % 7 * 10 AS bx, by_ - seg_id % 5 * 10 AS by_ FROM v_segments))
SELECT seg_id, round(b, 4) AS bearing, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(floor(((b + 22.5e0) % 360) / 45) AS INTEGER) + 1] AS side FROM b
""")
def bearing_side(spark, d):
    turned = view(spark, d, "v_segments").withColumns({"bx": F.expr("bx + seg_id % 7 * 10"), "by_": F.expr("by_ - seg_id % 5 * 10")})
    b = G.bearing(F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay"))
    return turned.select("seg_id", F.round(b, 4).alias("bearing"), G.side_of(b).alias("side"))


@query("SELECT tok_id, CASE WHEN x2 - x1 >= 2.0e0 * (y2 - y1) THEN 0.0e0 WHEN y2 - y1 >= 2.0e0 * (x2 - x1) THEN 90.0e0 END AS dir_deg FROM v_tokens")
def label_direction(spark, d):
    return view(spark, d, "v_tokens").select("tok_id", G.label_direction(*(F.col(c) for c in ("x1", "y1", "x2", "y2"))).alias("dir_deg"))


@query(f"""
WITH m AS (SELECT label_id, seg_id, {_U.format(px='px', py='py')} AS u, px, py, ax, ay, bx, by_ FROM v_labels JOIN v_segments
  ON px BETWEEN least(ax, bx) - 100 AND greatest(ax, bx) + 100 AND py BETWEEN least(ay, by_) - 100 AND greatest(ay, by_) + 100),
c AS (SELECT label_id, seg_id, {_DIST.format(px='px', py='py')} AS d FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY label_id ORDER BY d, seg_id) AS rn FROM c WHERE d <= 100)
SELECT l.label_id, seg_id, round(d, 6) AS dist FROM v_labels l LEFT JOIN r ON l.label_id = r.label_id AND rn = 1
""")
def nearest_segment(spark, d):
    points = view(spark, d, "v_labels").select(F.col("label_id").alias("point_id"), "px", "py")
    found = streets.nearest_segment(points, view(spark, d, "v_segments"), 100.0)
    return found.select(F.col("point_id").alias("label_id"), "seg_id", F.round("dist", 6).alias("dist"))


@query(f"""
WITH p AS (SELECT label_id, px * 4 AS px, py AS py FROM v_labels), m AS (SELECT label_id, seg_id, {_U.format(px='px', py='py')} AS u, px, py, ax, ay, bx, by_ FROM p, v_segments),
c AS (SELECT label_id, min({_DIST.format(px='px', py='py')}) AS d FROM m GROUP BY label_id)
SELECT label_id, round(d, 6) AS dist FROM c
""")
def nearest_at_any_distance(spark, d):
    """Points far outside of the layer find their segment too."""
    points = view(spark, d, "v_labels").select(F.col("label_id").alias("point_id"), (F.col("px") * 4).alias("px"), "py")
    found = streets.nearest_of_all(points, view(spark, d, "v_segments"), 100.0)
    return found.select(F.col("point_id").alias("label_id"), F.round("dist", 6).alias("dist"))


_RINGS = """SELECT p_partkey AS ring_id, (p_partkey * 71 % 41) * 40.0e0 + 3.5e0 AS x0, (p_partkey * 113 % 43) * 40.0e0 + 5.3125e0 AS y0, 20.0e0 + p_size AS w, 30.0e0 + p_size % 7 * 4 AS h FROM part"""


def _rings(spark, d):
    boxes = spark.sql(_RINGS.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    at = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    return boxes.select("ring_id", F.array(at(0.0, 0.0), at(F.col("w"), 0.0), at(F.col("w"), F.col("h")), at(F.col("w") / 2, F.col("h") + 16.0), at(0.0, F.col("h"))).alias("ring"))


@query(f"""
WITH r AS ({_RINGS}) SELECT ring_id, round(w * h + w * 8.0e0, 6) AS area, round(w + 2 * h + 2 * sqrt(w * w / 4 + 256.0e0), 6) AS perimeter,
  round(4 * pi() * (w * h + w * 8.0e0) / pow(w + 2 * h + 2 * sqrt(w * w / 4 + 256.0e0), 2), 6) AS compactness, round(x0 + w / 2, 6) AS cx FROM r
""")
def ring_metrics(spark, d):
    import math

    area, edge = G.ring_area(F.col("ring")), G.ring_perimeter(F.col("ring"))
    cx = F.aggregate("ring", F.lit(0.0), lambda a, p: a + p["x"]) / F.size("ring")
    return _rings(spark, d).select("ring_id", F.round(area, 6).alias("area"), F.round(edge, 6).alias("perimeter"), F.round(4 * math.pi * area / (edge * edge), 6).alias("compactness"), F.round(cx, 6).alias("cx"))


_HELD = f"""r AS ({_RINGS}), h AS (SELECT l.label_id, r.ring_id FROM v_labels l JOIN r ON px > x0 AND px < x0 + w AND py > y0
  AND py < CASE WHEN px < x0 + w / 2 THEN y0 + h + (px - x0) / (w / 2) * 16.0e0 ELSE y0 + h + (x0 + w - px) / (w / 2) * 16.0e0 END)"""


@query(f"WITH {_HELD} SELECT l.label_id, min(ring_id) AS ring_id, CASE WHEN min(ring_id) IS NULL THEN 'orphan' END AS reason FROM v_labels l LEFT JOIN h USING (label_id) GROUP BY l.label_id")
def outline_home(spark, d):
    points = view(spark, d, "v_labels").select(F.col("label_id").alias("point_id"), "px", "py")
    return streets.homes(points, _rings(spark, d), 64.0).select(F.col("point_id").alias("label_id"), "ring_id", "reason")


@query(f"WITH {_HELD} SELECT ring_id, count(*) AS n FROM h GROUP BY ring_id")
def point_in_ring(spark, d):
    return streets.ring_counts(view(spark, d, "v_labels"), _rings(spark, d), 64.0)


@query(f"""
WITH r AS ({_RINGS}), v AS (SELECT ring_id, i, CASE i WHEN 0 THEN x0 WHEN 1 THEN x0 + w WHEN 2 THEN x0 + w WHEN 3 THEN x0 + w / 2 ELSE x0 END AS px, CASE i WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y0 + h WHEN 3 THEN y0 + h + 16 ELSE y0 + h END AS py
  FROM (SELECT *, unnest(range(0, 5)) AS i FROM r)),
m AS (SELECT ring_id, street, i, {_U.format(px='px', py='py')} AS u, px, py, ax, ay, bx, by_ FROM v JOIN v_segments ON px BETWEEN least(ax, bx) - 16 AND greatest(ax, bx) + 16 AND py BETWEEN least(ay, by_) - 16 AND greatest(ay, by_) + 16),
c AS (SELECT ring_id, street, i, {_DIST.format(px='px', py='py')} AS d FROM m)
SELECT ring_id, street, round(min(d), 6) AS best, round(count(DISTINCT i) / 5.0e0, 6) AS share FROM c WHERE d <= 16 GROUP BY ring_id, street HAVING count(DISTINCT i) >= 2
""")
def block_bounds(spark, d):
    found = streets.bounding_streets(_rings(spark, d), view(spark, d, "v_segments"), 16.0, 0.4)
    return found.select("ring_id", "street", F.round("best", 6).alias("best"), F.round("share", 6).alias("share"))
