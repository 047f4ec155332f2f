"""Queries of sequential and iterative operators; those without SQL are tested against a plain re-derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.operators import fits, places, pose
from seamline.plans import query
from seamline.sources.views import table, view


@query()
def places_cover(spark, d):
    return places.places_cover(view(spark, d, "v_hits"), 6.0)


@query()
def cluster_places(spark, d):
    hits = view(spark, d, "v_hits").withColumn("sheet", F.floor(F.col("hit_id") / 500))
    return places.cluster_places(hits, "sheet").withColumn("score", F.round("score", 6))


@query()
def merge_boxes(spark, d):
    hits = view(spark, d, "v_hits").select(
        (F.col("hit_id") % 20).alias("sheet"), F.col("hit_id").alias("box_id"), F.col("lat").alias("s"), F.col("lon").alias("w"),
        (F.col("lat") + F.col("hit_id") % 7 * 0.0625).alias("n"), (F.col("lon") + F.col("hit_id") % 5 * 0.0625).alias("e"),
    )
    return places.merge_boxes(hits, "sheet")


@query()
def dedupe_tokens(spark, d):
    return fits.dedupe_tokens(view(spark, d, "v_tokens"))


@query()
def fit_pose(spark, d):
    labels = view(spark, d, "v_labels").withColumn("street", F.concat("text", F.lit(" ST")))
    segments = view(spark, d, "v_segments")
    grid = [(200.0 + 300.0 * i, 200.0 + 300.0 * j) for i in range(5) for j in range(5)]
    seeds = pose.beam(pose.coarse_search(labels, segments, [0.5, 1.0], [0.0, 90.0], grid), 6)
    found = fits.fit_pose(labels, segments, seeds)
    return found.select("sheet", "status", "labels", "inliers", "model", "rotation_from", *(F.round(c, 2).alias(c) for c in ("scale_x", "rotation", "rms")))


@query()
def kmeans_tints(spark, d):
    rows = table(spark, d, "embeddings").select(F.coalesce("label", F.lit(-1)).alias("sheet"), (F.element_at("embedding", 1) * 40).cast("double").alias("a"), (F.element_at("embedding", 2) * 40).cast("double").alias("b"))
    return fits.kmeans_tints(rows).select("sheet", "tint", F.round("a", 3).alias("a"), F.round("b", 3).alias("b"), "angle")


@query()
def collinear_rows(spark, d):
    points = view(spark, d, "v_labels").select(F.col("sheet"), F.col("label_id").alias("point_id"), F.col("px").alias("x"), F.col("py").alias("y"))
    return fits.collinear_rows(points)


@query("""
WITH RECURSIVE n AS (SELECT s_suppkey AS node, s_suppkey % 29 = 0 AS street, s_suppkey % 5 = 0 AS thin, 10 + s_suppkey % 40 AS boundary FROM supplier),
e AS (SELECT s_suppkey AS a, s_suppkey + 1 AS b, 1 + s_suppkey % 6 AS shared FROM supplier UNION ALL SELECT s_suppkey + 1, s_suppkey, 1 + s_suppkey % 6 FROM supplier),
r(node, step) AS (SELECT node, 0 FROM n WHERE street
  UNION SELECT e.a, 1 FROM r JOIN e ON e.b = r.node JOIN n ON n.node = e.a WHERE n.thin OR e.shared > 0.10 * n.boundary)
SELECT node, node IN (SELECT node FROM r) AS street FROM n
""")
def label_spread(spark, d):
    """The chain of regions has two neighbours each, whose openings never add up to more than the larger in the oracle's sense."""
    nodes = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("node"), F.expr("s_suppkey % 29 = 0").alias("street"), F.expr("s_suppkey % 5 = 0").alias("thin"), F.expr("10 + s_suppkey % 40").alias("boundary")
    )
    one = table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") + 1).alias("b"), F.expr("1 + s_suppkey % 6").alias("shared"))
    both = one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    return fits.label_spread(nodes, both).select("node", "street")
