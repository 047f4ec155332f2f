"""Roll-ups of what was read and placed, a row for each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reading(tiles: DataFrame, views: DataFrame, reads: DataFrame, sheets: DataFrame) -> DataFrame:
    """Measures of a run's reading.

    ``tiles`` (run, tile, status, x0, y0, x1, y1), ``views`` (run, tile, rotation, hit_cap, runaway, generate_s, prepare_s,
    input_tokens, output_tokens, utc; times are null for views without metadata), ``reads`` (run, duplicate, fragment, conflict),
    ``sheets`` (run, source_w, source_h, work_scale). Pixels count once for each view, as the model saw them.
    """
    ok = F.col("status") == "ok"
    of_tiles = tiles.groupBy("run").agg(
        F.count("*").alias("tiles_planned"), F.count_if(ok).alias("tiles_read"), F.count_if(F.col("status") == "skipped_blank").alias("tiles_blank"), F.count_if(F.col("status") == "not_selected").alias("tiles_not_selected")
    )
    area = F.greatest(F.col("x1") - F.col("x0"), F.lit(0)) * F.greatest(F.col("y1") - F.col("y0"), F.lit(0))
    seen = views.join(tiles.where(ok).select("run", "tile", area.cast("long").alias("px")), ["run", "tile"])
    told = F.col("generate_s").isNotNull()
    of_views = seen.groupBy("run").agg(
        F.count("*").alias("views"), F.count_if(told).alias("views_with_metadata"), F.count_if("hit_cap").alias("views_hit_cap"), F.sum("px").alias("pixels_work"), F.sum("runaway").alias("runaway_dropped"),
        F.round(F.sum("generate_s"), 3).alias("generate_s"), F.round(F.sum(F.when(told, F.coalesce("prepare_s", F.lit(0.0)))), 3).alias("prepare_s"),
        F.sum(F.when(told, F.col("input_tokens"))).alias("input_tokens"), F.sum(F.when(told, F.col("output_tokens"))).alias("output_tokens"),
        F.count_distinct("rotation").alias("rotations"), F.min(F.when(told, F.col("utc"))).alias("first_utc"), F.max(F.when(told, F.col("utc"))).alias("last_utc"),
    )
    kept = ~(F.col("duplicate") | F.col("fragment") | F.col("conflict"))
    of_reads = reads.groupBy("run").agg(F.count("*").alias("tokens"), F.count_if(kept).alias("tokens_kept"), F.count_if("duplicate").alias("tokens_duplicate"), F.count_if("fragment").alias("tokens_fragment"), F.count_if("conflict").alias("tokens_conflict"))
    joined = sheets.join(of_tiles, "run", "left").join(of_views, "run", "left").join(of_reads, "run", "left")
    return joined.withColumns(
        {
            "source_px": F.col("source_w") * F.col("source_h"),
            "pixels_source": F.bround(F.try_divide(F.col("pixels_work"), F.col("work_scale") * F.col("work_scale")), 0).cast("long"),
            "generate_s_per_view": F.round(F.try_divide("generate_s", "views_with_metadata"), 3),
            "generate_s_per_megapixel": F.round(F.try_divide(F.col("generate_s"), F.col("pixels_work") / 1e6), 3),
            "tokens_per_view": F.round(F.try_divide(F.col("tokens").cast("double"), "views"), 3),
        }
    ).drop("source_w", "source_h", "work_scale")


def outputs(features: DataFrame) -> DataFrame:
    """(run, product, features, kinds) of (run, product, kind): counts, and a map from kind to count; null kinds count as "?"."""
    counts = features.groupBy("run", "product", F.coalesce("kind", F.lit("?")).alias("kind")).count()
    listed = F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "count"))))
    return counts.groupBy("run", "product").agg(F.sum("count").alias("features"), listed.alias("kinds"))


def provenance(layers: DataFrame) -> DataFrame:
    """(layer, names, features, area_km2) of street features (layer, name, s, w, n, e), the box being that which was asked for."""
    tall, wide = F.abs(F.first("n") - F.first("s")) * 111.32, F.abs(F.first("e") - F.first("w")) * 111.32
    area = tall * wide * F.cos(F.radians((F.first("n") + F.first("s")) / 2))
    return layers.groupBy("layer").agg(F.count_distinct(F.upper(F.when(F.col("name") != "", F.col("name")))).alias("names"), F.count("*").alias("features"), F.round(area, 1).alias("area_km2"))


def recall_by_angle(upright: DataFrame, found: DataFrame) -> DataFrame:
    """(sheet, angle, reads, recall, alphabetic) of upright reads (sheet, tok_id, text) and pairs (sheet, tok_id, angle) found again."""
    angles = found.select("sheet", "angle").distinct()
    hits = found.select("sheet", "tok_id", "angle").distinct().withColumn("hit", F.lit(1.0))
    letters = F.col("text").rlike("[A-Za-z]")
    rows = upright.join(angles, "sheet").join(hits, ["sheet", "tok_id", "angle"], "left").withColumn("hit", F.coalesce("hit", F.lit(0.0)))
    return rows.groupBy("sheet", "angle").agg(F.count("*").alias("reads"), F.round(F.avg("hit"), 6).alias("recall"), F.round(F.avg(F.when(letters, F.col("hit"))), 6).alias("alphabetic"))
