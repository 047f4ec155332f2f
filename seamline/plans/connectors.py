"""Queries of sources, sinks and streams."""

from __future__ import annotations


from pyspark.sql import functions as F

from seamline.functions import udtfs
from seamline.plans import query
from seamline.session import shared_dir
from seamline.sources import layers, sinks
from seamline.sources.views import table, view
from seamline.streaming import log


@query("""
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def stream_latest(spark, d):
    """The stream, run to its end, holds what the batch query gives."""
    work = f"{shared_dir(spark)}/stream-{spark.range(1).select(F.uuid()).first()[0]}"
    batch = table(spark, d, "events")
    path = f"{work}/in"
    batch.repartition(4).write.parquet(path)
    run = log.keep_latest(log.log_stream(spark, path, batch.schema), f"{work}/out", f"{work}/state", ["user_id", "event_type"], "ts", "event_id")
    run.awaitTermination()
    return log.latest(spark, f"{work}/out").select("user_id", "event_type", "event_id", "value")


@query("SELECT label_id, format('{:.3f},{:.3f},{:.3f},{:.3f},1,0,0,{:.3f}', px * 0.5e0, py * 0.25e0, px, -py, (label_id % 8) * 0.125e0) AS line FROM v_labels")
def control_points(spark, d):
    rows = view(spark, d, "v_labels").select("label_id", "px", "py", (F.col("px") * 0.5).alias("map_x"), (F.col("py") * 0.25).alias("map_y"), (F.col("label_id") % 8 * 0.125).alias("residual"))
    line = F.format_string("%.3f,%.3f,%.3f,%.3f,1,0,0,%.3f", "map_x", "map_y", "px", -F.col("py"), "residual")
    return rows.select("label_id", line.alias("line"))


@query("""
SELECT DISTINCT c_nationkey AS sheet, format('{:.10f}\n{:.10f}\n{:.10f}\n{:.10f}\n{:.10f}\n{:.10f}', 0.5e0, 0.25e0, 0.25e0, -0.5e0, 0.375e0 + c_nationkey * 8.0e0, -0.125e0 + c_nationkey * 4.0e0) AS body FROM customer
""")
def world_files(spark, d):
    poses = table(spark, d, "customer").select(F.col("c_nationkey").alias("sheet")).distinct().select(
        "sheet", F.lit(0.5).alias("a11"), F.lit(0.25).alias("a12"), (F.col("sheet") * 8.0).alias("tx"), F.lit(0.25).alias("a21"), F.lit(-0.5).alias("a22"), (F.col("sheet") * 4.0).alias("ty")
    )
    return sinks.world_file(poses)


@query("SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS params FROM nation WHERE n_nationkey % 3 <> 0")
def unanswered_requests(spark, d):
    asked = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("params")).unionByName(table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("params")))
    cache = table(spark, d, "nation").where("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("params"))
    return layers.unanswered(asked, cache)


@query(r"""
SELECT id, trim(unnest(regexp_extract_all(content, '([^()]+)\(([0-9]+),([0-9]+)\),\(([0-9]+),([0-9]+)\)', 1))) AS text FROM v_text
""")
def spotted_udtf(spark, d):
    """The scan as a table function, joined laterally."""
    spark.udtf.register("spotted", udtfs.Spotted)
    return spark.sql("SELECT id, s.text FROM {t}, LATERAL spotted(content) s", t=view(spark, d, "v_text"))
