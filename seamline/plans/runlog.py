"""Run-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.operators import runlog
from seamline.plans import query
from seamline.sources.views import view


@query("""
SELECT run, stage, event_id, finished, elapsed_s FROM (
  SELECT *, row_number() OVER (PARTITION BY run, stage ORDER BY finished DESC NULLS LAST, event_id DESC) AS rn FROM v_runlog) WHERE rn = 1
""")
def latest_event_per_run_stage(spark, d):
    return runlog.latest_per_key(view(spark, d, "v_runlog"), ["run", "stage"], "finished", "event_id").select("run", "stage", "event_id", "finished", "elapsed_s")


@query("""
SELECT event_id, 'stage' AS key, stage AS value FROM v_runlog
UNION ALL SELECT event_id, 'props.k', CAST(json_extract(props, '$.k') AS VARCHAR) FROM v_runlog
UNION ALL SELECT event_id, 'ids', concat(CAST(event_id AS VARCHAR), ' ', CAST(run AS VARCHAR)) FROM v_runlog
""")
def runlog_flatten(spark, d):
    log = view(spark, d, "v_runlog")
    nested = log.select("event_id", "stage", F.from_json("props", "k int").alias("props"), F.array("event_id", "run").alias("ids"))
    return runlog.flat_pairs(nested, "event_id")


@query("""
SELECT stage, count(*) AS n, count(*) FILTER (elapsed_s < 20) AS n_ok, count(*) FILTER (elapsed_s >= 20 AND elapsed_s < 80) AS n_slow,
       count(*) FILTER (elapsed_s >= 80) AS n_refused, round(count(*) FILTER (elapsed_s < 20) * 1.0 / count(*), 6) AS ok_share,
       min(finished) AS first_utc, max(finished) AS last_utc, count(DISTINCT run) AS runs
FROM v_runlog GROUP BY stage
""")
def runlog_status_rollup(spark, d):
    return runlog.status_rollup(view(spark, d, "v_runlog"))


@query("""
SELECT event_id, run, stage, 'run' AS origin FROM v_runlog WHERE event_id % 3 <> 0
UNION ALL SELECT event_id, run, stage, 'master' FROM v_runlog m WHERE NOT EXISTS (SELECT 1 FROM v_runlog r WHERE r.event_id % 3 <> 0 AND r.event_id = m.event_id)
""")
def rebuild_antijoin(spark, d):
    log = view(spark, d, "v_runlog").select("event_id", "run", "stage")
    per_run = log.where("event_id % 3 <> 0").withColumn("origin", F.lit("run"))
    return runlog.rebuild(log.withColumn("origin", F.lit("master")), per_run)


@query("""
WITH e AS (SELECT * FROM v_runlog WHERE event_id % 16 < 2),
s AS (SELECT * FROM (VALUES ('view'), ('signup'), ('click'), ('error'), ('purchase')) v(stage))
SELECT r.run, s.stage, true AS backfilled FROM (SELECT DISTINCT run FROM e) r, s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.run = r.run AND e.stage = s.stage)
""")
def backfill_missing_stage(spark, d):
    """The log has lost events, so that runs lack stages."""
    return runlog.backfill(view(spark, d, "v_runlog").where("event_id % 16 < 2"), ["view", "signup", "click", "error", "purchase"])


@query("""
SELECT run, stage, sum(lap) / 1e6 AS seconds, count(*) AS laps FROM (
  SELECT run, stage, coalesce(epoch_us(finished) - epoch_us(lag(finished) OVER (PARTITION BY run ORDER BY finished, event_id)), 0) AS lap FROM v_runlog)
GROUP BY run, stage
""")
def lap_seconds(spark, d):
    return runlog.lap_seconds(view(spark, d, "v_runlog"))


@query("""
SELECT event_id, CAST(row_number() OVER (PARTITION BY run ORDER BY coalesce(CAST(epoch_us(finished) AS BIGINT), 0), event_id) AS INTEGER) AS place FROM v_runlog
""")
def rebuild_order(spark, d):
    from pyspark.sql import Window

    at = F.coalesce(F.unix_micros(F.col("finished").cast("timestamp")), F.lit(0))
    return view(spark, d, "v_runlog").select("event_id", F.row_number().over(Window.partitionBy("run").orderBy(at, "event_id")).alias("place"))


@query("""
SELECT stage, CASE WHEN elapsed_s < 20 THEN 'ok' WHEN elapsed_s < 80 THEN 'slow' ELSE 'refused' END AS status, count(*) AS n
FROM v_runlog GROUP BY ROLLUP (stage, status)
""")
def stage_status_totals(spark, d):
    log = view(spark, d, "v_runlog").withColumn("status", runlog.status_of(F.col("elapsed_s")))
    return log.rollup("stage", "status").agg(F.count("*").alias("n"))
