"""Sequence, union and order queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamline.operators import sequences
from seamline.plans import query
from seamline.sources.views import table, view


@query("""
SELECT sheet, min(pos) AS first_pos, min(val) AS first_val, count(*) AS length FROM (
  SELECT *, val - row_number() OVER (PARTITION BY sheet ORDER BY pos) AS island FROM v_count)
GROUP BY sheet, island HAVING count(*) >= 5
""")
def counting_runs(spark, d):
    return sequences.counting_runs(view(spark, d, "v_count"))


@query("""
WITH m AS (SELECT *, CASE WHEN text = lag(text) OVER (PARTITION BY sheet ORDER BY pos) THEN 0 ELSE 1 END AS new FROM v_seq),
r AS (SELECT *, sum(new) OVER (PARTITION BY sheet ORDER BY pos) AS run FROM m),
c AS (SELECT *, count(*) OVER (PARTITION BY sheet, run) AS length, row_number() OVER (PARTITION BY sheet, run ORDER BY pos) AS rn FROM r)
SELECT sheet, pos, text, length FROM c WHERE length < 5 OR rn = 1
""")
def repetition_runs(spark, d):
    return sequences.repetition_runs(view(spark, d, "v_seq"))


@query("""
SELECT tok_id, sheet, row_number() OVER (PARTITION BY sheet ORDER BY edge_margin < 8, y1, x1, tok_id) AS place FROM v_tokens
""")
def reading_order(spark, d):
    tokens = view(spark, d, "v_tokens").withColumn("dropped", F.col("edge_margin") < 8)
    return sequences.reading_order(tokens).select("tok_id", "sheet", F.col("place").cast("long").alias("place"))


@query("""
SELECT p_partkey AS id, p_brand AS kind, CAST(NULL AS DOUBLE) AS price, 'parts' AS sheet FROM part
UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'orders' END FROM orders
""")
def merge_union(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("kind"), F.lit(None).cast("string").alias("sheet"), F.lit("parts").alias("stem"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("sheet"), F.lit("orders").alias("stem"),
    )
    return sequences.merged([parts, orders]).select("id", "kind", "price", "sheet")


@query("""
SELECT event_id, event_type AS stage, value AS elapsed_s, CAST(NULL AS VARCHAR) AS role FROM events
UNION ALL SELECT conv_id * 1000 + turn, 'turn', NULL, role FROM conversations
""")
def csv_union_columns(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("event_type").alias("stage"), F.col("value").alias("elapsed_s"))
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("event_id"), F.lit("turn").alias("stage"), "role")
    return events.unionByName(turns, allowMissingColumns=True)
