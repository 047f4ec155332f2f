"""Fixture views over the generic tables, in SQL that Spark and the oracle both read.

They use integer and dyadic arithmetic only, so that both give the same bits.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_tokens": """
SELECT event_id AS tok_id, user_id % 5 AS sheet, upper(event_type) AS text,
       CASE WHEN event_id % 5 = 0 THEN 30 ELSE 0 END AS rotation,
       concat('p', CAST(event_id % 3 AS STRING), CASE WHEN event_id % 5 = 0 THEN '@30' ELSE '' END) AS tile,
       event_id % 40 AS edge_margin,
       (event_id * 37 % 509) * 4 + event_id % 7 AS x1,
       (event_id * 53 % 509) * 4 + event_id % 5 AS y1,
       (event_id * 37 % 509) * 4 + event_id % 7 + 24 + event_id % 11 AS x2,
       (event_id * 53 % 509) * 4 + event_id % 5 + 12 + event_id % 6 AS y2
FROM {events}""",
    "v_segments": """
SELECT p_partkey AS seg_id,
       concat(upper(p_name), CASE p_size % 4 WHEN 0 THEN ' ST' WHEN 1 THEN ' AVE' WHEN 2 THEN ' RD' ELSE ' LANE' END) AS street,
       (p_partkey * 71 % 41) * 40.0e0 AS ax, (p_partkey * 113 % 43) * 40.0e0 AS ay,
       (p_partkey * 71 % 41 + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END) * 40.0e0 AS bx,
       (p_partkey * 113 % 43 + CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 1 END) * 40.0e0 AS by_
FROM {part}""",
    "v_labels": """
SELECT c.c_custkey AS label_id, c.c_nationkey AS sheet, upper(p.p_name) AS text,
       (c.c_custkey * 91 % 1637) * 1.0e0 AS px, (c.c_custkey * 57 % 1699) * 1.0e0 AS py,
       CASE c.c_custkey % 3 WHEN 0 THEN 0.0e0 WHEN 1 THEN 90.0e0 ELSE CAST(NULL AS DOUBLE) END AS dir_deg
FROM {customer} c JOIN {part} p ON p.p_partkey = c.c_custkey % 200""",
    "v_hits": """
SELECT c_custkey AS hit_id, concat('N', CAST(c_nationkey AS STRING)) AS name, c_mktsegment AS municipality,
       40.0e0 + (c_custkey * 131 % 4096) * 0.0009765625e0 AS lat,
       -100.0e0 + (c_custkey * 197 % 8192) * 0.0009765625e0 AS lon
FROM {customer}""",
    "v_runlog": "SELECT event_id, user_id AS run, event_type AS stage, ts AS finished, value AS elapsed_s, props FROM {events}",
    "v_seq": "SELECT user_id AS sheet, event_id AS pos, CASE WHEN event_type IN ('click', 'view') THEN 'A' ELSE 'B' END AS text FROM {events}",
    "v_count": "SELECT conv_id AS sheet, turn AS pos, turn AS val FROM {conversations}",
    "v_text": """
SELECT p_partkey AS id,
       concat(p_name, '(', CAST(p_size AS STRING), ',', CAST(p_partkey % 900 AS STRING), '),(', CAST(p_size + 30 AS STRING), ',',
              CAST(p_partkey % 900 + 12 AS STRING), ')', p_brand, '(', CAST(p_partkey * 7 % 1100 AS STRING), ',10),(',
              CAST(p_partkey * 3 % 1100 AS STRING), ',40)') AS content
FROM {part}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", sql)})


def oracle(sql: str) -> str:
    """``sql`` with the views it names put before it."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    views = ",\n".join(f"{n} AS ({re.sub(r'[{}]', '', VIEWS[n])})" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[14:]}"
    return f"WITH {views},\n{body[4:]}" if body.upper().startswith("WITH") else f"WITH {views}\n{body}"
