"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamline.llm.common import Stash


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the smallest v of each u. Minima are combined before the shuffle; a hub's rows can be split by AQE."""
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("m")), "u")


def components(edges: DataFrame, stash: Stash, name: str) -> DataFrame:
    """(a, b) -> (node, component), the smallest node reachable, for every node with an edge.

    Each round is written to the shared folder, so lineage stays short. Self
    loops and repeated edges are allowed; no edges give no rows.
    """
    now = stash.put(f"{name}-0", edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state, step = None, 0
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        starred = _smallest(large)
        small = (
            starred.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(starred.select("u", F.col("m").alias("v")))
            .distinct()
        )
        step += 1
        after = stash.put(f"{name}-{step}", small)
        stash.drop(f"{name}-{step - 1}")
        found = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if tuple(found) == state or not found[0]:
            break
        state = tuple(found)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def link_labels(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the two sides of a link matrix."""
    rows, columns = links.shape
    low, high = np.arange(rows), np.arange(columns) + rows
    none = rows + columns
    while True:
        left = np.minimum(low, np.where(links, high[None, :], none).min(1))
        right = np.minimum(high, np.where(links, left[:, None], none).min(0))
        if (left == low).all() and (right == high).all():
            return low, high
        low, high = left, right
