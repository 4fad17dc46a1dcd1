"""Connected components of an undirected graph by alternating large-star and
small-star steps: every step is an aggregate and a join on the node, so no
component is ever in one task or on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import stage_table


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b) to rows (node, component) for every node that has an
    edge to another; component is the smallest node reachable."""
    e = stage_table(edges.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = None
    while True:
        # large star: the larger neighbours of u go to the smallest of u and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours go to the smallest of them
        down = large.where("u != v").distinct()
        floor = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(
            floor.select("u", F.col("m").alias("v")))
        e = stage_table(small.distinct(), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))


def local_roots(link: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of a two-sided link matrix, the smallest index (left part, then right
    part) that each side's members reach. ``same``: both sides are the same
    members."""
    n, m = link.shape
    if same:
        link = link | np.eye(n, dtype=bool)
    left, right = np.arange(n), np.arange(n, n + m)
    while True:
        new_left = np.minimum(left, np.where(link, right[None, :], n + m).min(1, initial=n + m))
        new_right = np.minimum(right, np.where(link, new_left[:, None], n + m).min(0, initial=n + m))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right
