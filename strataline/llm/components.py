"""Connected components of a large graph, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.storage import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is the component's smallest node.

    Each step regroups the edges around each node's smallest neighbour, so their number never
    grows and paths halve; nothing is collected but a count and a checksum. Every round is
    written to the shared folder, which ends its lineage. Edges with a null end and loops are
    ignored; repeated edges count once.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    state = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(lowest.select("u", F.col("m").alias("v")))
        step = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        current = stored(step, name)
        now = tuple(
            current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        )
        if now == state or not now[0]:
            break
        state = now
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b, the smallest node that each one reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before):
            return root
