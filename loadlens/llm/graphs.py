"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """From links (a long, b long): node, component (its smallest reachable node); one row per node of a link.

    Alternating large-star and small-star steps: each sends the neighbours of a node to the smallest of them, so the
    number of links never grows and a path shrinks in about log steps. A step is two combined aggregates and two joins;
    no node's neighbours are gathered. Each round's links are written to the shared folder. Empty links give no row.
    """
    pair = lambda x, y: [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]
    edges = stored(links.where("a <> b").select(*pair(F.col("a"), F.col("b"))).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        large = stored(large, "links")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(*pair(F.col("b"), F.col("m")))
        small = small.unionByName(lower.select(F.col("a"), F.col("m").alias("b"))).where("a > b").distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)


def forest(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, b) of numbers below ``count``, those that join two parts not joined before: (smallest, member)."""
    parent = np.arange(count)
    while True:
        low = np.minimum(parent[a], parent[b])
        new = parent.copy()
        np.minimum.at(new, parent[a], low)
        np.minimum.at(new, parent[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == parent).all():
            break
        parent = new
    member = np.flatnonzero(parent != np.arange(count))
    return parent[member], member
