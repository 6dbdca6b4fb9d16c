"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the links ``a``, ``b``.

    Rounds of two steps: every node hands its larger neighbours, then its smaller ones, on to its
    smallest neighbour, until nothing changes. The number of rounds grows with the logarithm of the
    size of a component. Smallest neighbours are combinable minima, and a node with very many links
    is split by the join, not gathered. Each round is a table in the shared folder; the driver sees
    one row of sums. Null nodes are not linked; an empty table has no node.
    """
    links = kept(links.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written, so that the join deals out plain rows, which Spark can split
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "minima")
        large = kept(both.filter("b > a").join(least, "a").filter("b <> m")
                     .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(least, "a")
        small = (small.select("a", F.col("m").alias("b"))
                 .unionAll(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .distinct())
        links = kept(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def joined(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the members ``a`` and ``b`` pair by pair in an array that names each member's root,
    its smallest one; on return every member points to its root."""
    while True:
        x, y = roots[a], roots[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots[:] = up
