"""Connected components: spanning edges inside a task, star contraction across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.session import shared_dir


class Forest:
    """Components of at most a few thousand nodes inside one task.

    ``edges()`` gives one edge per node that is not the first of its component, so
    a group of n linked nodes leaves the task as n - 1 edges, not as n * n / 2.
    """

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            a, b = label[i], label[j]
            low = np.minimum(a, b)
            if (a == b).all():
                return
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label[label] != label).any():
                label[:] = label[label]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.nonzero(self.label != np.arange(len(self.label)))[0]
        return moved, self.label[moved]


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst bigint) -> (node, component): the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each one
    checkpointed in the shared folder; stops when a round changes no edge. Nodes
    that are the smallest of their component, and nodes without edges, have no row.
    """
    shared_dir(edges.sparkSession)
    e = (edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
         .where("u <> v").distinct().checkpoint())
    seen = _state(e)
    while seen[0]:
        e = _small_star(_large_star(e)).checkpoint()
        now = _state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = (e.join(low, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return low.select("u", F.col("m").alias("v")).union(moved).distinct()
