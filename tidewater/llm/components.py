"""Connected components: of arrays inside a task, and of an edge table across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, run, written


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges ``a``-``b`` connect, without loops."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, before[left], low)
        np.minimum.at(label, before[right], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def star_table(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edge table: root is the smallest node it reaches, itself included.

    Alternates the large-star and small-star steps, each a grouped minimum and a join, until no edge
    changes; every round is written to the shared folder. Loops and repeated edges do no harm.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    state = None
    with run() as own:
        while not now.isEmpty():
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            now = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
            forget(edges.sparkSession, own)  # the round before
            after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if after == state:
                break
            state = after
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
