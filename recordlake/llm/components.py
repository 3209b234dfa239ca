"""Connected components of links between documents, as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.store import release, stored


def local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member number of the component of each of ``n`` nodes."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _pointing_down(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, each once."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (u, v): the smallest id reachable from it.

    Alternates large-star and small-star steps until nothing changes; edges then point from
    every node straight to the smallest one. Each step is a minimum per node, computed with
    partial sums before the shuffle, and a join that adaptive execution can split where a
    node has very many edges. Every round is written to the shared folder. Nothing but two
    numbers per round reaches the driver.
    """
    now = stored(_pointing_down(edges), "links")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Repeated edges do no harm until the end of the round.
        large = both.where("v > u").join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v")
        new = stored(_pointing_down(small), "links")
        new_mark = _mark(new)
        release(now)
        now = new
        if new_mark == mark:
            break
        mark = new_mark
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
