"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable index of each of ``n`` points linked by pairs ``a``-``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        if np.array_equal(before, label):
            return label


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (u, v: long) -> (u, root) for every point with a link; ``root`` is the smallest
    point reachable. Each round is written to the shared folder, so no lineage grows, and a point
    with very many links only enters joins, whose skewed partitions Spark splits."""
    current = common.materialize(links.select("u", "v").filter("u <> v").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        current = common.materialize(_small_star(_large_star(current)).distinct(), "links")
        found = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        ).first()
        state = (found["n"], found["h"])
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = current.select("u", F.col("v").alias("root"))
    return stars.unionAll(stars.select("root").distinct().select(F.col("root").alias("u"), "root"))
