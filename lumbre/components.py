"""Connected components by alternating large and small stars, on DataFrames.

Each round attaches every node's larger neighbours to its smallest one, then every
node's smaller neighbours likewise; the edges become stars around each component's
smallest node in a number of rounds that grows with the logarithm of the longest path.
Rounds are cut from each other by written tables; nothing comes to the driver but two
sums that tell when a round changed nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is its component's smallest node.

    Null ends and loops are left out. Nodes are of any type that Spark can order.
    """
    clean = edges.filter("u IS NOT NULL AND v IS NOT NULL AND u != v").select("u", "v").distinct()
    now = scratch.save(clean, "components", compact=True)
    before = None
    for _ in range(most_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before, last = mark, now
        now = scratch.save(_small_star(_large_star(now)), "components", compact=True)
        scratch.discard(last)
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
