"""Connected components of a large graph, by alternating stars.

Every edge points from a larger node to a smaller one. A large star moves a node's larger neighbours to its smallest
neighbour, a small star its smaller ones; after a logarithmic number of rounds all edges point at their component's
smallest node. Minima are summed up before the shuffle, so a node with very many neighbours costs no reducer more than
one row per task; the joins have one row per node on one side, so adaptive execution can split the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    around = edges.select("small", "small").union(edges.select("small", "big")).union(edges.select("big", "small")).toDF("node", "near")
    least = around.groupBy("node").agg(F.min("near").alias("least"))
    return edges.join(least, edges["small"] == least["node"]).select("big", F.col("least").alias("small")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("big").agg(F.min("small").alias("least"))
    moved = edges.join(least, "big").where("small > least").select(F.col("small").alias("big"), F.col("least").alias("small"))
    return moved.union(least.select("big", F.col("least").alias("small"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge but the roots themselves; ``edges`` has two columns of one ordered type.

    root is the smallest node that can be reached. Null ends, loops and repeated edges don't matter.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).where(f"{a} is not null and {b} is not null and big > small")
    pairs = materialize(pairs.distinct(), "edges")
    while True:
        pairs = materialize(_small_star(_large_star(pairs)), "edges")
        # Done when every node points at one root only, and no root points any further.
        several = pairs.groupBy("big").count().where("count > 1")
        further = pairs.select("small").distinct().join(pairs.select("big"), F.col("small") == F.col("big"), "left_semi")
        if several.isEmpty() and further.isEmpty():
            return pairs.toDF("node", "root")
