"""Connected components of an edge table, by small stars and pointer jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import salt, settled

ROUNDS = 60


def _least(column: str, *keys: str) -> Column:
    return F.min(column).over(Window.partitionBy(*keys))


def _tied(pairs: DataFrame) -> DataFrame:
    """node, root, own and moved: the roots of each node tied to the least of them; ``own`` marks its one own row.

    A node's rows are spread over salts. Each part ties its roots to its own least one, and the parts' least roots,
    at most one for each salt, go to the least of all: a window never holds more than a part of a hot node.
    """
    parts = pairs.withColumn("_salt", salt("root")).withColumn("part", _least("root", "node", "_salt"))
    inner = parts.where("root > part").select(F.col("root").alias("node"), F.col("part").alias("root"))
    heads = parts.where("root = part").select("node", "part").withColumn("least", _least("part", "node"))
    outer = heads.where("part > least").select(F.col("part").alias("node"), F.col("least").alias("root"))
    own = heads.select("node", F.col("least").alias("root"), F.lit(True).alias("own"))
    freed = inner.unionByName(outer).withColumn("own", F.lit(False))
    return own.unionByName(freed).distinct().withColumn("moved", ~F.col("own"))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of ``edges`` (a, b); ids are not NULL.

    Each round ties all roots that a node sees to the smallest one and then every node to the root of its root, so the
    number of rounds grows with the logarithm of the nodes. Both steps are settled, which leaves the join of the second
    a plain one whose hot roots the optimiser can split. Rows say themselves whether the round moved them; a round
    that moved none was the last, and that is all the driver learns of it.
    """
    pairs = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")))
    for _ in range(ROUNDS):
        tied = settled(_tied(pairs))
        above = tied.where("own").select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = (F.col("moved") | F.col("above").isNotNull()).alias("moved")
        pairs = settled(tied.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"), moved))
        if pairs.where("moved").isEmpty():
            break
        pairs = pairs.select("node", "root")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = pairs.select(F.col("root").alias("node")).distinct()
    return pairs.select("node", F.col("root").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
