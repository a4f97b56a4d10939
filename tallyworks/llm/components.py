"""Connected components of links, by alternating star contraction.

Every step is an aggregate and a join on the node, so Spark combines a hub's links before the shuffle and
splits its rows in the join; nothing is gathered per component. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import written

MAX_ROUNDS = 60


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the (a, b) links; root is the smallest node of the component.

    Self-links and repeated links do no harm; no links give no rows.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: every neighbour above a node goes to the least of the node and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its neighbours below go to the least of them
        least = _least(large)
        small = large.join(least, "a")
        edges = written(
            small.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct(),
            "links",
        )
        # the same links as before: every node points at its root
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError("components did not settle")
