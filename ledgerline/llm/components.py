"""Connected components of links, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the exchange) and a join, so a
node with very many links is split by adaptive execution; nothing is collected.
Iterations write their links to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged, unstage


def _step(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) to the smallest neighbour; with ``large``, of the greater neighbours only."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both.where("b < a") if not large else both
    least = side.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = (both.where("b > a") if large else side).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Self-links and repeated links are allowed; no links give no rows.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    now, path = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        new, new_path = staged(_step(_step(now, True), False), "links")
        unstage(links.sparkSession, path)
        now, path = new, new_path
        was, mark = mark, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == was or not mark[0]:
            break
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left") \
        .select("node", F.coalesce("component", "node").alias("component"))
