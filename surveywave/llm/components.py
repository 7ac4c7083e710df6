"""Connected components of a distributed list of edges.

Edges point from the larger node to the smaller.  A round first links all lower
neighbours of a node, and the node, to the least of them (small star), then
moves every edge one step on to its lower end's own least neighbour (pointer
jumping), until every node has one edge and it leads to a node without any.
Both steps keep what is connected connected, and edges only ever get lower ends.
After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).

Grouping is by the upper end, which has few edges; the hub of a hot group is a
lower end, met by a join whose hot side AQE may split.  Only two counts a round
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, component) for every node with an edge; component is the least
    node reachable.  Loops and repeated edges are fine; no edges give no rows.
    """
    cur = scratch.table(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where("u <> v").distinct(), "edges")
    while True:
        up = scratch.table(cur.groupBy("u").agg(F.min("v").alias("p"), F.count("*").alias("n")), "parents")
        jumped = cur.join(up.select(F.col("u").alias("v"), "p"), "v", "left")
        # many edges of a node may now lead to one place: combined before they meet
        jumped = jumped.groupBy("u", F.coalesce("p", "v").alias("v")).agg(F.max(F.col("p").isNotNull()).alias("moved"))
        jumped = scratch.table(jumped, "jumped")
        if up.where("n > 1").isEmpty() and jumped.where("moved").isEmpty():
            break
        least = F.min("v").over(Window.partitionBy("u"))
        star = jumped.select("u", "v", least.alias("m"))
        star = star.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        cur = scratch.table(star.select("e.*").where("u <> v").distinct(), "star")
    found = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
