"""Connected components of a link table by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """Component of each end of ``edges`` (src long, dst long): id, component, the smallest id reachable.

    Ids are first scrambled by xxhash64, which maps longs one to one, so that the order of nodes says nothing
    about where they are. Each round every node takes its smallest neighbour (or itself) as
    parent, parents are followed twice, and links between different parents make the smaller graph
    of the next round; in a scrambled order a logarithmic number of rounds is expected, for chains
    too. Only aggregations and joins are used, each round's tables are cut, and nodes without links
    do not appear. Ends that are null are left out.
    """
    ends = edges.filter("src <> dst").select(F.xxhash64("src").alias("u"), F.xxhash64("dst").alias("v"), "src", "dst")
    ends = cut(ends.distinct())
    links = cut(ends.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("parent")))
        for _ in range(2):
            above = parent.select(F.col("id").alias("_id"), F.col("parent").alias("_above"))
            parent = parent.join(above, F.col("parent") == F.col("_id")).select("id", F.col("_above").alias("parent"))
        parent = cut(parent)
        rounds.append(parent)
        of_a = parent.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        of_b = parent.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        raised = links.join(of_a, "a").join(of_b, "b").filter("pa <> pb")
        links = cut(raised.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if not rounds:
        return edges.sparkSession.createDataFrame([], "id long, component long")
    found = rounds[0]
    for later in rounds[1:]:
        above = later.select(F.col("id").alias("_id"), F.col("parent").alias("_above"))
        found = found.join(above, F.col("parent") == F.col("_id"), "left").select("id", F.coalesce("_above", "parent").alias("parent"))
    nodes = ends.select(F.col("u").alias("_id"), F.col("src").alias("node")).unionByName(ends.select(F.col("v").alias("_id"), F.col("dst").alias("node"))).distinct()
    rooted = cut(nodes.join(found, F.col("_id") == F.col("id")).select("node", "parent"))
    smallest = rooted.groupBy("parent").agg(F.min("node").alias("component"))
    return cut(rooted.join(smallest, "parent").select(F.col("node").alias("id"), "component"))
