"""Connected components of a link table, as Spark joins between tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import stage_rows
from harvestlake.operators.joins import join_to_one


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the least node that links reach) for every linked node, as a staged table.

    ``edges`` has BIGINT columns ``u`` and ``v`` in any order, repeats and loops allowed; it is read
    more than once. Large-star and small-star rounds alternate until every node has no neighbour but
    its least one, or only greater ones. The number of rounds grows with the logarithm of the nodes, links
    never become more, and a node with very many links is only ever aggregated or is the
    split side of a join. What a join adds to the links is staged, a row per node, so that Spark knows
    its size: while it is small, the links are not exchanged for it. The rows of a round go to as many
    tasks as there are links for.
    """
    links = edges.where("u <> v").select("u", "v")
    most = 2 * edges.count()
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most"))
        around = stage_rows(around, most, "around")
        if around.where("least < u and least < most").isEmpty():
            return around.select(F.col("u").alias("node"), F.least("u", "least").alias("component"))
        # Large star: the greater neighbours of each node are linked with the least node around it.
        least = around.select("u", F.least("u", "least").alias("least"))
        large = join_to_one(both, least, ["u"], "inner").where("v > u")
        large = stage_rows(large.select(F.col("v").alias("u"), F.col("least").alias("v")), most, "large-star")
        # Small star: each node and its smaller neighbours are linked with the least of these.
        least = stage_rows(large.groupBy("u").agg(F.min("v").alias("least")), most, "least")
        small = join_to_one(large, least, ["u"], "inner").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(least.select("u", F.col("least").alias("v")))
        links = stage_rows(small.where("u <> v").distinct(), most, "links")
