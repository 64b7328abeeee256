"""Connected components of a table of links, by rounds that contract the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.workspace import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """`node`, `root`: for each node of a link the smallest node that links reach.

    Each round draws an order of the nodes by hash. A node joins its first neighbour in
    that order, unless it comes first itself, and then the one its neighbour joined; links
    are rewritten to what their ends joined, and those within one node go. The links
    left shrink by a factor a round, so all rounds together read little more than the
    first. A link with a null end counts for nothing, a link from a node to itself names
    the node; no links give no rows. Rounds write to the shared folder.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    found = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().withColumn("root", F.col("node"))
    edges = materialize(_between(ends), "components-links")
    turn = 0
    while edges.limit(1).count():

        def order(column: str):
            return F.struct(F.xxhash64(F.col(column), F.lit(turn)).alias("h"), F.col(column).alias("at"))  # noqa: B023

        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        first = both.groupBy("node").agg(F.min(order("other")).alias("near"))
        hooks = first.select("node", F.least("near", order("node"))["at"].alias("hook"))
        then = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("into"))
        joined = materialize(hooks.join(then, "hook").select("node", "into"), "components-joined")
        found = found.join(joined.select(F.col("node").alias("root"), "into"), "root", "left").select(
            "node", F.coalesce("into", "root").alias("root")
        )
        edges = materialize(
            _between(
                edges.join(joined.select(F.col("node").alias("a"), F.col("into").alias("x")), "a")
                .join(joined.select(F.col("node").alias("b"), F.col("into").alias("y")), "b")
                .select(F.col("x").alias("a"), F.col("y").alias("b"))
            ),
            "components-links",
        )
        turn += 1
    found = materialize(found, "components")
    least = found.groupBy("root").agg(F.min("node").alias("least"))
    return found.join(least, "root").select("node", F.col("least").alias("root"))


def _between(edges: DataFrame) -> DataFrame:
    """Distinct links between two different nodes, the smaller one first."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
