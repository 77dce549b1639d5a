"""Connected components of links, by repeated contraction of written tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (bigint a, b); the root is the component's least node.

    In each round every node follows its least neighbour, links are carried to the nodes
    followed, and links within one node go. Node numbers should be hashes: on chains in
    random order the rounds grow with the logarithm of their length. Counts of rounds
    and links come to the driver, never nodes.
    """
    pairs = stage(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        "links",
    )
    roots = None
    while not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            pairs.select(F.col("b"), F.col("a"))
        )
        follow = stage(
            ends.groupBy("node").agg(F.least("node", F.min("other")).alias("to")), "follow"
        )
        if roots is None:
            roots = follow.select("node", F.col("to").alias("root"))
        else:
            known = follow.select(F.col("node").alias("root"), "to")
            roots = stage(
                roots.join(known, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
                "roots",
            )
        a = follow.select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = follow.select(F.col("node").alias("b"), F.col("to").alias("y"))
        pairs = stage(
            pairs.join(a, "a")
            .join(b, "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    # Roots are least in their component once more numbers than roots have met.
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    return roots.join(least, "root").select("node", F.col("least").alias("root"))
