"""Connected components of a graph that is too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import discard, stage


def _summary(edges: DataFrame) -> tuple:
    """What tells whether a round has changed anything."""
    key = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(key)).first())


def components(edges: DataFrame) -> DataFrame:
    """``u`` and ``root`` for each node of ``edges`` (``u``, ``v``): the smallest node that is
    reachable, for all nodes that are not roots themselves: a staged frame.

    Rounds of large stars and small stars (Kiveris et al., 2014) turn each component into one
    star; their number grows with the logarithm of the longest path. A round is two aggregates
    and two joins by node; its edges are written, so that a lost executor repeats one round. A
    hub is one row of the aggregate, and the join may split its edges.
    """
    own = F.least("u", "v"), F.greatest("u", "v")
    edges = edges.where("u <> v").select(own[0].alias("v"), own[1].alias("u")).distinct()
    edges = stage(edges, "edges")
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        ).distinct()
        # Each edge of the large star leads to a smaller node, so the small star's centre is known.
        small = large.groupBy("u").agg(F.min("v").alias("root"))
        joined = large.join(small, "u")
        starred = (
            joined.select("u", F.col("root").alias("v"))
            .unionByName(joined.where("v <> root").select(F.col("v").alias("u"), F.col("root").alias("v")))
            .distinct()
        )
        last, edges = edges, stage(starred, "edges")
        discard(last)
        after = _summary(edges)
        if after == before:
            break
        before = after
    root = edges.select("u", F.col("v").alias("root"))
    root.staged_path = edges.staged_path
    return root
