"""Connected components of a graph given by its links."""

from pyspark.sql import DataFrame, functions as F

from playlake.operators.joins import skew_join
from playlake.storage import materialize


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    return skew_join(links, least, {"u": "of"}, "inner").select("u", "v", "least")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (long columns u, v), where root is the least node that can be reached.

    Large-star and small-star steps in turn: each hangs the neighbours of a node below the least of them. Neighbourhoods are
    only ever reduced to their minimum, so a node with very many links is no burden. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(seen) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        state = tuple(seen)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("least"))
        large = _with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("least"))
        hung = _with_least(large, least)
        small = hung.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.union(least.select("of", "least")).distinct()
        edges = materialize(small, "links")
