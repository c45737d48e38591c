"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import reshuffled, stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v), comp being its least node.

    Large-star and small-star steps: every neighbour of a node is linked to the
    least node around it, until nothing moves; the number of rounds grows with
    the logarithm of the longest path.  Each round is stored.  Minima are taken
    before the shuffle and a hub's edges are an ordinary skewed join side, so no
    node's neighbourhood is ever gathered in one place.
    """
    e = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .distinct(), name)
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(reshuffled(least, "u"), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(reshuffled(least, "u"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
