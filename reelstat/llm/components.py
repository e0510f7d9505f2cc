"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Number and hash sums of distinct links: equal only if the links are, but for a chance of 2^-100."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def component_ids(links: DataFrame) -> DataFrame:
    """(id, component) for every end of the links (a, b); component is the smallest reachable id.

    Each round hangs every larger neighbour of a node on the node's smallest
    neighbour, then every node with its smaller neighbours on the smallest;
    rounds grow with the logarithm of the longest path. Each round's links go
    to the shared folder, so that lineage stays short and a lost executor
    costs one round.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(),
                    "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.min("hi").alias("m")).select("lo", F.least("lo", "m").alias("m"))
        large = (both.where("hi > lo").join(least, "lo").select(F.col("m").alias("lo"), "hi")).where("lo <> hi").distinct()
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(below, "hi").select(F.explode(F.array(F.struct(F.col("m").alias("lo"), "hi"),
                                                                    F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e"))
                 .select("e.lo", "e.hi").where("lo <> hi").distinct())
        new = written(small, "links")
        before, state = state, _state(new)
        if state == before:
            return new.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
                new.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
        edges = new
