"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import write_shared


def _settled(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
        .where("a < b").distinct()


def _rounds(edges: DataFrame) -> DataFrame:
    """Large star, then small star. Each node's edges are reduced to their
    minimum with map-side partials; the join back is split by AQE for hubs."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), F.col("b"))
    large = _settled(large)
    # small star: a node's lesser neighbours and the node hang on the least of them
    least = large.groupBy("b").agg(F.min("a").alias("m"))
    small = large.join(least, "b")
    return _settled(small.select(F.col("m").alias("a"), F.col("a").alias("b"))
                    .union(least.select(F.col("m").alias("a"), F.col("b"))))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges`` (columns ``a, b``, long):
    the component is its least node. Each round is written to the shared
    folder; rounds end when the edges, by count and hash, stay as they are."""
    now = write_shared(_settled(edges), "edges")
    state = None
    while True:
        got = now.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if got["n"] == 0 or (got["n"], got["h"]) == state:
            break
        state = (got["n"], got["h"])
        now = write_shared(_rounds(now), "edges")
    # every edge now goes from a component's least node to one of its others
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
