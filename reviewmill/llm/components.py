"""Connected components by alternating large-star and small-star rounds, in DataFrames only.

After Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014. Every round is
two minima per node and two joins; the minima combine on the map side and the joins are plain
equality joins, so a hub with a third of all edges is split by adaptive execution. Rounds are
written to the shared folder, and only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.staging import Stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    turned = links.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return turned.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(edges: DataFrame, left: str, right: str, stage: Stage) -> DataFrame:
    """(node, component) for every node that has an edge to another one.

    ``component`` is the smallest node reachable. Edges may repeat and point either way; edges
    with a null end and loops say nothing. Without edges the result is empty.
    """
    a, b = F.col(left), F.col(right)
    start = edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    links = stage.put(start, "links")
    before, after = None, _state(links)
    while after[0] and after != before:
        large = stage.put(_large_star(links), "large_star")
        links = stage.put(_small_star(large), "small_star")
        before, after = after, _state(links)
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
