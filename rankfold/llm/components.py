"""Connected components of an undirected graph by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Each step is one partial (map-side) minimum per node and one join, so a hub that touches a
large share of all edges is combined before the shuffle; its edges are split by AQE's
skew handling in the join. Every step is written to the shared scratch folder, which keeps
the lineage short and lets a lost executor be replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``u`` and ``v`` of one orderable
    type); ``component`` is the smallest node of the component.

    Loops and repeated edges are ignored, edges with a null end are not edges, and a node
    that only has loops does not appear. No edges: an empty result."""
    star = written(edges.select("u", "v").filter("u != v").distinct(), name)

    def mark(df):
        r = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        return int(r[0]), int(r[1])

    before = mark(star)
    while before[0]:
        star = written(_small_star(_large_star(star)), name)
        after = mark(star)
        if after == before:
            break
        before = after
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
