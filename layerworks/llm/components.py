"""Connected components of a graph by alternating stars, on joins and map-side merged minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for every node of an edge (u, v).

    In turn each node ties its larger neighbours, then its smaller ones, to the smallest node it
    knows, until nothing changes; that takes about the logarithm of the longest path in rounds.
    Each round is written, so a lost executor costs one round at most.  Loops and repeated edges
    do no harm; nulls are left out; no edges give no rows.
    """
    nodes = edges.select("u").union(edges.select("v")).where("u is not null").distinct()
    now = stored(edges.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    nodes = stored(nodes, "components-nodes")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stored(large, "components-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = stored(small.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components-small")
        before, state = state, _state(now)
        if state == before:
            break
    return nodes.join(now.groupBy("u").agg(F.min("v").alias("label")), "u", "left").select(F.col("u").alias("node"), F.coalesce("label", "u").alias("label"))
