"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.llm.common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``.

    ``component`` is the smallest node reachable, the node itself included.
    Links are undirected; repeated links and self links do no harm and nulls
    are ignored.  Large-star and small-star steps alternate until the link
    table no longer changes, which takes about log2(longest path) rounds.
    Each step is a partial-aggregated minimum and an equi-join, so a node with
    very many links is split by the skew join and no neighbourhood is gathered
    in one task.  Every round's table is written to the shared folder.  An
    empty link table gives an empty result.
    """
    e = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")) \
             .where("u is not null and v is not null")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stored(e, "links")
    before = None
    for _ in range(max_rounds):
        both = e.where("u != v")
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(near.where("m = u").select("u", F.col("m").alias("v"))) \
                     .where("u >= v").distinct()
        low = large.where("u != v")
        near = _smallest(low)
        small = low.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
                   .unionByName(near.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        e = stored(small, "links")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
