"""Connected components over an edge table, without bringing edges or labels to the driver."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import checkpoint, reclaim

#: Edges of one partition: few edges in many partitions would leave a folder of tiny files each round.
PART_EDGES = 100_000


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; ``root`` is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) with minima as aggregates, so a node of any
    degree is never gathered. Loops, null ends and repeated edges are ignored; no edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = checkpoint(e)
    mark = _mark(e)
    while mark[0]:
        reclaim(e.sparkSession)
        parts = math.ceil(mark[0] / PART_EDGES)
        e = e.coalesce(parts)
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("lo")).select("x", F.least("x", "lo").alias("lo"))
        e2 = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("lo").alias("v")).distinct()
        least = e2.groupBy("u").agg(F.min("v").alias("lo"))
        e2 = least.select("u", F.col("lo").alias("v")).union(e2.join(least, "u").where("v != lo").select(F.col("v").alias("u"), F.col("lo").alias("v"))).distinct()
        e = checkpoint(e2.coalesce(parts))
        if (now := _mark(e)) == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
