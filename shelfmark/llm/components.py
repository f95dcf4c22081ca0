"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored


def _least(pairs: DataFrame) -> DataFrame:
    """Each ``u, v`` with ``m``, the smallest of u and its v's. A hub is pre-aggregated and its join can be split."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u")).toDF("u", "v")
    large = _least(both).where("v > u").select("v", "m").distinct().toDF("u", "v").where("u <> v")
    near = _least(large)
    small = near.select("v", "m").union(near.select("u", "m")).toDF("u", "v")
    return small.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; root is its component's smallest node.

    Alternating large and small stars: in each round every node is pointed to the smallest
    neighbour it knows, until nothing changes; the number of rounds grows with the logarithm of a
    component's size. Every round is written to the shared folder, which cuts the lineage.
    Null ends and loops are passed over.
    """
    edge = links.toDF("a", "b").where("a <> b")
    now = stored(edge.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    mark = _mark(now)
    while True:
        after = stored(_round(now), "components")
        before, mark = mark, _mark(after)
        now = after
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )


def _mark(links: DataFrame) -> tuple:
    """Equal for two sets of links only if they are the same (but for a hash collision)."""
    part = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(part.cast("decimal(38,0)")), F.bit_xor(part)).first())
