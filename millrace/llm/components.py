"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

#: A key with more than this part of the rows is hot; there are at most HOT_PARTS such keys.
HOT_PARTS = 64
#: Below this many rows no key is worth splitting.
HOT_ROWS = 50_000


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right``, which holds each key once; hot keys of ``left`` stay spread.

    Keys with more than 1/64 of the rows are at most 64, so their rows of
    ``right`` are broadcast; all others are joined by shuffle.
    """
    total = left.count()
    if total <= HOT_ROWS:
        return left.join(right, key, how)
    counts = left.groupBy(key).count()
    hot = [r[0] for r in counts.where(F.col("count") > total // HOT_PARTS).select(key).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how).unionByName(left.where(~is_hot).join(right.where(~is_hot), key, how))


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component`` of every node with an edge; the component is its smallest node.

    Alternating large-star and small-star steps; every step ends in a reliable
    checkpoint and stops when a round changes nothing.  Each step takes minima
    (combined on the map side) and one join; hubs are split by ``join_unique``.
    Loops, repeated edges and NULL ends are harmless; an empty table gives an
    empty table.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _fingerprint(e)
    while before[0]:
        # large star: every larger neighbour goes to the smallest in the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        e = cut(join_unique(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: the node and its smaller neighbours go to the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        near = join_unique(e, least, "u")
        e = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = cut(e.distinct())
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def tagged(kind: str, c: Column) -> Column:
    """A node name that no other kind of node has."""
    return F.concat(F.lit(f"{kind}|"), c.cast("string"))
