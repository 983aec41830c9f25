"""Ranks within groups without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut

#: Rows of (partition, group) offsets that may be broadcast.
BROADCAST_OFFSETS = 100_000


def rank_within(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """0-based rank of each row in its group, over a range partitioning of (group, order).

    A group may span many partitions: each row has its place in its sorted
    partition, and the offsets of a group's partitions are added from one small
    table of counts.  ``order`` must be unique in a group.  The sorted rows are
    checkpointed, so that places stay as they are when a task is repeated.
    """
    at = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    at = cut(at.withColumn("__at", F.monotonically_increasing_id()))
    at = at.withColumn("__part", F.shiftright("__at", 33)).withColumn("__place", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    parts = at.groupBy("__part", *groups).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    small = parts.count() <= BROADCAST_OFFSETS
    same = F.lit(True)
    right = parts.select(F.col("__part").alias("__p"), *(F.col(g).alias(f"__g_{g}") for g in groups), "__first", "__before")
    same = F.col("__part") == F.col("__p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    out = at.join(F.broadcast(right) if small else right, same)
    return out.withColumn(name, F.col("__place") - F.col("__first") + F.col("__before")).select(*df.columns, name)
