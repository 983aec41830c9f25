"""Ranking: top N per group, composite scores, orders with NaN and NULL last."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import nan_to_null

#: Which direction of each docking score is best.
SCORE_DIRECTIONS = {
    "CNNscore": "descending",
    "CNNaffinity": "descending",
    "CNN_VS": "descending",
    "Vina_affinity": "ascending",
    "Energy": "ascending",
    "CNNaffinity_variance": "ascending",
}


def best_direction(score: str) -> str:
    """'ascending' or 'descending'; an unknown score raises."""
    if score not in SCORE_DIRECTIONS:
        raise ValueError(f"unknown score {score!r}; known: {sorted(SCORE_DIRECTIONS)}")
    return SCORE_DIRECTIONS[score]


def best_order(score: str | Column, ascending: bool) -> Column:
    """Sort key with NaN and NULL last in either direction."""
    value = nan_to_null(score)
    return value.asc_nulls_last() if ascending else value.desc_nulls_last()


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    score: str,
    n: int = 5,
    ascending: bool | None = None,
    ties: Sequence[str] = (),
    rank_col: str | None = None,
) -> DataFrame:
    """The ``n`` best rows of each group.

    ``rn <= n`` is filtered before the rank is made 0-based, so that Spark puts
    a group limit below the shuffle and a hot group sends few rows per task.
    Rows with a NULL or NaN score come last; an existing rank column raises.
    """
    if rank_col and rank_col in df.columns:
        raise ValueError(f"column {rank_col!r} exists already")
    if ascending is None:
        ascending = best_direction(score) == "ascending"
    order = [best_order(F.col(score), ascending), *(F.col(t).asc_nulls_last() for t in ties)]
    rn = "__rn"
    out = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rn) <= n)
    if rank_col:
        out = out.withColumn(rank_col, (F.col(rn) - 1).cast("int"))
    return out.drop(rn)


def composite_score(df: DataFrame, weights: Mapping[str, float], ascending: Mapping[str, bool] | None = None, name: str = "composite") -> DataFrame:
    """Weighted sum of min-max scaled scores; weights are normalised to 1.

    A score whose best direction is ascending is flipped after scaling; a
    constant score scales to 0 before that.  NaN counts as NULL.  The extremes
    are one row, so broadcasting them is bounded.
    """
    if not weights:
        raise ValueError("no weights")
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("the weights must have a positive sum")
    extremes = df.agg(*(f(nan_to_null(c)).alias(f"__{p}_{c}") for c in weights for p, f in (("lo", F.min), ("hi", F.max))))
    score: Column = F.lit(0.0)
    for c, w in weights.items():
        up = ascending[c] if ascending and c in ascending else best_direction(c) == "ascending"
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        scaled = F.when(hi > lo, (nan_to_null(c) - lo) / (hi - lo)).when(nan_to_null(c).isNotNull(), F.lit(0.0))
        score = score + F.lit(w / total) * ((F.lit(1.0) - scaled) if up else scaled)
    return df.crossJoin(F.broadcast(extremes)).withColumn(name, score).drop(*extremes.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (drop duplicates that keeps the first)."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def last_wins(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """Upsert by key: one row per key, that of the greatest order.

    ``max_by`` combines on the map side, so a hot key never meets in one task
    (a window would sort all its rows in one).  Equal orders: any of them, so
    pass a complete order for a defined result.
    """
    rest = [c for c in df.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order)).alias("__top")
    return df.groupBy(*keys).agg(top).select(*keys, *(F.col(f"__top.`{c}`").alias(c) for c in rest))
