"""Queries over docked poses: keyword filters, counts, score ranges, best poses, batches of proteins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.nulls import nan_to_null
from millrace.operators.ranking import SCORE_DIRECTIONS, best_direction, composite_score, top_n

LEVELS = {"ligand": ("ligand_id",), "protomer": ("ligand_id", "UniqueID"), "conformer": ("ligand_id", "UniqueID", "conformer_idx")}


def keyword_filter(df: DataFrame, **bounds: object) -> DataFrame:
    """``x_min`` and ``x_max`` bound a column, any other keyword is an equality; none keeps all.  NaN passes no bound."""
    tests: list[Column] = []
    for key, value in bounds.items():
        name, _, kind = key.rpartition("_")
        if kind in ("min", "max") and name in df.columns:
            c = nan_to_null(name) if dict(df.dtypes)[name] in ("double", "float") else F.col(name)
            tests.append(c >= value if kind == "min" else c <= value)
        elif key in df.columns:
            tests.append(F.col(key) == value)
        else:
            raise ValueError(f"no column for {key!r}")
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def level_keys(per: str, within: Sequence[str] = ()) -> list[str]:
    if per not in LEVELS:
        raise ValueError(f"per {per!r} is none of {sorted(LEVELS)}")
    return [*within, *LEVELS[per]]


def top_poses(df: DataFrame, by: str | Mapping[str, float] = "CNNscore", n: int = 5, per: str = "conformer", within: Sequence[str] = (), ascending: bool | None = None, ties: Sequence[str] = ("block_start",)) -> DataFrame:
    """The best poses of each ligand, protomer or conformer, by one score or a weighted composite."""
    keys = level_keys(per, within)
    if isinstance(by, str):
        return top_n(df, keys, by, n, best_direction(by) == "ascending" if ascending is None else ascending, ties)
    return top_n(composite_score(df, by), keys, "composite", n, False, ties)


def counts(df: DataFrame) -> DataFrame:
    """One row: poses, distinct ligands, protomers and conformers (keys as structs, so that no text collides)."""
    return df.agg(F.count("*").alias("n_poses"), *(F.count_distinct(F.struct(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys))).alias(f"n_{per}s") for per, keys in LEVELS.items()))


def poses_per(df: DataFrame, per: str = "conformer", within: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*level_keys(per, within)).agg(F.count("*").alias("n_poses"))


def protomer_counts(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*within, "ligand_id", "UniqueID", "SMILES").agg(F.count("*").alias("n_poses"), F.count_distinct("conformer_idx").alias("n_conformers"))


def score_ranges(df: DataFrame, keys: Sequence[str] = (), scores: Sequence[str] = tuple(SCORE_DIRECTIONS)) -> DataFrame:
    """Least and greatest of each score, NaN ignored."""
    return df.groupBy(*keys).agg(*(f(nan_to_null(c)).alias(f"{c}_{p}") for c in scores for p, f in (("min", F.min), ("max", F.max))))


def best_rows(df: DataFrame, keys: Sequence[str], score: str = "CNNscore", tie: str = "block_start", take: Sequence[str] = ()) -> DataFrame:
    """The row of greatest score per group by one mergeable aggregate; ties: the smallest ``tie``."""
    rest = [c for c in (take or df.columns) if c not in keys]
    known = df.where(nan_to_null(score).isNotNull())
    best = F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(tie))).alias("__b")
    return known.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__b.`{c}`").alias(c) for c in rest))


def summary_text(df: DataFrame, per: str = "global", name: str = "") -> str:
    """A report of one file's poses; its groups come to the driver partition by partition."""
    keys = [] if per == "global" else level_keys(per)
    if per not in ("global", "ligand", "protomer"):
        raise ValueError("per is global, ligand or protomer")
    lines = [f"File: {name}"] if name else []
    n = counts(df).first().asDict()
    lines += [f"{k}: {v}" for k, v in n.items()]
    for row in score_ranges(df, keys).orderBy(*keys).toLocalIterator():
        r = row.asDict()
        lines.append(", ".join(f"{k}={r[k]}" for k in keys) or "all poses")
        lines += [f"  {c}: {r[f'{c}_min']:.4f} to {r[f'{c}_max']:.4f}" for c in SCORE_DIRECTIONS if r[f"{c}_min"] is not None]
    return "\n".join(lines)


def protein_batches(df: DataFrame, per_batch: int = 200, key: str = "protein_id") -> DataFrame:
    """``key, batch`` and the batch file name: sorted proteins in groups of ``per_batch``."""
    from millrace.functions.ranks import rank_within

    ids = rank_within(df.select(F.lit(0).alias("g"), key).where(F.col(key).isNotNull()).distinct(), ["g"], [key])
    ids = ids.select(key, F.expr(f"rank div {int(per_batch)}").alias("batch"))
    names = ids.groupBy("batch").agg(F.concat(F.lit("bt_"), F.max("batch"), F.lit("_"), F.min(key), F.lit("_"), F.max(key), F.lit(".parquet")).alias("file_name"))
    return ids.join(names, "batch").select(key, "batch", "file_name")


def write_batches(df: DataFrame, path: str, per_batch: int = 200, rows_per_file: int = 0) -> None:
    """One folder per batch; a protein is in one batch only."""
    batched = df.join(protein_batches(df, per_batch).select("protein_id", "batch"), "protein_id")
    w = batched.repartition("batch").write.mode("overwrite").partitionBy("batch")
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).parquet(path)


def write_by_protein(df: DataFrame, path: str) -> None:
    """One folder per protein; only the folders of the proteins at hand are replaced."""
    df.repartition("protein_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("protein_id").parquet(path)


def new_proteins(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of proteins that the dataset doesn't hold yet."""
    return df.join(existing.select("protein_id").distinct(), "protein_id", "left_anti")


#: Rows up to which a slice is taken by keeping the least rows of every task; a deeper one ranks all rows by range.
SLICED_ROWS = 1_000_000


def row_slice(df: DataFrame, order: Sequence[str], start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``[start, end)`` of the order (unique), clamped at both ends."""
    start = max(0, start)
    if end is not None and end <= SLICED_ROWS:
        return df.orderBy(*order).limit(max(0, end)).offset(start)
    from millrace.functions.ranks import rank_within

    ranked = rank_within(df.withColumn("__g", F.lit(0)), ["__g"], list(order), "__rank")
    test = F.col("__rank") >= start
    return ranked.where(test & (F.col("__rank") < end) if end is not None else test).drop("__rank", "__g")


def number_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def take(df: DataFrame, order: Sequence[str], places: Sequence[int]) -> DataFrame:
    """The rows at the given places (from 0) of the order (unique); places beyond the end give none."""
    from millrace.functions.ranks import rank_within

    ranked = rank_within(df.withColumn("__g", F.lit(0)), ["__g"], list(order), "__rank")
    return ranked.where(F.col("__rank").isin([int(p) for p in places])).drop("__rank", "__g")


def mode_summary(modes: DataFrame, keys: Sequence[str] = ("ligand_id", "UniqueID")) -> DataFrame:
    """``num_modes, n_groups, example``: how many groups have each number of modes, with the first of them."""
    return modes.groupBy("num_modes").agg(F.count("*").alias("n_groups"), F.min(F.struct(*keys)).alias("example"))
