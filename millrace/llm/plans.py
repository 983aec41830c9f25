"""Queries of the problems tagged llm over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.nulls import blank_to_null
from millrace.llm import bytebpe, packing, similar, splits, stuffing, topn
from millrace.session import spread, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.tied_proteins(splits.pose_components(table(spark, sf_dir, "poses"), table(spark, sf_dir, "cluster_labels")))


def p2_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every pose."""
    return splits.assign_splits(table(spark, sf_dir, "poses"), table(spark, sf_dir, "cluster_labels"))


def _structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counting row of each compound: that of the greatest cache part."""
    rows = table(spark, sf_dir, "compounds").where("cid IS NOT NULL")
    top = F.max(F.struct("cache_part", blank_to_null("SMILES").alias("s"))).alias("m")
    return rows.groupBy("cid").agg(top).select("cid", F.col("m.s").alias("SMILES"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.SmilesClusters(_structures(spark, sf_dir)).pairs()


def p5_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, size and most typical members of every cluster."""
    return similar.SmilesClusters(_structures(spark, sf_dir)).summary()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    poses = table(spark, sf_dir, "poses").select("pose_id", "protein_id", "ligand_id", "CNNscore", "pose_rank")
    return topn.top_poses(spread(poses, "pose_id"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.token_ids(_texts(spark, sf_dir))


#: Tokens of a container.
CAPACITY = 2048


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every document or piece of one."""
    sizes = bytebpe.token_counts(_texts(spark, sf_dir))
    return packing.pack_items(sizes, "doc_id", "n_tokens", CAPACITY)


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used, the least number that is possible by the sum of sizes, and the used part of the room."""
    return packing.fill_report(p9_packed(spark, sf_dir), CAPACITY)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffing.stuffed_pages(_texts(spark, sf_dir))


QUERIES = {
    "p2_found": p2_found,
    "p2_splits": p2_splits,
    "p5_found": p5_found,
    "p5_clusters": p5_clusters,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_packed": p9_packed,
    "p9_fill": p9_fill,
    "p10_found": p10_found,
}

ORACLE = {
    "p7_found": """
        SELECT pose_id, CAST(rn - 1 AS INTEGER) AS pair_rank FROM (
          SELECT pose_id, row_number() OVER (PARTITION BY upper(trim(protein_id)), upper(trim(ligand_id)) ORDER BY CNNscore DESC, pose_rank ASC NULLS LAST, pose_id ASC) AS rn
          FROM poses WHERE CNNscore IS NOT NULL AND CAST(CNNscore AS VARCHAR) <> 'nan' AND trim(protein_id) <> '' AND trim(ligand_id) <> '') WHERE rn <= 5""",
    "p2_found": """
        WITH RECURSIVE p AS (SELECT DISTINCT upper(trim(protein_id)) AS protein, upper(trim(ligand_id)) AS ligand FROM poses WHERE trim(protein_id) <> '' AND trim(ligand_id) <> ''),
        c AS (SELECT DISTINCT upper(trim(item_id)) AS ligand, cluster_id FROM cluster_labels WHERE cluster_id IS NOT NULL AND cluster_id <> -1),
        g AS (SELECT DISTINCT protein, coalesce('c' || c.cluster_id, 'l' || p.ligand) AS tie FROM p LEFT JOIN c USING (ligand)),
        e AS (SELECT DISTINCT a.protein AS u, b.protein AS v FROM g a JOIN g b USING (tie)),
        r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
        SELECT anchor_protein, protein_id FROM (SELECT u AS protein_id, min(v) AS anchor_protein FROM r GROUP BY u) WHERE protein_id <> anchor_protein""",
}
