"""Cluster tables: members, cross lists inside a cluster, two-hop compounds, first matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_per_key(rows: DataFrame, key: str, value: str, name: str, distinct: bool = False) -> DataFrame:
    """Sorted list of the values of each key."""
    c = F.collect_set(value) if distinct else F.collect_list(value)
    return rows.groupBy(key).agg(F.sort_array(c).alias(name))


def representatives_by_members(clusters: DataFrame, representatives: str = "representatives", members: str = "members") -> DataFrame:
    """One row per representative and member of a cluster, clusters numbered from 1 by ``cluster_no``."""
    return clusters.select((F.col("cluster_no") + 1).alias("cluster_number"), F.explode(representatives).alias("representative"), F.col(members).alias("__m")).select("cluster_number", "representative", F.explode("__m").alias("member"))


def valid_hits(clusters: DataFrame, valid: DataFrame) -> DataFrame:
    """``cluster_no, hits``: distinct valid entries of members and representative; clusters without any go."""
    ids = clusters.select("cluster_no", F.explode(F.array_union("members", F.array("representative"))).alias("id"))
    hits = ids.join(valid.select("id", F.explode("entries").alias("entry")), "id")
    return hits.groupBy("cluster_no").agg(F.sort_array(F.collect_set("entry")).alias("hits")).where(F.size("hits") > 0)


def two_hop(targets: DataFrame, assays: DataFrame, compounds: DataFrame) -> DataFrame:
    """Gene -> assays -> compounds: ``gene_id, compounds`` in assay order, repeats kept, an empty list where none."""
    joined = targets.select("gene_id").distinct().join(assays.select("gene_id", "aid"), "gene_id", "left").join(compounds.select("aid", "cid"), "aid", "left")
    lists = joined.groupBy("gene_id").agg(F.array_sort(F.collect_list(F.when(F.col("cid").isNotNull(), F.struct("aid", "cid")))).alias("p"))
    return lists.select("gene_id", F.transform("p", lambda s: s["cid"]).alias("compounds"))


def once_per_id(rows: DataFrame, key: str, cluster: str) -> DataFrame:
    """Rows of the lowest cluster of each id only."""
    least = rows.groupBy(key).agg(F.min(cluster).alias(cluster))
    return rows.join(least, [key, cluster], "left_semi")


def sharing_cluster(rows: DataFrame, item: str, keys: Sequence[str]) -> DataFrame:
    """``item, n_peers``: how many other items share its cluster, from the clusters' sizes, without pairing members."""
    sizes = rows.groupBy(*keys).agg(F.count_distinct(item).alias("n"))
    return rows.select(item, *keys).distinct().join(sizes, list(keys)).select(item, *keys, (F.col("n") - 1).alias("n_peers"))


def coverage(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row: distinct keys in all, and of those with a non-blank value in each column."""
    have = (F.count_distinct(F.when(F.trim(F.col(c).cast("string")) != "", F.col(key))).alias(f"with_{c}") for c in columns)
    return rows.agg(F.count_distinct(key).alias("n_keys"), *have)


def distinct_with_null(column: str, name: str):  # noqa: ANN201
    """Distinct values where NULL counts as one value."""
    return (F.count_distinct(column) + F.max(F.when(F.col(column).isNull(), 1).otherwise(0))).alias(name)


def ligands_of_cluster(rows: DataFrame, item: str, keys: Sequence[str], ligand: str) -> DataFrame:
    """``item, ligands``: for each item the sorted distinct ligands of all items of its cluster.

    A cluster's list is built once and met by its items in an equi-join, so its
    members are not paired with each other; items without a cluster keep theirs out.
    """
    known = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    lists = known.where(F.col(ligand).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_set(ligand)).alias("ligands"))
    return known.select(item, *keys).distinct().join(lists, list(keys)).select(item, "ligands")
