"""Tanimoto edges of bit sets and Butina clusters."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut


#: Bit sets with all bits below this are compared as 64-bit words.
DENSE_BITS = 8192


def _words(bits: str):  # noqa: ANN202
    """Words of 64 bits; the array ends with the highest bit's word."""
    count = F.expr(f"cast(array_max({bits}) div 64 as int)")
    return F.transform(F.sequence(F.lit(0), count), lambda w: F.aggregate(F.filter(bits, lambda b: F.floor(b / 64) == w), F.lit(0).cast("bigint"), lambda s, b: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), (b % 64).cast("int")))))


def _shared_words(a: str, b: str):  # noqa: ANN202
    both = F.zip_with(a, b, lambda x, y: F.bit_count(F.coalesce(x.bitwiseAND(y), F.lit(0).cast("bigint"))))
    return F.aggregate(both, F.lit(0), lambda s, n: s + n)


def tanimoto_edges(items: DataFrame, floor: float, item: str = "item", bits: str = "bits", group: str | None = None) -> DataFrame:
    """``i, j, sim`` (j < i) of all pairs with similarity of at least ``floor``; with ``group``, of pairs within a group.

    No pair is made that can't reach the floor: by prefix filtering two sets
    share one of their rarest ``n - ceil(floor * n) + 1`` bits, which is an
    equi-join on single bits; sizes must agree as well.  Empty sets have no
    edges.  A floor of 0 would mean all pairs and is refused.  Items are unique
    over all groups.
    """
    if not 0 < floor <= 1:
        raise ValueError("floor must lie in (0, 1]")
    own = [] if group is None else [F.col(group).alias("group")]
    at = ["group", "bit"] if own else ["bit"]
    rows = items.select(F.col(item).alias("id"), *own, F.array_distinct(bits).alias("bits")).where(F.size("bits") > 0)
    freq = rows.select(*at[:-1], F.explode("bits").alias("bit")).groupBy(*at).count()
    n = F.size("bits")
    ranked = rows.withColumn("n", n).select("id", *at[:-1], "n", F.explode("bits").alias("bit")).join(freq, at)
    place = F.row_number().over(Window.partitionBy("id").orderBy("count", "bit"))
    keep = F.col("n") - F.ceil(F.lit(floor) * F.col("n") - 1e-9) + 1
    prefix = cut(ranked.withColumn("p", place).where(F.col("p") <= keep).select("id", "n", *at))
    a, b = (prefix.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), *at) for x in ("i", "j"))
    small, large = F.least("ni", "nj"), F.greatest("ni", "nj")
    pairs = a.join(b, at).where("j < i").where(small >= F.lit(floor) * large - 1e-9).select("i", "j").distinct()
    top = rows.agg(F.max(F.array_max("bits"))).first()[0]
    dense = top is not None and top < DENSE_BITS
    held = _words("bits") if dense else F.col("bits")
    x, y = (rows.select(F.col("id").alias(k), held.alias(f"b{k}"), F.size("bits").alias(f"s{k}")) for k in ("i", "j"))
    both = _shared_words("bi", "bj") if dense else F.size(F.array_intersect("bi", "bj"))
    sim = F.col("both") / (F.col("si") + F.col("sj") - F.col("both"))
    out = pairs.join(x, "i").join(y, "j").select("i", "j", "si", "sj", both.alias("both"))
    return out.select("i", "j", sim.alias("sim")).where(1.0 - F.col("sim") <= 1.0 - floor)


def butina(items: DataFrame, edges: DataFrame, start: int = 0, item: str = "item") -> DataFrame:
    """``item, cluster_id, representative``: Butina clusters over edges that passed the cutoff.

    Priority is (number of neighbours, item), descending.  The sequential pick
    is the lexicographically first maximal independent set, so each round
    decides at once every item whose undecided neighbours all have lower
    priority; members join their neighbour centroid of highest priority.
    """
    edges = cut(edges.select("i", "j"))
    both = edges.select(F.col("i").alias("a"), F.col("j").alias("b")).unionByName(edges.select(F.col("j").alias("a"), F.col("i").alias("b")))
    both = cut(both.distinct())
    degree = both.groupBy("a").agg(F.count("*").alias("d"))
    nodes = cut(items.select(F.col(item).alias("a")).distinct().join(degree, "a", "left").fillna(0, ["d"]).withColumn("prio", F.struct("d", "a")))
    links = cut(both.join(nodes.select("a", F.col("prio").alias("pa")), "a").join(nodes.select(F.col("a").alias("b"), F.col("prio").alias("pb")), "b"))
    open_, centroids = nodes.select("a", "prio"), []
    while True:
        open_ = cut(open_)
        if not open_.take(1):
            break
        alive = links.join(open_.select("a"), "a", "left_semi").join(open_.select(F.col("a").alias("b")), "b", "left_semi")
        beaten = alive.where("pb > pa").select("a").distinct()
        picked = cut(open_.join(beaten, "a", "left_anti"))
        centroids.append(picked)
        gone = alive.join(picked.select(F.col("a").alias("b")), "b", "left_semi").select("a").distinct()
        open_ = open_.join(picked.select("a"), "a", "left_anti").join(gone, "a", "left_anti")
    if not centroids:
        return nodes.select(F.col("a").alias("item"), F.lit(0).cast("bigint").alias("cluster_id"), F.col("a").alias("representative"))
    centers = centroids[0]
    for part in centroids[1:]:
        centers = centers.unionByName(part)
    # ids in order of picking: range-partitioned rank, so that no task sorts all centroids
    from millrace.functions.ranks import rank_within

    order = centers.select(F.lit(0).alias("g"), (-F.col("prio.d")).alias("nd"), F.col("a"), F.col("prio"))
    numbered = rank_within(order.withColumn("na", -F.col("a").cast("bigint")), ["g"], ["nd", "na"]).select("a", "prio", (F.col("rank") + start).alias("cluster_id"))
    numbered = cut(numbered)
    own = numbered.select(F.col("a").alias("item"), "cluster_id", F.col("a").alias("representative"))
    member = links.join(numbered.select(F.col("a").alias("b"), "cluster_id", F.col("prio").alias("pc")), "b").join(numbered.select("a"), "a", "left_anti")
    member = member.groupBy("a").agg(F.max_by(F.struct("cluster_id", F.col("b").alias("representative")), "pc").alias("c"))
    return own.unionByName(member.select(F.col("a").alias("item"), "c.cluster_id", "c.representative"))


def butina_in_memory(sims: dict[tuple[int, int], float], n: int, cutoff: float) -> list[list[int]]:
    """Butina for one small group: clusters with their centroid first, in order of picking."""
    near: list[set[int]] = [set() for _ in range(n)]
    for (i, j), s in sims.items():
        if 1.0 - s <= 1.0 - cutoff:
            near[i].add(j)
            near[j].add(i)
    seen: set[int] = set()
    out = []
    for i in sorted(range(n), key=lambda k: (len(near[k]), k), reverse=True):
        if i not in seen:
            members = [i, *sorted(near[i] - seen)]
            seen.update(members)
            out.append(members)
    return out


def cluster_groups(rows: DataFrame, group: str, item: str, bits: str, cutoff: float = 0.7, largest: int = 2000) -> DataFrame:
    """``group, item, cluster_id`` (from 1 in each group): every group clustered on its own.

    Small groups are clustered inside one task; groups of more than ``largest``
    items go through the distributed edges and ``butina`` by one joint graph
    over (group, item), which needs a cutoff above 0.
    """
    distinct = rows.where(F.col(item).isNotNull() & (F.size(bits) > 0)).groupBy(group, item).agg(F.min(bits).alias(bits))
    sizes = cut(distinct.groupBy(group).count())
    small = distinct.join(sizes.where(F.col("count") <= largest).select(group), group, "left_semi")

    def run(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values(item, ignore_index=True)
        sets = [set(b) for b in d[bits]]
        sims = {}
        for i, a in enumerate(sets):
            for j in range(i):
                low, high = sorted((len(a), len(sets[j])))
                if low >= math.floor(cutoff * high):
                    k = len(a & sets[j])
                    sims[i, j] = k / (len(a) + len(sets[j]) - k)
        label = [0] * len(sets)
        for k, members in enumerate(butina_in_memory(sims, len(sets), cutoff), 1):
            for m in members:
                label[m] = k
        return pd.DataFrame({group: d[group], item: d[item], "cluster_id": label})

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = small.groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, {item} {kinds[item]}, cluster_id long")
    large = sizes.where(F.col("count") > largest).select(group)
    if not large.where(F.col(group).isNotNull()).take(1):
        return out
    return out.unionByName(_cluster_jointly(distinct.join(large, group, "left_semi"), group, item, bits, cutoff))


def _cluster_jointly(rows: DataFrame, group: str, item: str, bits: str, cutoff: float) -> DataFrame:
    """``group, item, cluster_id`` as ``cluster_groups`` has it, by one graph over all groups.

    Nodes are numbered in the order of (group, item), so that ties of ``butina``
    go as they do within a group; its ids are in order of picking and are ranked
    once more in each group.
    """
    from millrace.functions.ranks import rank_within

    nodes = cut(rows.select(F.col(group).alias("group"), F.col(item).alias("name"), F.col(bits).alias("bits")))
    nodes = cut(rank_within(nodes, [], ["group", "name"], "item"))
    labels = cut(butina(nodes, tanimoto_edges(nodes, cutoff, group="group")))
    where = nodes.select("item", "group", "name")
    centers = labels.where("item = representative").join(where, "item").select("group", "cluster_id")
    numbered = rank_within(centers, ["group"], ["cluster_id"]).select("cluster_id", (F.col("rank") + 1).alias("number"))
    named = labels.select("item", "cluster_id").join(numbered, "cluster_id").join(where, "item")
    return named.select(F.col("group").alias(group), F.col("name").alias(item), F.col("number").alias("cluster_id"))


def clusters_with_members(labels: DataFrame) -> DataFrame:
    """``cluster_id, representative, members`` (sorted list)."""
    return labels.groupBy("cluster_id", "representative").agg(F.sort_array(F.collect_list("item")).alias("members"))


def orphan_representatives(labels: DataFrame) -> DataFrame:
    """Representatives whose cluster has no such member: none in a sound result."""
    return labels.select("cluster_id", F.col("representative").alias("item")).distinct().join(labels.select("cluster_id", "item"), ["cluster_id", "item"], "left_anti")


def iter_batches(df: DataFrame, size: int = 200) -> Iterator[list]:
    """Rows on the driver, ``size`` at a time, partition by partition."""
    batch: list = []
    for row in df.toLocalIterator():
        batch.append(row)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch
