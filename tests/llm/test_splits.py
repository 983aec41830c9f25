"""Components, flow, splits."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("millrace.llm")

from millrace.llm import splits as S  # noqa: E402
from millrace.llm.components import connected_components, join_unique  # noqa: E402


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(4))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.choice([10, 40]))]
    edges += [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 230)]  # a chain and a hub
    df = spark.createDataFrame([*edges, (None, 5), (7, None)], "u long, v long").union(spark.createDataFrame(edges[:3], "u long, v long"))
    assert {r.node: r.component for r in connected_components(df).collect()} == union_find([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_hot_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.components.HOT_ROWS", 10)
    left = spark.range(300).select(F.when(F.col("id") < 250, F.lit("hot")).when(F.col("id") < 290, F.col("id").cast("string")).alias("k"), "id")
    right = left.where("k IS NOT NULL").select("k").distinct().withColumn("v", F.length("k"))
    assert join_unique(left, right, "k").count() == 290 and join_unique(left, right, "k", "left").count() == 300


def test_flow_is_cheapest():
    arcs = [["p", "a", 10, 0], ["p", "b", 10, 2], ["a", "t", 6, 0], ["b", "t", 10, 0]]
    flow = S.min_cost_flow(arcs, {"p": 8}, "t")
    assert (flow["p", "a"], flow["p", "b"]) == (6, 2)
    with pytest.raises(ValueError):
        S.min_cost_flow([["p", "t", 1, 0]], {"p": 2}, "t")


@pytest.mark.parametrize("seed", range(10))
def test_allocation_is_whole_and_near(seed):
    rng = random.Random(seed)
    bundles = {(rng.randint(1, 20), rng.randint(0, 4)): rng.randint(1, 60) for _ in range(30)}
    placed = S.allocate(bundles)
    assert all(sum(placed[b]) == n and min(placed[b]) >= 0 for b, n in bundles.items())
    total = sum(s * n for (s, _), n in bundles.items())
    for k, share in enumerate(S.SHARES):
        assert abs(sum(b[0] * placed[b][k] for b in bundles) - share * total) <= 20


def test_a_giant_goes_to_train():
    placed = S.allocate({(700, 0): 1, (1, 0): 300})
    assert placed[700, 0] == [1, 0, 0] and placed[1, 0] == [100, 100, 100]
    assert S.allocate({}) == {}
    with pytest.raises(ValueError):
        S.allocate({(1, 0): 1}, (0.5, 0.6, 0.1))


POSES = "pose_id long, protein_id string, ligand_id string, component string"
LABELS = "item_id string, cluster_id long, representative string"


def test_related_poses_stay_together(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["p%d" % rng.randint(0, 150), " ", None]), rng.choice(["l%d" % rng.randint(0, 400), "", None]), "clash") for i in range(900)]
    labels = [(f"L{i}", i // 2, "x") for i in range(0, 120)] + [("l200", -1, "x"), ("l201", -1, "x"), ("l202", None, "x"), (None, 3, None), ("l1", 0, "x")]
    poses, lab = spark.createDataFrame(rows, POSES), spark.createDataFrame(labels, LABELS)
    got = {r.pose_id: (r.component, r.split) for r in S.assign_splits(poses, lab).collect()}
    assert len(got) == 900 and all(s in S.SPLITS for _, s in got.values())
    cluster = {i.upper(): c for i, c, _ in labels if i and c is not None and c != -1}
    edges = []
    for _, p, lig, _ in rows:
        p, lig = (p or "").strip().upper(), (lig or "").strip().upper()
        if p and lig:
            edges.append(("P" + p, "L" + lig))
            if lig in cluster:
                edges.append(("L" + lig, f"C{cluster[lig]}"))
        elif lig in cluster:
            edges.append(("L" + lig, f"C{cluster[lig]}"))
    root = union_find(edges)
    seen = defaultdict(set)
    for i, p, lig, _ in rows:
        p, lig = (p or "").strip().upper(), (lig or "").strip().upper()
        node = "P" + p if p else "L" + lig if lig else f"R{i}"
        seen[root.get(node, node)].add(got[i][1])
    assert all(len(s) == 1 for s in seen.values())
    tied = {(r.anchor_protein, r.protein_id) for r in S.tied_proteins(S.pose_components(poses, lab)).collect()}
    groups = defaultdict(set)
    for n, r in root.items():
        if n[0] == "P":
            groups[r].add(n[1:])
    assert tied == {(min(g), x) for g in groups.values() for x in g if x != min(g)}


def test_near_the_quotas_and_the_same_each_time(spark):
    rows = [(i, f"p{i // 3}", f"l{i}", "") for i in range(3000)]
    poses, lab = spark.createDataFrame(rows, POSES), spark.createDataFrame([], LABELS)
    one = S.assign_splits(poses, lab)
    n = {r.split: r["count"] for r in one.groupBy("split").count().collect()}
    assert abs(n["train"] - 2400) <= 3 and abs(n["test"] - 300) <= 3
    assert S.assign_splits(poses.repartition(3), lab).exceptAll(one).count() == 0


def test_empty_tables(spark):
    poses, lab = spark.createDataFrame([], POSES), spark.createDataFrame([], LABELS)
    assert S.assign_splits(poses, lab).count() == 0 and S.tied_proteins(S.pose_components(poses, lab)).count() == 0
