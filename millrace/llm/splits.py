"""Train, validation and test splits that keep related records together.

Records that share an entity form components.  Components of one size and label
profile are one bundle; a min-cost flow sends the rows of the profiles into the
quotas of the splits (rows beyond a quota cost), the flow is rounded to whole
components, and a component finds its split by the rank of its hash in its
bundle.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.nulls import norm_id
from millrace.functions.ranks import rank_within
from millrace.llm.components import connected_components, join_unique, tagged
from millrace.session import cut

SPLITS = ("train", "validation", "test")
SHARES = (0.8, 0.1, 0.1)


def min_cost_flow(arcs: list[list], supply: dict[str, int], sink: str) -> dict[tuple[str, str], int]:
    """Flow of all supplies to ``sink``; ``arcs`` are ``[from, to, capacity, cost]`` with costs >= 0.

    Successive shortest paths with potentials.  The graph holds one node for
    each label profile, oversized component and split, so it is tiny whatever
    the number of records.
    """
    graph: dict[str, list[list]] = defaultdict(list)  # [to, room, cost, index of the reverse arc]
    for a, b, room, cost in [*arcs, *(["source", n, s, 0] for n, s in supply.items())]:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
    potential: dict[str, float] = defaultdict(float)
    left = sum(supply.values())
    while left:
        dist, back, queue = {"source": 0.0}, {}, [(0.0, "source")]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for k, (b, room, cost, _) in enumerate(graph[a]):
                nd = d + cost + potential[a] - potential[b]
                if room and nd < dist.get(b, float("inf")) - 1e-9:
                    dist[b], back[b] = nd, (a, k)
                    heapq.heappush(queue, (nd, b))
        if sink not in dist:
            raise ValueError("the quotas can't take all rows")
        for n, d in dist.items():
            potential[n] += d
        push, n = left, sink
        while n != "source":
            a, k = back[n]
            push, n = min(push, graph[a][k][1]), a
        n = sink
        while n != "source":
            a, k = back[n]
            graph[a][k][1] -= push
            graph[n][graph[a][k][3]][1] += push
            n = a
        left -= push
    flow: dict[tuple[str, str], int] = defaultdict(int)
    for a, b, room, _ in arcs:
        flow[a, b] += room
    for a in list(graph):
        for b, room, cost, _ in graph[a]:
            if (a, b) in flow and cost >= 0:
                flow[a, b] -= room
    return flow


def allocate(bundles: dict[tuple[int, int], int], shares: Sequence[float] = SHARES) -> dict[tuple[int, int], list[int]]:
    """How many components of each bundle ``(size, profile)`` go to each split.

    Quotas are ``shares`` of the rows of each profile; rows beyond the quota of
    a profile cost 1, and beyond that of the whole split 10.  A component larger
    than the smallest quota is a flow node of its own and can't be parted.
    """
    if abs(sum(shares) - 1) > 1e-9 or min(shares) < 0:
        raise ValueError("shares must sum to 1")
    k = len(shares)
    total = sum(s * n for (s, _), n in bundles.items())
    rows_of: dict[int, int] = defaultdict(int)
    for (size, profile), n in bundles.items():
        rows_of[profile] += size * n
    quota = [sh * total for sh in shares]
    small = min((q for q in quota if q > 0), default=0)
    placed = {b: [0] * k for b in bundles}
    filled = [0.0] * k
    # components larger than a quota: largest first, to the split that they overfill least
    rest = dict(bundles)
    for (size, profile), n in sorted(bundles.items(), reverse=True):
        if size <= small:
            continue
        for _ in range(n):
            s = min(range(k), key=lambda i: (max(0.0, filled[i] + size - quota[i]), -(quota[i] - filled[i])))
            placed[size, profile][s] += 1
            filled[s] += size
        rest[size, profile] = 0
    supply: dict[int, int] = defaultdict(int)
    for (size, profile), n in rest.items():
        supply[profile] += size * n
    left = [max(0, round(q - f)) for q, f in zip(quota, filled)]
    arcs: list[list] = []
    for p, rows in supply.items():
        for s in range(k):
            share = round(rows * left[s] / max(1, sum(left)))
            arcs += [[f"p{p}", f"q{p}.{s}", rows, 0], [f"q{p}.{s}", f"s{s}", share, 0], [f"q{p}.{s}", f"x{p}.{s}", rows, 1], [f"x{p}.{s}", f"s{s}", rows, 0]]
    for s in range(k):
        arcs += [[f"s{s}", "sink", left[s], 0], [f"s{s}", f"o{s}", total, 10], [f"o{s}", "sink", total, 0]]
    flow = min_cost_flow(arcs, {f"p{p}": r for p, r in supply.items() if r}, "sink")
    # whole components: the flow's parts rounded down, the rest by the largest deficit
    over: list[tuple[int, int, int]] = []
    for (size, profile), n in sorted(rest.items(), reverse=True):
        if not n:
            continue
        parts = [flow[f"p{profile}", f"q{profile}.{s}"] / supply[profile] for s in range(k)]
        for s in range(k):
            x = int(n * parts[s] + 1e-9)
            placed[size, profile][s] += x
            filled[s] += x * size
        over.append((size, profile, n - sum(int(n * parts[s] + 1e-9) for s in range(k))))
    for size, profile, n in over:
        for _ in range(n):
            s = max(range(k), key=lambda i: (quota[i] - filled[i]) / size if shares[i] else float("-inf"))
            placed[size, profile][s] += 1
            filled[s] += size
    return placed


def pose_graph(poses: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between proteins, ligands and known ligand clusters (NULL and -1 are unknown; blank ids tie nothing)."""
    protein, ligand = norm_id("protein_id"), norm_id("ligand_id")
    pairs = cut(poses.select(tagged("P", protein).alias("u"), tagged("L", ligand).alias("v")).where("u IS NOT NULL AND v IS NOT NULL").distinct())
    known = labels.where("cluster_id IS NOT NULL AND cluster_id <> -1").select(tagged("L", norm_id("item_id")).alias("u"), tagged("C", F.col("cluster_id")).alias("v")).where("u IS NOT NULL").distinct()
    used = poses.select(tagged("L", ligand).alias("u")).where("u IS NOT NULL").distinct()
    return pairs.unionByName(known.join(used, "u", "left_semi"))


def pose_components(poses: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, component`` of all proteins and ligands that are tied to anything."""
    return cut(connected_components(pose_graph(poses, labels)))


def tied_proteins(components: DataFrame) -> DataFrame:
    """``anchor_protein, protein_id``: of each group of two or more proteins, its smallest id with each other id."""
    proteins = components.where(F.col("node").startswith("P|")).select(F.substring("node", 3, 1 << 30).alias("protein_id"), "component")
    least = proteins.groupBy("component").agg(F.min("protein_id").alias("anchor_protein"))
    return join_unique(proteins, least, "component").where("protein_id > anchor_protein").select("anchor_protein", "protein_id")


def assign_splits(poses: DataFrame, labels: DataFrame, id_col: str = "pose_id", shares: Sequence[float] = SHARES, components: DataFrame | None = None) -> DataFrame:
    """``id_col, component, split`` of every row.

    A row belongs to the component of its protein, else of its ligand; a row
    without either is a component of its own.  Every row gets a split, whatever
    is NULL; repeated rows share an entity and so a split.
    """
    components = components if components is not None else pose_components(poses, labels)
    protein, ligand = tagged("P", norm_id("protein_id")), tagged("L", norm_id("ligand_id"))
    known = labels.where("cluster_id IS NOT NULL AND cluster_id <> -1").select(tagged("L", norm_id("item_id")).alias("__ligand"), F.lit(1).alias("__known")).where("__ligand IS NOT NULL").distinct()
    rows = poses.select(id_col, F.coalesce(protein, ligand, tagged("R", F.col(id_col))).alias("node"), F.coalesce(ligand, F.lit("")).alias("__ligand"))
    rows = join_unique(rows, components, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
    rows = cut(join_unique(rows, known, "__ligand", "left").select(id_col, "component", F.coalesce("__known", F.lit(0)).alias("known")))
    sizes = rows.groupBy("component").agg(F.count("*").alias("size"), F.ceil(4 * F.avg("known")).cast("int").alias("profile")).withColumn("h", F.xxhash64("component"))
    ranked = cut(rank_within(sizes, ["size", "profile"], ["h", "component"]))
    # one entry per size and profile: at most 5 * sqrt(2 * rows), since the sizes sum to the rows
    bundles = {(r["size"], r["profile"]): r["count"] for r in ranked.groupBy("size", "profile").count().collect()}
    plan = []
    for (size, profile), counts in allocate(bundles, shares).items():
        first = 0
        for s, n in zip(SPLITS, counts):
            if n:
                plan.append((size, profile, first, first + n, s))
                first += n
    spark = poses.sparkSession
    quota = spark.createDataFrame(plan, "size long, profile int, first long, past long, split string")
    quota = quota.groupBy("size", "profile").agg(F.collect_list(F.struct("first", "past", "split")).alias("parts"))
    part = F.filter("parts", lambda p: (p["first"] <= F.col("rank")) & (F.col("rank") < p["past"]))[0]["split"]
    split_of = ranked.join(quota, ["size", "profile"]).select("component", part.alias("split"))
    return join_unique(rows, split_of, "component").select(id_col, "component", "split")
