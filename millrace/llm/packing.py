"""Filling containers of fixed capacity by a grouping genetic algorithm on islands.

Items are dealt to shards of bounded size by hash.  Each shard is packed by
several islands; an island is one row of a table and evolves a small population
inside a task.  Between epochs the elite of each island moves to the next island
of its shard: islands and elites are rows of one shuffle by shard and island.
Crossover puts well-filled
containers of one parent into the other, drops the containers that hold an item
twice and places the displaced items by best fit.  What the shards leave in
poorly filled containers is dealt and packed once more.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

#: Items of a shard (about), islands of a shard, members of an island, epochs, generations of an epoch.
SHARD_ITEMS, ISLANDS, MEMBERS, EPOCHS, GENERATIONS = 1500, 3, 6, 4, 8
#: Containers filled below this are packed once more.
WELL_FILLED = 0.97

Bins = list[list[int]]
#: Containers and what each holds.
Packing = tuple[Bins, list[int]]
#: A container's room and its place in one number: room << SHIFT | place.
SHIFT, PLACE = 32, (1 << 32) - 1


def _place(items: list[int], sizes: list[int], capacity: int, bins: Bins, loads: list[int]) -> None:
    """Places ``items`` in the given order, each into the fullest container with room; ``loads`` are the filled sizes of ``bins``."""
    rooms = sorted([(capacity - load << SHIFT) + k for k, load in enumerate(loads)])
    for i in items:
        size = sizes[i] << SHIFT
        at = bisect_left(rooms, size)
        if at == len(rooms):
            rooms.append(-1)  # the largest room, so far
            room = (capacity << SHIFT) + len(bins)
            bins.append([])
            loads.append(0)
        else:
            room = rooms[at]
        del rooms[at]
        room -= size
        bins[room & PLACE].append(i)
        insort(rooms, room, 0, at)
    for room in rooms:
        loads[room & PLACE] = capacity - (room >> SHIFT)


def _loads(bins: Bins, sizes: list[int]) -> list[int]:
    return [sum([sizes[i] for i in b]) for b in bins]


def best_fit(items: list[int], sizes: list[int], capacity: int, bins: Bins) -> Bins:
    """Places ``items`` in the given order, each into the fullest container with room."""
    _place(items, sizes, capacity, bins, _loads(bins, sizes))
    return bins


def _fitness(loads: list[int], capacity: int) -> float:
    return sum([x * x for x in loads]) / (capacity * capacity * max(1, len(loads)))


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    """Mean square of the fill: of two packings into as many containers, that with the emptier leftovers is better."""
    return _fitness(_loads(bins, sizes), capacity)


def _by_size(sizes: list[int]) -> list[int]:
    """Items from the largest on."""
    return sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))


def _cross(a: Packing, b: Packing, sizes: list[int], capacity: int, rank: list[int], rng: random.Random) -> Packing:
    (a_bins, a_loads), (b_bins, b_loads) = a, b
    ranked = sorted(range(len(b_bins)), key=b_loads.__getitem__, reverse=True)
    top = ranked[: max(1, len(ranked) // 2)]
    chosen = [k for k in top if rng.random() < 0.5] or top[:1]
    bins, loads = [b_bins[k].copy() for k in chosen], [b_loads[k] for k in chosen]
    taken = set(chain.from_iterable(bins))
    displaced = []
    for x, load in zip(a_bins, a_loads):
        if taken.isdisjoint(x):
            bins.append(x.copy())
            loads.append(load)
        else:
            displaced += [i for i in x if i not in taken]
    displaced.sort(key=rank.__getitem__)
    _place(displaced, sizes, capacity, bins, loads)
    return bins, loads


def crossover(a: Bins, b: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Child of ``a`` with well-filled containers of ``b``."""
    rank = _inverse(_by_size(sizes))
    return _cross((a, _loads(a, sizes)), (b, _loads(b, sizes)), sizes, capacity, rank, rng)[0]


def _dissolve(own: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """``mutate`` of a packing that nobody else holds."""
    bins, loads = own
    if len(bins) < 2:
        return own
    gone = {loads.index(min(loads)), *rng.sample(range(len(bins)), min(len(bins), max(1, len(bins) // 20)))}
    loose = [i for k in gone for i in bins[k]]
    rest = [b for k, b in enumerate(bins) if k not in gone]
    loads = [x for k, x in enumerate(loads) if k not in gone]
    rng.shuffle(loose)
    loose.sort(key=lambda i: -(sizes[i] // 8))
    _place(loose, sizes, capacity, rest, loads)
    return rest, loads


def mutate(bins: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Dissolves the emptiest container and some others, and places their items again."""
    return _dissolve(([list(b) for b in bins], _loads(bins, sizes)), sizes, capacity, rng)[0]


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Containers that any packing needs: by the sum of sizes, and by those that can't share one."""
    return max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


def encode(bins: Bins, n: int) -> list[int]:
    where = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            where[i] = k
    return where


def decode(where: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(where):
        bins.setdefault(int(k), []).append(i)
    return list(bins.values())


def _inverse(order: list[int]) -> list[int]:
    """The place of every item in ``order``."""
    rank = [0] * len(order)
    for k, i in enumerate(order):
        rank[i] = k
    return rank


def evolve(sizes: list[int], capacity: int, population: list[Bins], rng: random.Random, generations: int) -> list[Bins]:
    """The population after some generations, best first; the best member never gets worse.  Of a population that reaches
    the lower bound only that member is left."""
    n = len(sizes)
    order = _by_size(sizes)
    if not population:
        population = [best_fit(order, sizes, capacity, [])]
        while len(population) < MEMBERS:
            key = [-s * rng.uniform(0.7, 1.3) for s in sizes]
            noisy = sorted(range(n), key=key.__getitem__)
            population.append(best_fit(noisy, sizes, capacity, []))
    held = [(p, _loads(p, sizes)) for p in population]
    scored = sorted([(_fitness(p[1], capacity), p) for p in held], key=lambda t: -t[0])
    bound, rank = lower_bound(sizes, capacity), _inverse(order)
    for _ in range(generations):
        if len(scored[0][1][0]) <= bound:
            break  # no packing has fewer containers
        pairs = [rng.sample(scored, 2) if len(scored) > 1 else [scored[0], scored[0]] for _ in range(MEMBERS // 2)]
        children = [_dissolve(_cross(x[1], y[1], sizes, capacity, rank, rng), sizes, capacity, rng) for x, y in pairs]
        scored += [(_fitness(c[1], capacity), c) for c in children]
        scored = sorted(scored, key=lambda t: -t[0])[:MEMBERS]
    if len(scored[0][1][0]) <= bound:
        scored = scored[:1]
    return [p[0] for _, p in scored]


#: Rows of an epoch: the islands, and (without sizes) the elites that move to them, as the only member of ``population``.
#: ``population`` has the container of each item, ``loads`` (after the last epoch) what the best member's containers hold.
_STATE = "shard long, island int, sizes array<long>, population array<array<int>>, fitness double, loads array<long>"


def _epoch(capacity: int, epoch: int):
    def island(shard: int, number: int, sizes: list[int], population: list, guest) -> Iterator[tuple]:
        members = [w.tolist() for w in population]
        if guest is not None:
            members.append(guest.tolist())
        bins = [decode(w) for w in members]
        bins = evolve(sizes, capacity, bins, random.Random(f"{shard}.{number}.{epoch}"), GENERATIONS)
        best, held = encode(bins[0], len(sizes)), _loads(bins[0], sizes)
        if epoch + 1 == EPOCHS:
            yield shard, number, sizes, [best], _fitness(held, capacity), held
            return
        yield shard, number, sizes, [best, *(encode(m, len(sizes)) for m in bins[1:])], None, None
        yield shard, (number + 1) % ISLANDS, None, [best], None, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        guest = None  # it stands before its island
        for d in batches:
            out = []
            for shard, number, sizes, population in zip(d["shard"], d["island"], d["sizes"], d["population"]):
                if sizes is None:
                    guest = population[0]
                    continue
                out += island(shard, number, sizes.tolist(), population, guest)
                guest = None
            yield pd.DataFrame(out, columns=["shard", "island", "sizes", "population", "fitness", "loads"])

    return run


def _pack(items: DataFrame, capacity: int, seed: int) -> DataFrame:
    """``key..., size, shard, bin, load`` of items that fit a container; ``load`` is what the container holds."""
    n = items.count()
    shards = max(1, -(-n // SHARD_ITEMS))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(shards)))
    grouped = dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("key", "size"))).alias("items"))
    state = grouped.select("shard", F.explode(F.array(*(F.lit(i) for i in range(ISLANDS)))).alias("island"), F.transform("items", lambda x: x["size"]).alias("sizes"))
    state = state.withColumn("population", F.array().cast("array<array<int>>"))
    parts = max(1, min(shards * ISLANDS, 4 * items.sparkSession.sparkContext.defaultParallelism))
    for epoch in range(EPOCHS):
        state = state.repartition(parts, "shard", "island")
        if epoch:
            state = state.sortWithinPartitions("shard", "island", F.col("sizes").isNotNull())
        state = state.mapInPandas(_epoch(capacity, epoch), _STATE)
    best = state.groupBy("shard").agg(F.max_by(F.struct(F.col("population")[0].alias("bins"), "loads"), F.struct("fitness", -F.col("island"))).alias("best"))
    placed = grouped.join(best, "shard").select("shard", "best.loads", F.explode(F.arrays_zip("items", "best.bins")).alias("z"))
    return cut(placed.select("z.items.key", "z.items.size", "shard", F.col("z.bins").alias("bin"), F.col("loads")[F.col("z.bins")].alias("load")))


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: ``n_items, n_containers, lower_bound, fill``: containers used, those that the sum of sizes needs at least, and
    the used part of the room (NULL where nothing is packed)."""
    per = packed.groupBy("container").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    total = F.coalesce(F.sum("size"), F.lit(0))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_items"), F.count("*").alias("n_containers"), F.ceil(total / capacity).cast("bigint").alias("lower_bound"),
        F.try_divide(total.cast("double"), F.count("*") * F.lit(capacity)).alias("fill"),
    )


def pack_items(items: DataFrame, id_col: str, size_col: str, capacity: int) -> DataFrame:
    """``id_col, piece, size, container`` of every item.

    An item larger than the capacity is cut into pieces of just that capacity
    and a rest; no other item is divided.  Full pieces are containers of their
    own.  An item of NULL, zero or negative size takes no room and shares a
    container.  Repeated ids are items of their own only if the id differs.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    size = F.greatest(F.lit(0), F.coalesce(F.col(size_col).cast("long"), F.lit(0)))
    full = F.floor(size / capacity).cast("int")
    pieces = items.select(F.col(id_col).alias("id"), size.alias("whole"), full.alias("full")).select(
        "id", "whole", "full", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.when(F.col("whole") % capacity == 0, F.col("full") - 1).otherwise(F.col("full"))))).alias("piece")
    )
    pieces = cut(pieces.select(F.struct("id", "piece").alias("key"), F.when(F.col("piece") < F.col("full"), F.lit(capacity)).otherwise(F.col("whole") % capacity).cast("long").alias("size")))
    alone = pieces.where(F.col("size") == capacity).select("key", "size", F.concat(F.lit("f"), F.col("key.id").cast("string"), F.lit("."), F.col("key.piece")).alias("container"))
    first = _pack(pieces.where(F.col("size") < capacity), capacity, 1)
    filled = F.col("load") / capacity >= WELL_FILLED
    good = first.where(filled).select("key", "size", F.concat(F.lit("a"), F.col("shard"), F.lit("."), F.col("bin")).alias("container"))
    again = _pack(first.where(~filled).select("key", "size"), capacity, 2)
    again = again.select("key", "size", F.concat(F.lit("b"), F.col("shard"), F.lit("."), F.col("bin")).alias("container"))
    out = alone.unionByName(good).unionByName(again)
    return out.select(F.col("key.id").alias(id_col), F.col("key.piece").alias("piece"), "size", "container")
