"""Similarity clusters of SMILES: MinHash bands, exact Jaccard, components, medoids.

A structure is reduced to its skeleton (counter-ions, stereo marks and small
branches removed; a branch with a ring or of many atoms stays).  Equal skeletons are one item.  Items that agree in a band of their
MinHash signature are candidates; exact Jaccard on the skeletons' shingles
decides; components of the links form groups, and groups that are loose are
split around the members of most links.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import connected_components, join_unique
from millrace.session import cut, spread

#: Characters of a shingle; bands and rows of the signature; least Jaccard of a link.  A pair at the threshold meets in a
#: band with probability 1 - (1 - 0.55^6)^84 = 0.905, one at 0.6 with 0.982.
SHINGLE, BANDS, ROWS, THRESHOLD = 5, 84, 6, 0.55
#: Atoms of the largest branch that is a small group; a branch that holds a ring is none.
SMALL_GROUP = 8
#: Part of a skeleton that may differ (short ones: up to FEW characters, and at most MOST of the length): beyond it two
#: structures share rings and links, but are no variants.
EDITS, FEW, MOST = 0.085, 4, 0.15
#: A group is loose where a member has fewer than this part of the possible links.
LOOSE = 0.5
#: Items of a bucket that are paired in one task; larger buckets are paired block by block.
BLOCK = 256
_MARK = re.compile(r"\[(?:\d*)([A-Za-z][a-z]?)@*H?\d*[+-]*\d*(?::\d+)?\]")
_BRANCH, _ATOM = re.compile(r"\(([^()]*)\)"), re.compile(r"Br|Cl|[A-Za-z*\x01]")


def _branch(m: re.Match[str]) -> str:
    """A small branch leaves one mark an atom, for the branch around it to count; another stays, in brackets of its own."""
    body = m[1]
    atoms = len(_ATOM.findall(body))
    if atoms > SMALL_GROUP or "\x02" in body or any(c.isdigit() or c == "%" for c in body):
        return f"\x02{body}\x03"
    return "\x01" * atoms


def skeleton(smiles: str | None) -> str | None:
    """The chain of rings and linkers of the largest part of a SMILES, with the branches that are no small groups; None where blank."""
    text = (smiles or "").translate({1: None, 2: None, 3: None}).strip()
    if not text:
        return None
    text = _MARK.sub(lambda m: m[1], text).replace("/", "").replace("\\", "").replace("@", "")
    text = max(text.split("."), key=len)
    while True:
        bare = _BRANCH.sub(_branch, text)
        if bare == text:
            return bare.translate({1: None, 2: "(", 3: ")"})
        text = bare


def shingles(text: str, size: int = SHINGLE) -> set[str]:
    return {text[i : i + size] for i in range(max(1, len(text) - size + 1))}


def jaccard(a: set[str], b: set[str]) -> float:
    return len(a & b) / len(a | b)


_SEED = np.random.default_rng(20240601).integers(1, 1 << 63, size=(2, BANDS * ROWS), dtype=np.uint64)
_SEED[0] |= np.uint64(1)


def signature(text: str) -> np.ndarray:
    """MinHash of the shingles: multiply-shift over 64 bits, of which the upper half is compared."""
    h = np.array([zlib.crc32(s.encode()) for s in shingles(text)], dtype=np.uint64)
    h = (h ^ (h >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h[:, None] * _SEED[0] + _SEED[1]) >> np.uint64(32)).min(axis=0)


def edits_allowed(length: int) -> int:
    """Edits between variants whose longer skeleton has this length."""
    return min(max(FEW, int(EDITS * length + 1e-9)), int(MOST * length + 1e-9))


def allowed(longer: Column) -> Column:
    """``edits_allowed`` of a column of lengths."""
    return F.least(F.greatest(F.lit(FEW), F.floor(F.lit(EDITS) * longer + 1e-9)), F.floor(F.lit(MOST) * longer + 1e-9)).cast("int")


#: Signs whose numbers are compared before texts are: groups of six bits each, at most 63 counted; the rest is the last group.
SIGNS = ("C", "c", "N", "n", "Oo", "Ss", "1", "2", "=#")


def counts(text: Column) -> Column:
    """Numbers of the sign groups of a text in one 64-bit word."""
    n = [F.length(text) - F.length(F.translate(text, g, "")) for g in SIGNS]
    n.append(F.length(text) - sum(n[1:], n[0]))
    return sum((F.shiftleft(F.least(x, F.lit(63)).cast("long"), 6 * i) for i, x in enumerate(n)), F.lit(0).cast("long"))


def counts_apart(a: Column, b: Column) -> Column:
    """Sum of the differences of two words of ``counts``: an edit changes it by two at most, so it bounds the edits from below."""
    parts = [F.abs(F.shiftright(a, 6 * i).bitwiseAND(F.lit(63)) - F.shiftright(b, 6 * i).bitwiseAND(F.lit(63))) for i in range(len(SIGNS) + 1)]
    return sum(parts[1:], parts[0])


def skeletons(df: DataFrame, key: str, smiles: str) -> DataFrame:
    """``key, skeleton`` of each row with a SMILES."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "skeleton": [skeleton(s) for s in b[smiles]]})

    schema = f"{key} {df.schema[key].dataType.simpleString()}, skeleton string"
    return df.where(F.col(key).isNotNull() & F.col(smiles).isNotNull()).select(key, smiles).mapInPandas(run, schema).where("skeleton IS NOT NULL")


def bands(items: DataFrame) -> DataFrame:
    """``item, size, counts, band``: one row per item and band; the band's number is part of its hash, ``size`` is the length of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mix = np.random.default_rng(7).integers(1, 1 << 62, size=ROWS, dtype=np.uint64) | np.uint64(1)
        for b in batches:
            if b.empty:
                continue
            sig = np.stack([signature(s) for s in b["skeleton"]]).reshape(len(b), BANDS, ROWS)
            h = ((sig ^ (sig >> np.uint64(29))) * mix).sum(axis=2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xBF58476D1CE4E5B9)
            yield pd.DataFrame({**{c: np.repeat(b[c].to_numpy(), BANDS) for c in ("item", "size", "counts")}, "band": h.astype(np.int64).ravel()})

    rows = items.select("item", F.length("skeleton").alias("size"), counts(F.col("skeleton")).alias("counts"), "skeleton")
    return spread(rows, "item").mapInPandas(run, "item long, size int, counts long, band long")


def candidates(banded: DataFrame) -> DataFrame:
    """``a, b`` (a < b): pairs of items that share a band, each once, whose lengths and signs allow for few enough edits.

    Items of a bucket are numbered and cut into blocks of 256; pairs of blocks
    are the keys of an equi-join, so a bucket of any size is paired by many
    tasks.  Pairs that agree by chance mostly fail the bound on the numbers of
    their signs, before anything of them is sent on.
    """
    sizes = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = banded.join(sizes, "band")
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("item"), n_blocks).cast("int")
    shared = shared.withColumn("blocks", n_blocks).withColumn("block", block)
    of = ("item", "size", "counts")
    left = shared.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))).select("band", F.col("block").alias("p"), F.col("other").alias("q"), *(F.col(c).alias(f"{c}_x") for c in of))
    right = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("block")))).select("band", F.col("other").alias("p"), F.col("block").alias("q"), *(F.col(c).alias(f"{c}_y") for c in of))
    x, y = F.col("item_x"), F.col("item_y")
    pairs = left.join(right, ["band", "p", "q"]).where((F.col("p") < F.col("q")) | (x < y)).where(x != y)
    most = allowed(F.greatest("size_x", "size_y"))
    pairs = pairs.where((F.abs(F.col("size_x") - F.col("size_y")) <= most) & (counts_apart(F.col("counts_x"), F.col("counts_y")) <= 2 * most))
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _shingle_set(text: Column) -> Column:
    """``shingles`` of a column."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - SHINGLE + 1)), lambda i: F.substring(text, i, F.lit(SHINGLE))))


def verify(pairs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the pairs whose exact Jaccard reaches the threshold and whose texts differ in few enough edits.

    Both tests are built-in expressions; the bounded edit distance goes first,
    since it costs less.
    """
    text = items.select("item", "skeleton")
    both = pairs.join(text.withColumnsRenamed({"item": "a", "skeleton": "sa"}), "a").join(text.withColumnsRenamed({"item": "b", "skeleton": "sb"}), "b")
    both = both.withColumn("most", allowed(F.greatest(F.length("sa"), F.length("sb"))))
    near = both.where(F.expr("levenshtein(sa, sb, most) >= 0"))
    near = near.select("a", "b", F.explode(F.array(F.struct(_shingle_set(F.col("sa")).alias("x"), _shingle_set(F.col("sb")).alias("y")))).alias("s"))
    shared = F.size(F.array_intersect("s.x", "s.y"))
    sim = near.select("a", "b", F.size("s.x").alias("nx"), F.size("s.y").alias("ny"), F.explode(F.array(shared)).alias("n"))
    return sim.select("a", "b", (F.col("n") / (F.col("nx") + F.col("ny") - F.col("n"))).alias("similarity")).where(F.col("similarity") >= threshold)


def split_loose(members: DataFrame, links: DataFrame, loose: float = LOOSE) -> DataFrame:
    """``item, cluster``: groups in which a member lacks half of the links are split around medoids.

    In every round, each member of a loose group that has more links in its
    group than all its neighbours (ties: by a hash of the item) is a medoid; its
    neighbours join the medoid of most links that they are linked with, and
    links between different clusters end.  What is left goes on as it is
    connected, until nothing is left.  All groups take a step together, and all
    medoids of a group at once, so a long chain takes few rounds.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    left, done = members.select("item", F.col("component").alias("group")), []
    while True:
        degree = both.groupBy(F.col("a").alias("item")).agg(F.count("*").alias("degree"))
        left = cut(left.join(degree, "item", "left").fillna(0, ["degree"]))
        if not left.take(1):
            break
        state = left.groupBy("group").agg((F.min("degree") >= F.lit(loose) * (F.count("*") - 1)).alias("tight"))
        placed = cut(join_unique(left, state, "group"))
        done.append(placed.where("tight").select("item", F.col("group").alias("cluster")))
        split = placed.where("NOT tight").select("item", F.struct(F.col("degree").alias("d"), F.xxhash64("item").alias("h"), F.col("item").alias("i")).alias("prio"))
        if not split.take(1):
            break
        inner = both.join(split.withColumnsRenamed({"item": "a", "prio": "pa"}), "a").join(split.withColumnsRenamed({"item": "b", "prio": "pb"}), "b")
        inner = cut(inner)
        best = inner.groupBy("a").agg(F.max("pb").alias("pb"), F.first("pa").alias("pa"))
        medoids = cut(split.join(best.where("pb > pa").select(F.col("a").alias("item")), "item", "left_anti").select("item"))
        around = inner.join(medoids.select(F.col("item").alias("b")), "b", "left_semi").groupBy("a").agg(F.max("pb")["i"].alias("medoid"))
        own = medoids.select("item", F.col("item").alias("medoid"))
        taken = cut(own.unionByName(around.select(F.col("a").alias("item"), "medoid")))
        done.append(taken.select("item", F.col("medoid").alias("cluster")))
        rest = split.select("item").join(taken.select("item"), "item", "left_anti")
        both = inner.select("a", "b").join(taken.select(F.col("item").alias("a")), "a", "left_anti").join(taken.select(F.col("item").alias("b")), "b", "left_anti")
        both = cut(both)
        groups = connected_components(both.where("a < b"), "a", "b").withColumnsRenamed({"node": "item", "component": "group"})
        left = rest.join(groups, "item", "left").withColumn("group", F.coalesce("group", "item"))
    out = done[0] if done else members.select("item", F.col("component").alias("cluster"))
    for part in done[1:]:
        out = out.unionByName(part)
    return out


class SmilesClusters:
    """Clusters of the rows of ``df`` (``key`` unique, text ``smiles``).  Rows with a NULL key or blank SMILES are left out.

    ``items``: item (smallest key of a skeleton), skeleton; ``membership``: key,
    item; ``links``: verified pairs of items; ``clusters``: item, cluster.
    """

    def __init__(self, df: DataFrame, key: str = "cid", smiles: str = "SMILES", threshold: float = THRESHOLD) -> None:
        self.key = key
        skel = cut(skeletons(df, key, smiles))
        classes = skel.groupBy("skeleton").agg(F.min(key).cast("long").alias("item"), F.count("*").alias("copies"))
        self.items = cut(classes)
        self.membership = cut(join_unique(skel, self.items.select("skeleton", "item"), "skeleton").select(key, "item"))
        self.links = cut(verify(cut(candidates(cut(bands(self.items)))), self.items, threshold))
        groups = connected_components(self.links, "a", "b").withColumnRenamed("node", "item")
        linked = split_loose(groups, self.links)
        alone = self.items.select("item").join(linked, "item", "left_anti").select("item", F.col("item").alias("cluster"))
        self.clusters = cut(linked.unionByName(alone))

    def summary(self, representatives: int = 3) -> DataFrame:
        """``cluster_label, cluster_size, representatives``: the most linked members, copies counted, smallest first among equals."""
        degree = self.links.select(F.col("a").alias("item")).unionByName(self.links.select(F.col("b").alias("item"))).groupBy("item").agg(F.count("*").alias("degree"))
        d = self.clusters.join(self.items.select("item", "copies"), "item").join(degree, "item", "left").fillna(0, ["degree"])
        best = Window.partitionBy("cluster").orderBy(F.desc("degree"), F.desc("copies"), "item")
        ranked = d.withColumn("rn", F.row_number().over(best))
        top = ranked.where(F.col("rn") <= representatives).groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "item"))), lambda s: s["item"]).alias("representatives"))
        sizes = d.groupBy("cluster").agg(F.sum("copies").alias("cluster_size"))
        return sizes.join(top, "cluster").select(F.col("cluster").alias("cluster_label"), "cluster_size", "representatives")

    def pairs(self) -> DataFrame:
        """Pairs of keys whose skeletons are equal or linked, smaller first; the ends of a link may lie in two clusters of a loose group."""
        a, b = f"{self.key}_a", f"{self.key}_b"
        blocks = F.ceil(F.col("copies") / BLOCK).cast("int")
        parts = self.items.select("item", blocks.alias("n"))
        same = parts.join(self.items.where("copies > 1").select("item"), "item", "left_semi").select(F.col("item").alias("a"), F.col("item").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
        links = self.links.select("a", "b").join(parts.withColumnsRenamed({"item": "a", "n": "na"}), "a").join(parts.withColumnsRenamed({"item": "b", "n": "nb"}), "b")
        # copies of a skeleton lie in blocks, and pairs of blocks are the keys: no task gets all copies of one
        every = links.unionByName(same).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        every = every.where("a <> b OR p <= q").select("a", "b", "p", "q")
        m = join_unique(self.membership, parts, "item").withColumn("block", F.pmod(F.xxhash64(self.key), F.col("n")).cast("int")).drop("n")
        out = every.join(m.withColumnsRenamed({self.key: "x", "item": "a", "block": "p"}), ["a", "p"]).join(m.withColumnsRenamed({self.key: "y", "item": "b", "block": "q"}), ["b", "q"])
        out = out.where("a <> b OR p < q OR x < y")
        return out.select(F.least("x", "y").alias(a), F.greatest("x", "y").alias(b))
