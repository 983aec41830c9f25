"""Skeletons, MinHash candidates, links, clusters."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("millrace.llm")

from millrace.llm import similar as S  # noqa: E402

RINGS = "c1ccccc1 C1CCNCC1 c1ccncc1 C1CCOC1 c1ccsc1 c1cc2ncccc2cc1 C1CCCCCC1 n1ccnc1".split()
LINKS = "CCC OCC NC CNC SCC C=CC CCCC OC=O".split()


def chain(rng, n=6):
    return "".join(x for _ in range(n) for x in (rng.choice(RINGS), rng.choice(LINKS)))


def test_skeleton():
    assert S.skeleton(" c1cc(C(F)(F)F)cc1CN[C@@H](C)C.Cl ") == "c1cccc1CNCC"
    assert S.skeleton("Cl.c1ccccc1") == "c1ccccc1"
    assert S.skeleton("[Na+].C1CC1") == "C1CC1"
    assert [S.skeleton(t) for t in (None, "", " \t")] == [None] * 3
    assert S.skeleton("((((") == "((((" and S.skeleton("(C)") == ""


def test_only_small_groups_are_removed():
    ring = "CCC(CC(=O)N1CCOCC1CCCCCCCC(=O)NCCCCc2ccccc2)CCO"
    assert S.skeleton(ring) == "CCC(CCN1CCOCC1CCCCCCCCNCCCCc2ccccc2)CCO" != S.skeleton("CCC(F)CCO")
    assert S.skeleton("CC(CCCCCCCC)C") == "CCC" and S.skeleton("CC(CCCCCCCCC)C") == "CC(CCCCCCCCC)C"
    assert S.skeleton("CC(C(C)(C)C(C)(C)C)C") == "CCC" and S.skeleton("CC(CCCC(CCC(C)C)C)C") == "CC(CCCCC)C"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def within_edits(a, b):
    most = S.edits_allowed(max(len(a), len(b)))
    return a == b or abs(len(a) - len(b)) <= most and distance(a, b) <= most


def test_bounds_hold_for_every_edit(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("CcNnOoSs12=#(") for _ in range(rng.randint(1, 90)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "C", "Br", "1"])
        rows.append((a, "".join(b) or "C"))
    df = spark.createDataFrame(rows, "a string, b string")
    most = S.allowed(F.greatest(F.length("a"), F.length("b")))
    got = df.select("a", "b", most.alias("most"), S.counts_apart(S.counts(F.col("a")), S.counts(F.col("b"))).alias("apart"), F.expr("levenshtein(a, b)").alias("d")).withColumn("near", F.expr("levenshtein(a, b, most) >= 0")).collect()
    for r in got:
        assert r.most == S.edits_allowed(max(len(r.a), len(r.b))) and r.apart <= 2 * r.d and r.d == distance(r.a, r.b) and r.near == (r.d <= r.most)


def test_recall_at_the_threshold():
    assert 1 - (1 - S.THRESHOLD**S.ROWS) ** S.BANDS >= 0.9


def test_minhash_estimates_jaccard():
    rng = random.Random(1)
    a, b = chain(rng), None
    b = a[:40] + "N" + a[40:]
    share = (S.signature(a) == S.signature(b)).mean()
    assert abs(share - S.jaccard(S.shingles(a), S.shingles(b))) < 0.12


def brute(items, threshold=S.THRESHOLD):
    out = set()
    for i, (a, x) in enumerate(items):
        for b, y in items[:i]:
            if x == y or S.jaccard(S.shingles(x), S.shingles(y)) >= threshold and within_edits(x, y):
                out.add((min(a, b), max(a, b)))
    return out


def test_pairs_match_brute_force(spark):
    rng = random.Random(7)
    rows, cid = [], 0
    for _ in range(12):
        parent = chain(rng)
        for k in range(rng.randint(1, 5)):
            cid += 1
            variant = parent.replace("CCC", "CC(Cl)C", k) + ("" if k % 2 else ".Cl")
            rows.append((cid, variant if k != 2 else parent[:30] + "O" + parent[30:], "clash"))
    rows += [(900, None, ""), (901, " ", ""), (902, "C", ""), (903, "C", ""), (904, "c1ccccc1" * 3000, ""), (None, "C", "")]
    df = spark.createDataFrame(rows, "cid long, SMILES string, item string")
    done = S.SmilesClusters(df)
    items = [(c, S.skeleton(s)) for c, s, _ in rows if c is not None and S.skeleton(s) is not None]
    got = {tuple(r) for r in done.pairs().collect()}
    assert got == brute(items)
    label = {}
    for r in done.membership.join(done.clusters, "item").collect():
        label[r.cid] = r.cluster
    assert set(label) == {c for c, _ in items} and all(label[a] == label[b] for a, b in got)
    sizes = {r.cluster_label: (r.cluster_size, r.representatives) for r in done.summary().collect()}
    assert sum(n for n, _ in sizes.values()) == len(items) and all(1 <= len(r) <= 3 for _, r in sizes.values())


def test_links_across_a_cut_of_a_loose_group_are_pairs(spark):
    text = chain(random.Random(11), 12)
    rows = [(0, text)]
    for i in range(1, 13):
        text = text[: 9 * i] + "SNO" + text[9 * i :]
        rows += [(i, text), (100 + i, text + ".Cl")]
    done = S.SmilesClusters(spark.createDataFrame(rows, "cid long, SMILES string"))
    want = brute([(c, S.skeleton(s)) for c, s in rows])
    label = {r.cid: r.cluster for r in done.membership.join(done.clusters, "item").collect()}
    assert any(label[a] != label[b] for a, b in want)
    assert sorted(tuple(r) for r in done.pairs().collect()) == sorted(want)


def test_loose_groups_are_split_around_medoids(spark):
    # two tight groups of four, held together by one link
    links = [(a, b) for g in (range(4), range(4, 8)) for a in g for b in g if a < b] + [(3, 4)]
    df = spark.createDataFrame([(a, b, 1.0) for a, b in links], "a long, b long, similarity double")
    members = spark.createDataFrame([(i, 0) for i in range(8)], "item long, component long")
    got = {r.item: r.cluster for r in S.split_loose(members, df).collect()}
    assert len(got) == 8 and len(set(got.values())) == 2 and len({got[i] for i in (0, 1, 2)}) == 1 and len({got[i] for i in (5, 6, 7)}) == 1


def test_large_buckets_are_paired_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    banded = spark.range(30).select(F.col("id").alias("item"), F.lit(50).alias("size"), F.lit(7).cast("long").alias("counts"), F.lit(1).cast("long").alias("band"))
    assert S.candidates(banded).count() == 30 * 29 // 2


def test_copies_of_a_skeleton_are_paired_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    text = chain(random.Random(3), 8)
    rows = [(i, text + ".Cl" * (i % 3)) for i in range(25)] + [(100 + i, text[:20] + "O" + text[20:]) for i in range(11)]
    got = [tuple(r) for r in S.SmilesClusters(spark.createDataFrame(rows, "cid long, SMILES string")).pairs().collect()]
    assert len(got) == len(set(got)) == 36 * 35 // 2 and all(a < b for a, b in got)


def test_a_long_chain_is_split_in_few_rounds(spark):
    df = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1.0).alias("similarity"))
    members = spark.range(61).select(F.col("id").alias("item"), F.lit(0).cast("long").alias("component"))
    got = {r.item: r.cluster for r in S.split_loose(members, df).collect()}
    assert sorted(got) == list(range(61)) and all(abs(i - c) <= 1 for i, c in got.items())


def test_empty_table(spark):
    done = S.SmilesClusters(spark.createDataFrame([], "cid long, SMILES string"))
    assert done.pairs().count() == 0 and done.summary().count() == 0
