"""Bounded heaps."""

import random

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import topn as T  # noqa: E402

SCHEMA = "pose_id long, protein_id string, ligand_id string, CNNscore double, pose_rank int, pair_rank string"


def brute(rows, n=5):
    groups = {}
    for i, p, lig, s, k, _ in rows:
        p, lig = (p or "").strip().upper(), (lig or "").strip().upper()
        if p and lig and s is not None and s == s:
            groups.setdefault((p, lig), []).append((-s, k is None, k or 0, i))
    return {(r[3], rank) for g in groups.values() for rank, r in enumerate(sorted(g)[:n])}


@pytest.mark.parametrize("held", [40, 200_000])
def test_matches_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(T, "HELD_ROWS", held)
    rng = random.Random(held)
    rows = []
    for i in range(1500):
        protein = rng.choice(["hot", " HOT ", "Hot", "b", "", None, "ab", "a"])
        rows.append((i, protein, rng.choice(["x", "X ", "bx", "b", None, "\t"]), rng.choice([0.1, 0.5, 0.5, 0.9, None, float("nan"), -0.0, 0.0]), rng.choice([None, 0, 1, 2]), "clash"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {tuple(r) for r in T.top_poses(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows)


def test_repeats_empty_and_arguments(spark):
    rows = [(1, "a", "x", 1.0, 0, "")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.pair_rank for r in T.top_poses(df).collect()) == [0, 1, 2]
    assert T.top_poses(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        T.top_n(df, ["protein_id"], "CNNscore", "pose_id", 0)


def test_whole_numbers_are_compared_and_returned_exactly(spark):
    big = 2**53
    rows = [("g", big + 1, "b", 10, None), ("g", big, "a", 11, "x"), ("g", big + 1, None, 12, "y"), ("g", big + 1, "a", 13, "z")]
    df = spark.createDataFrame(rows, "k string, score long, name string, id long, extra string")
    got = [tuple(r) for r in T.top_n(df, ["k"], "score", "id", 3, ["name"]).orderBy("rank").collect()]
    assert got == [("g", big + 1, "a", 13, 0), ("g", big + 1, "b", 10, 1), ("g", big + 1, None, 12, 2)]


def test_a_heap_holds_n_rows_whatever_comes():
    h = T.Heaps(3, 1, [True])
    rng = random.Random(5)
    rows = [("g", rng.randint(0, 50), i) for i in range(5000)]
    for r in rows:
        h.add(r)
        assert len(h.heaps["g",]) <= 3 and h.rows <= 3
    assert list(h.drain()) == [sorted(rows, key=lambda r: (-r[1], r[2]))[:3]]
