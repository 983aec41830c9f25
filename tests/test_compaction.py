"""Packing, verification and repeats."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.ranks import rank_within
from millrace.operators import compaction as C
from millrace.session import fresh_path


def test_first_fit_decreasing_matches_the_plain_way():
    rng = random.Random(1)
    for _ in range(200):
        cap = rng.choice([10, 37, 100])
        sizes = [rng.randint(1, cap + 2) for _ in range(rng.randint(0, 60))]
        counts, bins, want = {}, [], []
        for s in sorted(sizes, reverse=True):
            counts[s] = counts.get(s, 0) + 1
            k = next((i for i, r in enumerate(bins) if r >= s), len(bins))
            if k == len(bins):
                bins.append(max(0, cap - s))
            else:
                bins[k] -= s
            want.append((s, k))
        got = sorted((s, b) for s, a, z, b in C.first_fit_decreasing(counts, cap) for _ in range(z - a + 1))
        assert got == sorted(want)


SCHEMA = "id long, a string, x double, n int, source_file string, file string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def record():
    return {"a": F.upper(F.trim("a")), "x": F.col("x"), "n": F.col("n")}


def test_rows_survive_and_repeats_go(spark):
    nan = float("nan")
    rows = [(1, "p", nan, None, "f1", "c"), (2, " P", nan, None, "f2", "c"), (3, "p", 0.0, 1, "f2", "c"), (4, "p", -0.0, 1, "f3", "c"), (5, None, None, None, None, None), (6, None, None, None, "f3", None), (7, "q" * 70_000, 1.0, 1, "f4", "c")]
    done = C.compact(frame(spark, rows), "source_file", "id", record(), 1 << 20)
    assert sorted(r.id for r in done.repeats.collect()) == [2, 4, 6]
    kept = C.read_compacted(spark, done.path)
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5, 7]
    assert done.bins.agg(F.sum("n_rows"), F.sum("n_kept"), F.sum("n_files")).first()[:] == (7, 4, 5)


def test_a_hot_record_and_bins_of_the_right_size(spark):
    df = spark.range(4000).select(F.col("id"), F.lit("same").alias("a"), F.lit(1.0).alias("x"), F.lit(1).alias("n"), F.concat(F.lit("f"), (F.col("id") % 400).cast("string")).alias("source_file"), F.lit("").alias("file"))
    done = C.compact(df, "source_file", "id", record(), 20_000)
    assert done.repeats.count() == 3999
    bins = done.bins.collect()
    assert 1 < len(bins) < 20 and max(b.n_bytes for b in bins) <= 20_000 and all(b.verified for b in bins)


def test_empty_table_and_clash(spark):
    done = C.compact(frame(spark, []), "source_file", "id", record())
    assert done.repeats.count() == 0 and done.bins.count() == 0
    with pytest.raises(ValueError):
        C.compact(frame(spark, []).withColumn("bin", F.lit(1)), "source_file", "id")


def test_a_wrong_copy_is_not_committed(spark, monkeypatch):
    path = fresh_path(spark, "never")
    real = C.manifest
    monkeypatch.setattr(C, "manifest", lambda df: real(df).withColumn("n_rows", F.col("n_rows") + 1))
    with pytest.raises(C.VerificationError):
        C.compact(frame(spark, [(1, "a", 1.0, 1, "f", "")]), "source_file", "id", record(), path=path)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path).count()


def test_a_folder_of_tiny_files_becomes_few(spark, tmp_path):
    rows = [(i, f"t{i % 7}" if i % 11 else None, i / 3) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, text string, hash double").repartition(60)
    for part in ("a", "b"):
        df.write.parquet(str(tmp_path / "in" / part))
    target = str(tmp_path / "out")
    bins = C.compact_folder(spark, str(tmp_path / "in"), target, target_bytes=40_000).collect()
    assert sum(b.n_files for b in bins) == 120 and sum(b.n_rows for b in bins) == 1800 and all(b.verified for b in bins)
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(files) == len(bins) < 12 and max(b.n_bytes for b in bins) <= 40_000
    back = spark.read.parquet(target).drop("bin")
    assert back.exceptAll(df.union(df)).count() == 0 and back.count() == 1800
    with pytest.raises(FileExistsError):
        C.compact_folder(spark, str(tmp_path / "in"), target)


def test_text_files_and_a_folder_without_rows(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for i in range(30):
        (tmp_path / "t" / f"{i}.txt").write_text(f"line {i}\nsame\n")
    bins = C.compact_folder(spark, str(tmp_path / "t"), str(tmp_path / "o"), "text").collect()
    assert [(b.n_files, b.n_rows) for b in bins] == [(30, 60)]
    assert spark.read.parquet(str(tmp_path / "o")).where("value = 'same'").count() == 30
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.txt").write_text("")
    assert C.compact_folder(spark, str(tmp_path / "e"), str(tmp_path / "p"), "text").count() == 0


def test_blank_ids_are_one_with_null_ids(spark, data):
    from millrace.plans.problems import PLACE
    from millrace.functions.nulls import norm_id

    poses = spark.read.parquet(f"{data}/poses.parquet").limit(1)
    rows = poses.crossJoin(spark.createDataFrame([(101, None), (102, ""), (103, " \t"), (104, "x"), (105, " X ")], "k long, v string"))
    rows = rows.withColumn("pose_id", F.col("k")).withColumn("protein_id", F.col("v")).drop("k", "v")
    rec = {c: norm_id(c) if c in ("protein_id", "ligand_id") else F.col(c) for c in rows.columns if c not in PLACE}
    assert sorted(r[0] for r in C.repeated_rows(rows, "pose_id", rec).collect()) == [102, 103, 105]


def test_two_commits_to_one_place(spark):
    path = fresh_path(spark, "once")
    df = frame(spark, [(1, "a", 1.0, 1, "f", "")])
    C.compact(df, "source_file", "id", path=path)
    with pytest.raises(FileExistsError):
        C.compact(df, "source_file", "id", path=path)


def test_rank_within_spans_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.lit(5000) - F.col("id")).alias("o")).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = {(r.g, r.o): r["rank"] for r in rank_within(df, ["g"], ["o"]).collect()}
    want = {}
    for g in (None, 1, 2):
        for i, (_, o) in enumerate(sorted((k for k in got if k[0] == g), key=lambda k: k[1])):
            want[g, o] = i
    assert got == want and len(got) == 1000
